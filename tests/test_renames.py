"""Histories of renamed files and the components behind them."""

import random

import pytest
from pyspark.sql import functions as F

from repoquarry.operators import renames
from repoquarry.operators.components import connected


def by_hand(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize(
    "edges",
    [
        [],
        [(1, 1)],
        [(i, i + 1) for i in range(60)],
        [(i + 1, i) for i in range(0, 60, 2)] + [(i, i + 2) for i in range(0, 58, 4)],
        [(0, i) for i in range(1, 40)] + [(5, 5), (7, 0), (0, 7), (100, 101)],
        [(random.Random(i).randrange(80), random.Random(i + 500).randrange(80)) for i in range(60)],
    ],
)
def test_components_against_union_find(spark, edges):
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "a INT, b INT").repartition(3)
    got = {r.node: r.root for r in connected(df, "a", "b").collect()}
    assert got == by_hand(edges)


def test_components_of_structs(spark):
    df = spark.createDataFrame([(("x", "b"), ("x", "a")), (("y", "b"), ("y", "a"))], "a STRUCT<r: STRING, p: STRING>, b STRUCT<r: STRING, p: STRING>")
    got = {tuple(r.node): tuple(r.root) for r in connected(df, "a", "b").collect()}
    assert got == {("x", "a"): ("x", "a"), ("x", "b"): ("x", "a"), ("y", "a"): ("y", "a"), ("y", "b"): ("y", "a")}


@pytest.mark.parametrize(
    "path, ends",
    [
        ("a.py => b.py", ("a.py", "b.py")),
        ("src/{a => b}/c.py", ("src/a/c.py", "src/b/c.py")),
        ("src/{ => new}/c.py", ("src/c.py", "src/new/c.py")),
        ("src/{old => }/c.py", ("src/old/c.py", "src/c.py")),
        ("{ => lib}/c.py", ("c.py", "lib/c.py")),
        ("{a => b}.py", ("a.py", "b.py")),
        ("docs/{x.md => y.md}", ("docs/x.md", "docs/y.md")),
        ("plain.py", (None, None)),
        ("with {braces}.py", (None, None)),
        (None, (None, None)),
    ],
)
def test_rename_ends(spark, path, ends):
    old, new = renames.rename_ends(F.col("p"))
    row = spark.createDataFrame([(path,)], "p STRING").select(old.alias("o"), new.alias("n")).first()
    assert (row.o, row.n) == ends


LOG = [  # (repository, seq), newest first
    ("r", 1, "c.py"),
    ("r", 2, "b.py => c.py"),
    ("r", 3, "b.py"),
    ("r", 4, "src/{a.py => ../b.py}"),
    ("r", 5, "{a.py => b.py}"),
    ("r", 6, "a.py"),
    ("r", 7, "a.py"),
    ("r", 8, "other.py"),
    ("r", 9, "x.py => x.py"),
    ("s", 1, "a.py"),
    ("s", 2, "z.py => y.py"),
    ("s", 3, "y.py => z.py"),
    ("s", 4, " "),
]


def test_counts_follow_renames(spark):
    df = spark.createDataFrame(LOG, "repository STRING, seq INT, file_path STRING").repartition(3)
    histories = {(r.repository, r.path): r.file_path for r in renames.path_histories(df, [F.col("seq")]).collect()}
    assert histories[("r", "a.py")] == histories[("r", "b.py")] == histories[("r", "c.py")] == "c.py"
    assert histories[("s", "z.py")] == histories[("s", "y.py")] == "y.py" and ("s", "a.py") not in histories
    got = {(r.repository, r.file_path): r.change_count for r in renames.renamed_change_counts(df, [F.col("seq")]).collect()}
    assert got == {
        ("r", "c.py"): 6,
        ("r", "src/../b.py"): 1,
        ("r", "other.py"): 1,
        ("r", "x.py"): 1,
        ("s", "a.py"): 1,
        ("s", "y.py"): 2,
    }


def test_no_renames(spark):
    df = spark.createDataFrame([("r", 1, "a.py"), ("r", 2, "a.py")], "repository STRING, seq INT, file_path STRING")
    assert renames.path_histories(df, [F.col("seq")]).count() == 0
    assert [r.change_count for r in renames.renamed_change_counts(df, [F.col("seq")]).collect()] == [2]


def test_paths_are_taken_apart_once_each(spark, monkeypatch):
    """Changes are counted as they are written before any path is read, with nulls, blanks and copies of rows."""
    sizes = []
    taken_apart = renames.with_new_paths

    def counted(changes):
        sizes.append(changes.count())
        return taken_apart(changes)

    monkeypatch.setattr(renames, "with_new_paths", counted)
    paths = ["a => b"] * 40 + ["b"] * 30 + [" b "] * 20 + ["b => c"] * 2 + [None, "", " "]
    rows = [("r", n, p) for n, p in enumerate(paths)] + [(None, 0, "b")]
    df = spark.createDataFrame(rows, "repository STRING, seq INT, file_path STRING").repartition(3)
    got = {(r.repository, r.file_path): r.change_count for r in renames.renamed_change_counts(df, [F.col("seq")]).collect()}
    assert got == {("r", "b"): 92, (None, "b"): 1}  # the newest rename, a => b, gives the last name
    assert sizes == [8, 8]
