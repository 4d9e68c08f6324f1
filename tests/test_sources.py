import json
import os

import pytest
from pyspark.sql import functions as F

from repoquarry import sinks
from repoquarry.plans import integration, mining
from repoquarry.sources import commit_log, file_systems, tables, tree

FILES = {
    "alpha/src/a.py": b"x = 1\ny = 2",
    "alpha/src/empty.py": b"",
    "alpha/src/__init__.py": b"#",
    "alpha/src/B.PYX": b"\xff\r\n\n",
    "alpha/docs/deep/read me.md": b"hello\n",
    "alpha/.gitignore": b"*.pyc\n",
    "alpha/.git/hooks/h.py": b"no\n",
    "alpha/x.": b"1",
    "beta/main.c": b"int main;\n",
    "beta/a+b.tar.gz": b"zip",
}
COMMITS = (
    "h1\tAda\t2024-01-31T23:30:00-05:00\n"
    "\n"
    "short\tline\n"
    "h2\t\t2024-02-03T10:00:00+00:00\n"
    "h3\tAda\tnot a date\n"
    "h4\tAda\tBob\t2024-02-03\n"
)
CHANGES = (
    "COMMIT\th1\t2024-02-01T00:00:00+00:00\n"
    "\n"
    "3\t1\tsrc/a.py\n"
    "-\t-\timg.png\n"
    "2\t2\tsrc/{a => b}/c.py\n"
    "5\t5\t \n"
    "\n"
    "COMMIT\th2\t2024-01-15T00:00:00+00:00\n"
    "COMMIT\th3\t2024-01-02T00:00:00+00:00\n"
    "\n"
    "1\t0\tsrc/a.py\n"
    "7\t7\twith space.py\n"
)


@pytest.fixture
def export(tmp_path):
    for name, content in FILES.items():
        path = tmp_path / "trees" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    (tmp_path / "trees/alpha/empty folder").mkdir()
    for repo in ("alpha", "be ta"):
        for kind, content in (("commits", COMMITS), ("changes", CHANGES)):
            folder = tmp_path / kind / repo
            folder.mkdir(parents=True)
            (folder / "log.txt").write_text(content)
    return tmp_path


def test_tree_listing(spark, export):
    entries = tree.scan(spark, str(export / "trees"))
    rows = tree.files_of(entries).collect()
    assert {(r.repository, r.folder) for r in tree.folders_of(entries).collect()} == {
        ("alpha", "src"), ("alpha", "docs"), ("alpha", "docs/deep"), ("alpha", "empty folder"),
    }
    assert {(r.repository, r.file_path): r.size_bytes for r in rows} == {
        tuple(k.split("/", 1)): len(v) for k, v in FILES.items() if "/.git/" not in k
    }


def test_tree_sources(spark, export):
    root = str(export / "trees")
    rows = tree.measure_sources(tree.files_of(tree.scan(spark, root)), root).collect()
    assert {(r.repository, r.file_path): (r.size_bytes, r.loc) for r in rows} == {
        ("alpha", "src/a.py"): (11, 2),
        ("alpha", "src/empty.py"): (0, 0),
        ("alpha", "src/__init__.py"): (1, 1),
        ("alpha", "src/B.PYX"): (4, 2),
        ("beta", "main.c"): (10, 1),
    }


@pytest.mark.parametrize("size", [1, 3, 4, 1000])
def test_files_are_read_in_ranges(spark, tmp_path, size):
    contents = {"a.py": b"x\ny\n\nz", "b.py": b"\n" * 50, "_c.py": b"a\n" * 20, "d.py": b"", "e.py": b"no end"}
    for name, content in contents.items():
        (tmp_path / "r").mkdir(exist_ok=True)
        (tmp_path / "r" / name).write_bytes(content)
    listing = tree.files_of(tree.scan(spark, str(tmp_path)))
    rows = tree.measure_sources(listing, str(tmp_path), size).collect()
    want = {n: c.count(b"\n") + (not c.endswith(b"\n") and c != b"") for n, c in contents.items()}
    assert {r.file_path: r.loc for r in rows} == want


def test_a_large_file_is_the_work_of_several_tasks(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "big.py").write_bytes(b"line\n" * 100_000)
    gone = spark.createDataFrame([("r", "gone.py", 9)], "repository STRING, file_path STRING, size_bytes BIGINT")
    listing = tree.files_of(tree.scan(spark, str(tmp_path))).unionByName(gone)
    rows = {r.file_path: r.loc for r in tree.measure_sources(listing, str(tmp_path), 10_000).collect()}
    assert rows == {"big.py": 100_000, "gone.py": 0}
    starts = F.sequence(F.lit(0), F.lit(499_999), F.lit(10_000))
    assert spark.range(1).select(F.explode(starts)).repartition(32).groupBy(F.spark_partition_id()).count().count() > 8


def test_file_systems_get_the_readers_settings(spark, tmp_path):
    settings = file_systems.hadoop_settings(spark)
    assert any(k.startswith("fs.") for k in settings)
    call = file_systems.file_system_call
    assert call("/a/b/", settings) == ("local", {}, "/a/b") and call("file:///a/b", settings) == ("local", {}, "/a/b")
    keys = {"fs.s3a.access.key": "k", "fs.s3a.secret.key": "s", "fs.s3a.endpoint": "", "fs.other": "x"}
    assert call("s3a://bucket/x/", keys) == ("s3", {"access_key": "k", "secret_key": "s"}, "bucket/x")
    assert call("hdfs://name:8020/x", keys) == ("hadoop", {"host": "hdfs://name", "port": 8020, "extra_conf": keys}, "/x")
    assert call("viewfs://cluster/x/y", {}) == ("hadoop", {"host": "viewfs://cluster", "port": 0, "extra_conf": {}}, "/x/y")
    assert call("hdfs:///x", {})[1]["host"] == "default"


def test_files_are_written_by_name(spark, tmp_path):
    rows = [("a/__init__.py", "x\n"), ("a/b/.hidden", ""), ("c d/é.txt", "é")]
    df = spark.createDataFrame(rows, "path STRING, content STRING").repartition(2)
    assert sinks.write_files(df, str(tmp_path)) == 3 and sinks.write_files(df, str(tmp_path)) == 3
    assert {p: (tmp_path / p).read_text() for p, _ in rows} == dict(rows)
    assert sinks.write_files(df.limit(0), str(tmp_path)) == 0


def test_logs_of_several_files_keep_their_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "LOG_LINES", 7)
    rows = [(f"r{i % 2}", i, f"h{i:03d}\tAda\t2024-01-01T00:00:00Z") for i in range(60)]
    lines = spark.createDataFrame(rows, "repository STRING, seq INT, value STRING").repartition(4)
    sinks.write_files(sinks.log_files(lines, [F.asc("seq")], "log"), str(tmp_path))
    assert len(list((tmp_path / "r0" / "log").iterdir())) > 3
    commits = commit_log.read_commits(spark, f"{tmp_path}/*/log", "log").orderBy("seq").collect()
    for r in ("r0", "r1"):
        assert [c.commit_hash for c in commits if c.repository == r] == [v.split("\t")[0] for q, _, v in rows if q == r]


def test_stage_one_follows_renames(spark, export):
    out = mining.mine_folders(
        spark, str(export / "trees"), str(export / "commits/*"), str(export / "changes/*"), window=3, follow_renames=True
    )
    changed = {(r.repository, r.file_path): r.change_count for r in out["history_metrics"].collect()}
    assert changed[("alpha", "src/b/c.py")] == 1 and ("alpha", "src/{a => b}/c.py") not in changed
    assert changed[("alpha", "src/a.py")] == 2


def test_tree_of_a_relative_root(spark, export):
    root = os.path.relpath(export / "trees")
    rows = tree.measure_sources(tree.files_of(tree.scan(spark, root)), root).collect()
    assert ("beta", "main.c", 1) in {(r.repository, r.file_path, r.loc) for r in rows} and len(rows) == 5


def test_commit_log(spark, export):
    rows = commit_log.read_commits(spark, str(export / "commits/*")).filter("repository = 'alpha'")
    got = {r.commit_hash: (r.author, r.month) for r in rows.collect()}
    assert got == {"h1": ("Ada", "2024-01"), "h2": ("Unknown", "2024-02"), "h3": ("Ada", None), "h4": ("Ada", None)}
    assert [r.commit_hash for r in rows.orderBy("seq").collect()] == ["h1", "h2", "h3", "h4"]


def test_change_log(spark, export):
    rows = commit_log.read_changes(spark, str(export / "changes/*")).orderBy("seq")
    assert {r.repository for r in rows.collect()} == {"alpha", "be ta"}
    got = rows.filter("repository = 'be ta'").collect()
    assert [(r.commit_hash, r.month, len(r.changes)) for r in got] == [
        ("h1", "2024-02", 4), ("h2", "2024-01", 0), ("h3", "2024-01", 2),
    ]
    assert got[0].changes[2].file_path == "src/{a => b}/c.py"


def test_log_order_over_many_splits(spark, tmp_path):
    folder = tmp_path / "r"
    folder.mkdir()
    body = "".join(f"COMMIT\t{i:05d}\t2024-01-01T00:00:00Z\n\n1\t1\tf{i}.py\n" for i in range(3000))
    (folder / "log").write_text(body)
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = commit_log.read_changes(spark, str(folder))
        assert df.rdd.getNumPartitions() > 3
        rows = df.orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.commit_hash for r in rows] == [f"{i:05d}" for i in range(3000)]
    assert all(len(r.changes) == 1 for r in rows)


def test_stage_one_from_folders(spark, export):
    out = mining.mine_folders(
        spark, str(export / "trees"), str(export / "commits/*"), str(export / "changes/*"), window=2
    )
    totals = {r.repository: r for r in out["tree_totals"].collect()}
    a = totals["alpha"]
    assert (a.total_files, a.source_code_files, a.directories, a.total_loc) == (7, 4, 4, 5)
    assert a.average_loc_per_source_file == pytest.approx(5 / 4)
    commits = {r.repository: r for r in out["commit_totals"].collect()}["alpha"]
    assert (commits.total_commits, commits.number_of_contributors) == (4, 2)
    assert (commits.most_active_name, commits.most_active_commits) == ("Ada", 3)
    churn = {r.repository: r for r in out["churn"].collect()}["alpha"]
    # window of two commits; the row without a path is a changed file without lines
    assert (churn.analyzed_commits, churn.months, churn.total_files_changed) == (2, 2, 4)
    assert (churn.total_lines_added, churn.total_lines_deleted) == (5, 3)
    assert churn.average_added_lines_per_commit == 2.5
    changed = {(r.repository, r.file_path): r.change_count for r in out["history_metrics"].collect()}
    assert changed[("alpha", "src/a.py")] == 1
    report = out["report"].filter("repository = 'alpha' and section = '1 inventory'").orderBy("ord").collect()
    assert [(r.key, r.value) for r in report][:2] == [("total files", "7"), ("source-code files", "4")]
    sinks.write_report(out["report"], str(export / "report"))
    assert (export / "report" / "repository=alpha").exists()


def _write_metrics(root, repo, files, history):
    folder = root / repo
    folder.mkdir(parents=True)
    (folder / "file_metrics.csv").write_text("file_path,language,extension,loc,size_bytes\n" + files)
    (folder / "git_history_metrics.csv").write_text("file_path,change_count\n" + history)


def test_stage_two_from_folders(spark, tmp_path):
    _write_metrics(tmp_path, "Flask App", 'a.py,Python,.py,10,100\n"b,""x"".py",Python,.py,5,50\n', "a.py,3\na.py,4\n")
    _write_metrics(tmp_path, "other", "NA,Python,.py,1,1\n", "zzz.py,9\n")
    out = integration.integrate_folder(spark, str(tmp_path))
    rows = {(r.repository, r.file_path): (r.loc, r.change_count, r.history_present) for r in out["combined"].collect()}
    assert rows == {
        ("flask app", "a.py"): (10, 7, True),
        ("flask app", 'b,"x".py'): (5, 0, False),
        ("other", "NA"): (1, 0, False),
    }
    stats = {(r.section, r.key): r.amount for r in out["combined_statistics"].collect()}
    assert stats[("files_with_history", "")] == 1 and stats[("files_without_history", "")] == 2
    sinks.write_combined(out["combined"], str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).filter("repository = 'other'").count() == 1
    sinks.write_statistics_json(out["combined_statistics"], str(tmp_path / "stats"))
    assert spark.read.json(str(tmp_path / "stats")).count() == out["combined_statistics"].count()


def test_missing_column_and_missing_file(spark, tmp_path):
    folder = tmp_path / "r"
    folder.mkdir()
    (folder / "file_metrics.csv").write_text("file_path,language\na.py,Python\n")
    with pytest.raises(ValueError, match="loc"):
        tables.read_file_metrics(spark, str(tmp_path))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_history(spark, str(tmp_path))


def test_vocabulary_and_embedding_tables(spark, tmp_path):
    (tmp_path / "v.json").write_text(json.dumps({"a": 0, "Ġb": 1}))
    got = tables.read_vocabulary_json(spark, str(tmp_path / "v.json")).collect()
    assert {r.token: r.id for r in got} == {"a": 0, "Ġb": 1}
    (tmp_path / "f.csv").write_text("subword,count\nnan,3\nnull,2\n")
    assert {r.token: r.frequency for r in tables.read_token_frequency(spark, str(tmp_path / "f.csv")).collect()} == {
        "nan": 3, "null": 2,
    }
    vectors = spark.createDataFrame([(0, "a", [1.0])], "idx INT, token STRING, vec ARRAY<DOUBLE>")
    sinks.write_embeddings(vectors, str(tmp_path / "e"))
    assert tables.load_aligned_embeddings(spark, str(tmp_path / "e"), vectors).count() == 1
    with pytest.raises(ValueError):
        tables.load_aligned_embeddings(spark, str(tmp_path / "e"), spark.createDataFrame([("z",)], "token STRING"))
