import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from repoquarry.operators import nudge, pairs, token_vectors

# The fifty tokens of an earlier run in frequency order, and the numbers found with
# vectors drawn for them from numpy's seed 42 (normal, spread 0.1, 128 slots).
TOKENS = (
    "_ / py . test tests tutorial sklearn src /_ docs 310 init __. /__ plot examples testing 001 params model"
    " utils scripts response an 002 example request 003 pytest linear query path cluster api body benchmarks"
    " externals models app array ensemble security selection extra validations str custom dependencies fixtures"
).split()
MOST_SIMILAR = [
    ("path", "selection", 0.25605694232907256),
    ("pytest", "externals", 0.25436484054375613),
    ("/__", "benchmarks", 0.2523494916293816),
    ("response", "dependencies", 0.2422628690231048),
    ("an", "pytest", 0.23053795692895102),
    ("examples", "testing", 0.22371803867822257),
    ("py", "plot", 0.21944525700300388),
    ("utils", "ensemble", 0.21018145307433186),
    ("sklearn", "benchmarks", 0.20656596627935253),
    ("003", "security", 0.20486844027955528),
]
LEAST_SIMILAR = [
    ("tests", "models", -0.24831168261929923),
    ("init", "path", -0.2404506594039724),
    ("models", "array", -0.2404062196751158),
    ("_", "params", -0.23775347107350214),
    ("array", "ensemble", -0.22477743945911116),
    ("__.", "validations", -0.22362597930229258),
    ("utils", "cluster", -0.22356671946908954),
    ("tests", "custom", -0.20546487626309862),
    ("model", "custom", -0.20510050009498812),
    ("utils", "example", -0.19608162195947976),
]
LOOKED_UP = [
    ("/", "_", 0.029606564996795766),
    (".", "py", -0.004124682313542217),
    ("tests", "app", 0.04773444811990535),
    ("sklearn", "selection", -0.027401676290156524),
    ("310", "path", -0.07753690298203582),
]
RELATED, ALL_PAIRS = 453, 1225
BEFORE, AFTER, CHANGE = -0.0018550769328122875, 0.11575376157388138, 0.1176088385066937


@pytest.fixture(scope="module")
def matrix():
    return np.random.RandomState(42).normal(0.0, 0.1, (50, 128))


@pytest.fixture(scope="module")
def vectors(spark, matrix):
    rows = [(i, t, matrix[i].tolist()) for i, t in enumerate(TOKENS)]
    return spark.createDataFrame(rows, "idx INT, token STRING, vec ARRAY<DOUBLE>").repartition(4)


def _same(rows, expected):
    assert [tuple(r)[:2] for r in rows] == [e[:2] for e in expected]
    assert [r[2] for r in rows] == pytest.approx([e[2] for e in expected], abs=1e-12)


@pytest.mark.parametrize("blocks", [1, 7, None])
def test_extreme_pairs(vectors, blocks):
    most = pairs.extreme_pairs(vectors, 10, True, blocks).select("token_1", "token_2", "similarity").collect()
    least = pairs.extreme_pairs(vectors, 10, False, blocks).select("token_1", "token_2", "similarity").collect()
    _same(most, MOST_SIMILAR)
    _same(least, LEAST_SIMILAR)


def test_lookup(spark, vectors):
    wanted = spark.createDataFrame([e[:2] for e in LOOKED_UP], "token_a STRING, token_b STRING")
    rows = {(r[0], r[1]): r[2] for r in pairs.lookup_pairs(wanted, vectors).collect()}
    assert rows == pytest.approx({e[:2]: e[2] for e in LOOKED_UP}, abs=1e-12)


@pytest.mark.parametrize("blocks", [1, 4])
def test_nudge(vectors, blocks):
    related = nudge.overlapping_pairs(vectors.select("idx", "token"))
    moved = nudge.nudge(vectors, related)
    changes = nudge.similarity_change(moved, blocks)
    row = nudge.improvement_statistics(related, changes).first()
    assert (row.related_pairs_detected, row.total_pairs_analyzed) == (RELATED, ALL_PAIRS)
    assert row.average_similarity_before == pytest.approx(BEFORE, abs=1e-12)
    assert row.average_similarity_after == pytest.approx(AFTER, abs=1e-12)
    assert row.average_similarity_change == pytest.approx(CHANGE, abs=1e-12)
    top = nudge.top_improvements(changes).collect()
    assert len(top) == 10 and top[0].change == max(r.change for r in changes.collect())


def test_nudge_order_matters_and_is_kept(spark):
    rows = [(0, "ab", [1.0, 0.0]), (1, "abc", [0.0, 1.0]), (2, "bc", [4.0, 4.0]), (3, "zz", [9.0, 9.0])]
    df = spark.createDataFrame(rows, "idx INT, token STRING, vec ARRAY<DOUBLE>")
    related = nudge.overlapping_pairs(df.select("idx", "token"))
    got = {r.idx: r.improved for r in nudge.nudge(df, related, size=2).collect()}
    m = np.array([r[2] for r in rows])
    for i, j in [(0, 1), (0, 2), (1, 2)]:
        a, b = m[i].copy(), m[j].copy()
        m[i], m[j] = 0.95 * a + 0.05 * b, 0.95 * b + 0.05 * a
    assert {i: v for i, v in got.items()} == {i: pytest.approx(m[i].tolist()) for i in range(4)}


def test_nudge_without_related_tokens(spark):
    df = spark.createDataFrame([(0, "a", [1.0]), (1, "b", [2.0])], "idx INT, token STRING, vec ARRAY<DOUBLE>")
    related = nudge.overlapping_pairs(df.select("idx", "token"))
    assert {r.idx: r.improved for r in nudge.nudge(df, related, size=1).collect()} == {0: [1.0], 1: [2.0]}


def test_nudge_all_pairs_at_once(spark):
    rows = [(0, "ab", [1.0, 0.0]), (1, "abc", [0.0, 1.0]), (2, "bc", [4.0, 4.0]), (3, "zz", [9.0, 9.0])]
    df = spark.createDataFrame(rows, "idx INT, token STRING, vec ARRAY<DOUBLE>").repartition(3)
    related = nudge.overlapping_pairs(df.select("idx", "token"))
    m = np.array([r[2] for r in rows])
    want = m.copy()
    for i, j in [(0, 1), (0, 2), (1, 2)]:
        want[i] += 0.05 * (m[j] - m[i])
        want[j] += 0.05 * (m[i] - m[j])
    for pairs_ in (related, related.orderBy(F.desc("idx_2"))):
        got = {r.idx: r.improved for r in nudge.nudge_together(df, pairs_).collect()}
        assert got == {i: pytest.approx(want[i].tolist()) for i in range(4)}
    row = nudge.change_summary(nudge.nudge_together(df, related), blocks=3).first()
    changes = nudge.similarity_change(nudge.nudge_together(df, related)).collect()
    assert row.total_pairs_analyzed == 6
    assert row.average_similarity_change == pytest.approx(np.mean([r.change for r in changes]))
    none = nudge.nudge_together(df, related.limit(0)).collect()
    assert {r.idx: r.improved for r in none} == {r[0]: r[2] for r in rows}


@pytest.mark.parametrize("blocks", [1, 6])
def test_overlaps_against_sets(spark, blocks):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdeÀÉéß字 "), rng.integers(0, 7))) for _ in range(70)] + ["", "ABC", "abc"]
    df = spark.createDataFrame(list(enumerate(words)), "idx INT, token STRING").repartition(4)
    sets = [set(w.lower()) for w in words]
    want = {}
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            smaller = min(len(sets[i]), len(sets[j]))
            overlap = len(sets[i] & sets[j]) / smaller if smaller else 0.0
            if overlap >= 0.4:
                want[i, j] = overlap
    got = {(r.idx_1, r.idx_2): r.character_overlap for r in nudge.overlapping_pairs(df, blocks=blocks).collect()}
    assert got == want
    degrees = {r.idx: (r.related, r.average_overlap) for r in nudge.overlap_degrees(df, blocks=blocks).collect()}
    ends = {}
    for pair, overlap in want.items():
        for i in pair:
            ends.setdefault(i, []).append(overlap)
    assert degrees == {i: (len(v), pytest.approx(np.mean(v))) for i, v in ends.items()}


def test_overlap_degrees_send_each_set_of_characters_once(spark, monkeypatch):
    """Tokens of the same characters are one row of the blocks, and still related to one another."""
    sent = []
    by_block_pair = nudge.by_block_pair

    def counted(vectors, *args, **kwargs):
        sent.append(vectors.count())
        return by_block_pair(vectors, *args, **kwargs)

    monkeypatch.setattr(nudge, "by_block_pair", counted)
    words = [w for n in range(1, 21) for w in ("ab" * n, "xy" * n, "axq" * n)]
    df = spark.createDataFrame([*enumerate(words), (60, "")], "idx INT, token STRING")
    rows = {r.token: (r.related, r.average_overlap) for r in nudge.overlap_degrees(df, blocks=2).collect()}
    assert sent == [4] and "" not in rows and len(rows) == 60
    assert rows["abab"] == rows["xyxy"] == (39, pytest.approx((19 + 20 * 0.5) / 39))
    assert rows["axq"] == (59, pytest.approx((19 + 40 * 0.5) / 59))


def test_blocks_grow_with_the_table():
    assert [pairs.few_blocks_for(n, 100) for n in (0, 100, 101, 2_000, 60_000, 600_000)] == [1, 1, 2, 20, 24, 24]
    assert pairs.few_blocks_for(3_276_800, 100) == 100


@pytest.mark.parametrize("own", [True, False])
def test_tiles_of_a_group(monkeypatch, own):
    """Each pair of a group lies in one tile, and the best are found over all tiles, ties included."""
    monkeypatch.setattr(pairs, "TILE", 4)
    rng = np.random.default_rng(5)
    vectors = rng.integers(-1, 2, (23, 3)).astype(float)
    block = np.zeros(23, int) if own else np.arange(23) % 2
    group = pd.DataFrame({"idx": rng.permutation(23), "vec": list(vectors), "_block": block, "_low": 0, "_high": int(not own)})
    unit, idx = pairs._unit_rows(group["vec"]), group["idx"].to_numpy()
    met = [(a, b) for a in range(23) for b in range(a + 1, 23) if own or block[a] != block[b]]
    want = sorted((round(-(unit[a] @ unit[b]), 9) + 0.0, *sorted((idx[a], idx[b]))) for a, b in met)[:7]
    best, seen = pairs._Best(idx, 7), 0
    for i, j, tile, diagonal in pairs._tiles(group):
        a, b = np.triu_indices(len(i), 1) if diagonal else np.nonzero(np.ones(tile.shape))
        seen += len(a)
        best.add(np.round(-tile[a, b], 9) + 0.0, i[a], j[b])
    assert seen == len(met)
    assert list(zip(best.values, idx[best.i], idx[best.j])) == want


@pytest.mark.parametrize("repositories, part_slots", [(0, 4), (1, 4), (4, 4), (11, 4), (11, 1024)])
def test_frequency_vectors_in_parts(spark, repositories, part_slots):
    files = [(f"r{i:02d}",) for i in range(repositories) for _ in range(i + 1)] + [(None,)]
    selected = spark.createDataFrame([(0, "a", 8.0), (1, "b", 2.0), (2, "c", 0.0)], "idx INT, token STRING, frequency DOUBLE")
    df = spark.createDataFrame(files, "repository STRING").repartition(3)
    shares = np.arange(1, repositories + 1) / max(1, repositories * (repositories + 1) // 2)
    want = []
    for f in (8.0, 2.0, 0.0):
        v = np.concatenate([[f / 8, np.log1p(f)], f / 8 * shares])
        want.append(v / np.linalg.norm(v) if v.any() else v)
    rows = token_vectors.frequency_components(selected, df, part_slots).collect()
    got = np.zeros((3, repositories + 2))
    for r in rows:
        got[r.idx, r.slot] = r.value
    assert len(rows) == 3 * (repositories + 2) and np.allclose(got, want)
    whole = {r.idx: r.vec for r in token_vectors.frequency_vectors(selected, df).collect()}
    assert np.allclose([whole[i] for i in range(3)], want)
    parts = token_vectors.frequency_parts(selected, df, part_slots)
    assert max(len(r.vec) for r in parts.collect()) <= max(2, part_slots)
    for blocks in (1, 3, None):
        pairs_ = {(r.idx_1, r.idx_2): r.similarity for r in pairs.part_similarities(parts, blocks).collect()}
        assert pairs_ == {(i, j): pytest.approx(float(want[i] @ want[j])) for i, j in [(0, 1), (0, 2), (1, 2)]}


@pytest.mark.parametrize("blocks", [1, 5])
def test_listing_and_summary_against_numpy(spark, blocks):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(40, 6))
    m[3] = 0.0
    m[7] = m[8]
    m[9] = -m[8]
    rows = [(i, f"t{i}", v.tolist()) for i, v in enumerate(m)]
    df = spark.createDataFrame(rows, "idx INT, token STRING, vec ARRAY<DOUBLE>").repartition(3)
    n = np.linalg.norm(m, axis=1)
    n[n == 0] = 1.0
    want = (m / n[:, None]) @ (m / n[:, None]).T
    got = pairs.pair_listing(df, blocks).collect()
    assert len(got) == 40 * 39 // 2
    for r in got:
        assert r.idx_1 < r.idx_2
        assert r.similarity == pytest.approx(want[r.idx_1, r.idx_2], abs=1e-12)
    row = pairs.similarity_summary(df, blocks).first()
    upper = want[np.triu_indices(40, 1)]
    assert row.pairs == len(upper)
    assert [row.highest_similarity, row.lowest_similarity, row.average_similarity] == pytest.approx(
        [upper.max(), upper.min(), upper.mean()]
    )


def test_many_blocks_follow_from_the_count():
    assert [pairs.blocks_for(n) for n in (0, 1, 1024, 1025, 5000)] == [1, 1, 1, 2, 5]


def test_one_vector_has_no_pairs(spark):
    df = spark.createDataFrame([(0, "a", [1.0])], "idx INT, token STRING, vec ARRAY<DOUBLE>")
    assert pairs.pair_listing(df).count() == 0
    assert pairs.similarity_summary(df).first().pairs == 0


def test_pairs_use_no_cross_join(vectors, physical_plan):
    for df in (pairs.extreme_pairs(vectors, 10), nudge.overlapping_pairs(vectors.select("idx", "token"))):
        plan = physical_plan(df)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_hash_vectors_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(t,) for t in TOKENS + TOKENS], "token STRING")
    rows = token_vectors.hash_vectors(df.repartition(5)).collect()
    for r in rows:
        assert r.vec == token_vectors.hash_vector(r.token).tolist()
        assert np.linalg.norm(r.vec) == pytest.approx(1.0)
    random = token_vectors.random_vectors(df.distinct()).collect()
    assert np.std([r.vec for r in random]) == pytest.approx(0.1, rel=0.05)


def test_mean_vectors(spark):
    rows = [("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("b", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "k STRING, vec ARRAY<DOUBLE>")
    assert {r.k: r.vec for r in pairs.mean_vectors(df, "k").collect()} == {"a": [2.0, 4.0], "b": [0.0, 1.0]}


def test_comparison_skips_empty_approaches(spark):
    rows = [("A", 0.5), ("A", -0.5), ("B", 1.0)]
    df = spark.createDataFrame(rows, "approach STRING, similarity DOUBLE")
    got = {r.approach: tuple(r)[1:] for r in pairs.compare_approaches(df).collect()}
    assert got == {"A": (0.5, -0.5, 0.0), "B": (1.0, 1.0, 1.0)}
