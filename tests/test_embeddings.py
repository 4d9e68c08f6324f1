import math

import numpy as np
import pyarrow as pa
import pytest

from repoquarry.operators import contexts, pieces, skipgram, vocabulary
from repoquarry.operators import token_vectors as tv
from repoquarry.plans import embeddings, tokenization

SEQUENCES = [["a"], ["a", "b", "c", "a"], ["x", "y"], [], ["b", "a"], ["c", "c", "a", "b", "c"], ["b", "a"]]
SELECTED = ["a", "c", "never", "b"]


@pytest.fixture
def sequences(spark):
    rows = [(i, s) for i, s in enumerate(SEQUENCES)]
    return spark.createDataFrame(rows, "doc INT, tokens ARRAY<STRING>").repartition(3)


@pytest.fixture
def selected(spark):
    return spark.createDataFrame(list(enumerate(SELECTED)), "idx INT, token STRING")


def _places(token):
    return [
        0.5 if len(s) == 1 else i / (len(s) - 1) for s in SEQUENCES for i, t in enumerate(s) if t == token
    ]


def test_position_features(sequences, selected):
    for r in tv.position_features(selected, sequences).collect():
        p = _places(r.token)
        want = (np.mean(p), np.std(p), min(p), max(p), len(p)) if p else (0.5, 0.0, 0.5, 0.5, 0)
        assert tuple(r)[2:] == pytest.approx(want)


def test_position_features_of_a_large_selection(sequences, selected, monkeypatch, physical_plan):
    """Beyond the size limit the selection is joined without a broadcast hint, with the same result."""
    from repoquarry import session

    small = sorted(map(tuple, tv.position_features(selected, sequences).collect()))
    monkeypatch.setattr(session, "SELECTION_ROWS", 2)
    assert sorted(map(tuple, tv.position_features(selected, sequences).collect())) == small


def test_position_vectors(sequences, selected):
    def encode(p):
        v = np.zeros(128)
        for k in range(64):
            v[2 * k], v[2 * k + 1] = math.sin(p / 10000 ** (2 * k / 128)), math.cos(p / 10000 ** (2 * k / 128))
        return v

    features = tv.position_features(selected, sequences)
    for r in tv.position_vectors(features).collect():
        v = encode(r.mean_position) + 0.2 * encode(min(r.position_std, 1.0))
        v += 0.1 * encode(r.minimum_position) + 0.1 * encode(r.maximum_position)
        assert r.vec == pytest.approx((v / np.linalg.norm(v)).tolist())


def test_contexts(sequences):
    got = {(r.doc, r.pos): (r.token, r.left, r.right) for r in contexts.token_contexts(sequences, SELECTED, ("doc",)).collect()}
    want = {
        (d, i): (t, s[max(0, i - 2) : i], s[i + 1 : i + 3])
        for d, s in enumerate(SEQUENCES)
        for i, t in enumerate(s)
        if t in SELECTED
    }
    assert got == want
    text = contexts.context_text(contexts.token_contexts(sequences, ["c"])).filter("pos = 2").first()
    assert (text.left_context, text.right_context) == ("a b", "a")
    with pytest.raises(ValueError):
        contexts.require_contexts(contexts.token_contexts(sequences, ["never"]))


def test_structural_vectors(spark, sequences, selected):
    def unit(v):
        n = np.linalg.norm(v)
        return v / n if n > 0 else v

    def vector(token):
        found = []
        for s in SEQUENCES:
            for i, t in enumerate(s):
                if t == token:
                    parts = [tv.hash_vector(f"CENTER::{t}")]
                    parts += [tv.hash_vector(f"LEFT::{x}") for x in s[max(0, i - 2) : i]]
                    parts += [tv.hash_vector(f"RIGHT::{x}") for x in s[i + 1 : i + 3]]
                    found.append(unit(np.mean(parts, axis=0)))
        return unit(np.mean(found, axis=0)) if found else np.zeros(128)

    spaced = spark.createDataFrame([("a", ["x y", " "], ["", "z\t"])], "token STRING, left ARRAY<STRING>, right ARRAY<STRING>")
    plain = spark.createDataFrame([("a", ["x", "y"], ["z"])], spaced.schema)
    assert contexts.structural_vectors(selected, spaced).collect() == contexts.structural_vectors(selected, plain).collect()
    rows = contexts.structural_vectors(selected, contexts.token_contexts(sequences, SELECTED)).collect()
    assert len(rows) == len(SELECTED)
    for r in rows:
        assert r.vec == pytest.approx(vector(r.token).tolist())


def test_frequency_vectors(spark, selected):
    frequency = spark.createDataFrame([("a", 10), ("c", 4), ("other", 99)], "token STRING, frequency BIGINT")
    files = spark.createDataFrame([("r2",), ("r1",), ("r2",), ("r2",), (None,)], "repository STRING")
    known = tv.token_frequencies(selected, frequency)
    slots = {(r.token, r.slot): r.value for r in tv.frequency_components(known, files).collect()}
    for r in tv.frequency_vectors(known, files).collect():
        assert [slots[(r.token, k)] for k in range(4)] == pytest.approx(r.vec)
        f = {"a": 10, "c": 4}.get(r.token, 0)
        v = np.array([f / 10, math.log1p(f), f / 10 * 0.25, f / 10 * 0.75])
        n = np.linalg.norm(v)
        assert r.vec == pytest.approx((v / n if n else v).tolist())


def test_skipgram(spark, selected, tmp_path):
    rows = [(["a", "b", "c"] * 5,), (["x"],), (["a", "b", "d"] * 4,)]
    df = spark.createDataFrame(rows, "tokens ARRAY<STRING>")
    usable = skipgram.training_sequences(df)
    assert usable.count() == 2
    one = skipgram.train(usable, size=16, epochs=2, partitions=1)
    two = skipgram.train(usable, size=16, epochs=2, partitions=1)
    a = skipgram.selected_vectors(selected, one).orderBy("idx").collect()
    assert a == skipgram.selected_vectors(selected, two).orderBy("idx").collect()
    assert [r.token for r in a] == ["a", "c", "b"] and len(a[0].vec) == 16
    assert [r.token for r in skipgram.unknown_tokens(selected, one).collect()] == ["never"]
    skipgram.save(one, str(tmp_path / "model"))
    assert skipgram.selected_vectors(selected, skipgram.load(str(tmp_path / "model"))).orderBy("idx").collect() == a
    with pytest.raises(ValueError):
        skipgram.training_sequences(df.filter("size(tokens) < 2"))


def test_stages_three_and_four(spark):
    names = ["src/app/main.py", "src/app/models.py", "tests/test_app.py", "tests/test_models.py", "docs\\conf.py"]
    rows = [(f"r{i % 3}", f"{n[:-3]}_{i}.py") for i in range(60) for n in names]
    files = spark.createDataFrame(rows, "repository STRING, file_path STRING")
    out = tokenization.tokenize_and_profile(files, top=20)
    assert {r.tokenizer for r in out["comparison"].collect()} == {"character", "word", "subword"}
    assert out["improvement_statistics"].first().total_pairs_analyzed == 190
    assert out["character_vocabulary"].filter("token_id = 1").count() == 1
    ranks = list(range(1, 9))
    four = embeddings.embed_and_compare(files, out["subword_frequency"], out["model"], ranks, partitions=1, epochs=2)
    comparison = {r.approach: r for r in four["comparison"].collect()}
    assert set(comparison) == {"Frequency", "Position", "Word2Vec", "Code2Vec"}
    assert all(-1.0000001 <= r.lowest_similarity <= r.highest_similarity <= 1.0000001 for r in comparison.values())
    assert four["similarity"].count() == 4 * 28
    best = four["most_similar"].collect()
    assert sorted((r.approach, r["rank"]) for r in best) == [(a, n) for a in sorted(comparison) for n in range(1, 6)]
    assert all(r.similarity == comparison[r.approach].highest_similarity for r in best if r["rank"] == 1)
    sequences = pieces.with_path_tokens(files, out["model"])
    assert "\\" not in "".join(t for r in sequences.collect() for t in r.tokens)
    assert vocabulary.token_profile(sequences).count() > 8


def test_vectors_of_frequent_tokens_stay_remembered(monkeypatch):
    """A full memory forgets what was not looked up for a generation, not the tokens in use."""
    made = []
    real = contexts.hash_vector
    monkeypatch.setattr(contexts, "hash_vector", lambda key, size: made.append(key) or real(key, size))
    roles = contexts._RoleVectors(4, 10)
    for i in range(200):
        roles.coded("LEFT", pa.array(["the", f"rare{i}", "the"]))
    assert made.count("LEFT::the") == 1 and len(made) == 201
    assert len(roles.known) + len(roles.before) <= 20
    table, rows = roles.coded("LEFT", pa.array(["the", "x", "the"]))
    assert (table[rows] == [real(f"LEFT::{t}", 4) for t in ("the", "x", "the")]).all()
