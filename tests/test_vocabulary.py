import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from repoquarry.operators import pieces, selection, vocabulary

TEXTS = ["def f(a):\n  return a==a", "", None, "  ", "é😀 é 3.14 x::y", "a a a b b a", "٥٦ nbsp\xa0z"]
WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*|\d+(?:\.\d+)?|==|!=|<=|>=|->|=>|::|&&|\|\||[^\s]")


@pytest.fixture
def texts(spark):
    return vocabulary.documents(spark.createDataFrame([(t,) for t in TEXTS], "code STRING")).repartition(3)


def _expected(sequences):
    lengths = [len(s) for s in sequences]
    filled = [n for n in lengths if n]
    return Counter(t for s in sequences for t in s), lengths, sum(filled) / len(filled)


@pytest.mark.parametrize("kind", ["character", "word"])
def test_profiles(texts, kind):
    split = list if kind == "character" else WORD.findall
    counts, lengths, average = _expected([split(t or "") for t in TEXTS])
    profile = vocabulary.character_profile(texts) if kind == "character" else vocabulary.word_profile(texts)
    assert {r.token: r.frequency for r in vocabulary.frequencies(profile).collect()} == counts
    row = vocabulary.sequence_statistics(profile, kind).first()
    assert (row.vocabulary_size, row.total_sequences, row.total_tokens) == (len(counts), len(TEXTS), sum(lengths))
    assert (row.min_sequence_length, row.max_sequence_length) == (0, max(lengths))
    assert row.average_sequence_length == pytest.approx(average)
    assert row.embedding_parameters == len(counts) * 128


def test_empty_corpus(spark):
    none = spark.createDataFrame([], "text STRING")
    for profile in (vocabulary.character_profile(none), vocabulary.word_profile(none)):
        row = vocabulary.sequence_statistics(profile, "x").first()
        assert (row.total_tokens, row.total_sequences, row.average_sequence_length) == (0, 0, 0.0)


def test_vocabulary_order_does_not_depend_on_partitions(spark, texts):
    frequency = vocabulary.frequencies(vocabulary.word_profile(texts))
    got = vocabulary.vocabulary(frequency).orderBy("token_id").collect()
    assert [r.token_id for r in got] == list(range(1, len(got) + 1))
    assert [(r.token, r.frequency) for r in got] == sorted(
        ((r.token, r.frequency) for r in got), key=lambda x: (-x[1], x[0].encode())
    )
    again = vocabulary.vocabulary(frequency.repartition(5)).orderBy("token_id").collect()
    assert again == got


def test_character_ids_with_unknown(spark, texts):
    vocab = vocabulary.vocabulary(vocabulary.frequencies(vocabulary.character_profile(texts)))
    ids = {r.token: r.token_id for r in vocab.collect()}
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, "Ωa"])], "i INT, text STRING").repartition(2)
    got = {r.i: r.token_ids for r in vocabulary.with_character_ids(df, vocab).collect()}
    assert got == {i: [ids.get(c, 0) for c in t or ""] for i, t in enumerate([*TEXTS, "Ωa"])}


def test_selection_by_rank(spark):
    df = spark.createDataFrame([(f"t{i:03d}", i // 2) for i in range(200)], "subword STRING, count INT")
    order = sorted(((f"t{i:03d}", i // 2) for i in range(200)), key=lambda x: (-x[1], x[0]))
    got = selection.select_tokens(df, [5, 1, 50], 3).orderBy("idx").collect()
    assert [(r.rank, r.token, r.frequency) for r in got] == [(k, *order[k - 1]) for k in (5, 1, 50)]
    for wrong in ([1, 2], [1, 1, 2], [0, 1, 2], [1, 2, 51]):
        with pytest.raises(ValueError):
            selection.select_tokens(df, wrong, 3)


def test_subword_profile_leaves_blank_texts_out(spark, texts):
    filled = vocabulary.documents(texts.withColumnRenamed("text", "code"), skip_blank=True)
    model = pieces.train(filled)
    row = vocabulary.sequence_statistics(
        vocabulary.token_profile(pieces.with_tokens(filled, model)), "subword", len(model.vocab)
    ).first()
    assert row.total_sequences == 4 and row.min_sequence_length > 0
    assert row.vocabulary_size == len(model.vocab) >= row.tokens_observed


def first_seen(sequences):
    """Tokens by falling count, ties by the first (position, place)."""
    counts, first = Counter(), {}
    for position, sequence in sequences:
        for place, token in enumerate(sequence):
            counts[token] += 1
            first[token] = min(first.get(token, (position, place)), (position, place))
    return sorted(counts, key=lambda t: (-counts[t], first[t]))


@pytest.mark.parametrize("kind", ["character", "word"])
def test_ties_by_first_place(spark, kind):
    texts = [*TEXTS, "zz yy xx ww", "ww xx", "é😀z", None, "b c d e f g h i j"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows[::-1], "n LONG, text STRING").repartition(4)
    split = list if kind == "character" else WORD.findall
    make = vocabulary.character_profile if kind == "character" else vocabulary.word_profile
    ids = vocabulary.vocabulary(vocabulary.frequencies(make(df, position="n")), ties="first_seen")
    got = [r.token for r in ids.orderBy("token_id").collect()]
    assert got == first_seen([(n, split(t or "")) for n, t in rows])
    assert ids.columns == ["token", "token_id", "frequency"]
    with pytest.raises(ValueError):
        vocabulary.vocabulary(vocabulary.frequencies(make(df)), ties="last_seen")


def test_batches_are_cut_by_bytes():
    import numpy as np

    gigabytes = np.array([0, 1, 1, 3, 3.5], np.float64) * (1 << 30)
    offsets = gigabytes.astype(np.int64)  # a batch beyond 32-bit offsets
    assert vocabulary.cut_points(offsets, 1 << 20) == [0, 1, 2, 3, 4]
    assert vocabulary.cut_points(offsets, 1 << 31) == [0, 2, 3, 4]
    assert vocabulary.cut_points(offsets, 1 << 40) == [0, 4]
    assert vocabulary.cut_points(np.zeros(1, np.int64), 10) == [0]
    assert vocabulary.cut_points(np.arange(0, 50, 3), 7) == [0, 2, 4, 6, 8, 10, 12, 14, 16]


def test_pieces_of_a_batch_have_all_characters():
    import pyarrow as pa

    texts = ["abc", None, "", "é😀" * 10, "x", "yy"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "n": pa.array(range(6))}).slice(1)
    pieces_ = list(vocabulary._pieces(batch, 0, 7))
    assert [p.column(1).to_pylist() for p in pieces_] == [[1, 2], [3], [4, 5]]
    codes = [c for p in pieces_ for c in vocabulary._code_points(p.column(0)).tolist()]
    assert codes == [ord(c) for t in texts[1:] for c in t or ""]


def test_character_ids_keep_other_columns(spark):
    vocab = spark.createDataFrame([("a", 1), ("é", 2), ("😀", 3)], "token STRING, token_id BIGINT")
    rows = [(1, "aé😀", [1, 2]), (2, None, None), (3, "", []), (4, "xaax" * 9, [3])]
    df = spark.createDataFrame(rows, "i INT, text STRING, token_ids ARRAY<INT>").coalesce(1)
    got = vocabulary.with_character_ids(df, vocab).collect()
    assert [(r.i, r.text) for r in got] == [r[:2] for r in rows]
    assert [r.token_ids for r in got] == [[1, 2, 3], [], [], [0, 1, 1, 0] * 9]
