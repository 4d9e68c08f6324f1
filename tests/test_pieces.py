import json
import random

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from repoquarry.functions.text import BYTE_ALPHABET
from repoquarry.operators import pieces

tokenizers = pytest.importorskip("tokenizers")


def library(texts, size, frequency=2):
    from tokenizers import Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel
    from tokenizers.trainers import BpeTrainer

    tokenizer = Tokenizer(BPE(unk_token="[UNK]"))
    tokenizer.pre_tokenizer = ByteLevel(add_prefix_space=False)
    tokenizer.train_from_iterator(
        texts,
        BpeTrainer(
            vocab_size=size, special_tokens=pieces.SPECIAL_TOKENS, min_frequency=frequency, show_progress=False
        ),
    )
    merges = [tuple(m) for m in json.loads(tokenizer.to_str())["model"]["merges"]]
    return tokenizer, merges


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text STRING").repartition(3)


def invented_paths(n, seed):
    rng = random.Random(seed)
    words = ["src", "tests", "utils", "test", "model", "models", "aaa", "aaaa", "été", "x", "core", "__init__"]
    return [
        "/".join(rng.choice(words) for _ in range(rng.randint(1, 4))) + rng.choice([".py", ".c", "_test.py", ""])
        for _ in range(n)
    ]


@pytest.mark.parametrize("limits", [(100_000, 256, 16), (60, 16, 4), (100_000, 256, 4), (1, 1, 4)])
def test_same_model_as_library(spark, monkeypatch, limits):
    """Also when the limits are so small that every round is cut short."""
    run_limit, most, length = limits
    monkeypatch.setattr(pieces, "_SEQUENCES", run_limit)
    monkeypatch.setattr(pieces, "_MAX_CANDIDATES", most)
    monkeypatch.setattr(pieces, "_LONGEST", length)
    monkeypatch.setattr(pieces._RoundSize.__init__, "__defaults__", (min(most, 64), length, False))
    texts = invented_paths(300 if run_limit > 1 else 12, 7)
    tokenizer, merges = library(texts, 200)
    model = pieces.train(frame(spark, texts), 200)
    assert model.merges == merges
    assert model.vocab == tokenizer.get_vocab()
    other = [*texts, "unseen Z 漢字", "", "  src", "aaaaaaa"]
    got = pieces.with_tokens(spark.createDataFrame(list(enumerate(other)), "i INT, text STRING"), model)
    rows = {r.i: r.tokens for r in got.collect()}
    assert [rows[i] for i in range(len(other))] == [tokenizer.encode(t).tokens for t in other]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n/_é", min_size=1, max_size=24), min_size=1, max_size=30))
def test_same_merges_as_library_on_any_text(spark, texts):
    tokenizer, merges = library(texts, 60)
    model = pieces.train(frame(spark, texts), 60)
    assert model.merges == merges
    assert model.vocab == tokenizer.get_vocab()


def merge_one_by_one(corpus, size):
    """Merges of counted pieces (piece, n), each pair counted anew."""
    corpus, out, new = dict(corpus), [], 0x1000
    while len(out) < size:
        counts = {}
        for piece, n in corpus.items():
            for i in range(len(piece) - 1):
                counts[piece[i : i + 2]] = counts.get(piece[i : i + 2], 0) + n
        best = min(((-n, pair) for pair, n in counts.items() if n > 1), default=None)
        if best is None:
            break
        out.append(best[1])
        corpus = {piece.replace(best[1], chr(new)): n for piece, n in corpus.items()}
        new += 1
    return out


def merge_by_sequences(corpus, size, candidates, length):
    """The same as rounds over sequences of fixed length, without Spark; also how many merges a round made."""
    corpus, out, new, rounds = dict(corpus), [], 0x1000, []
    while len(out) < size:
        counts = {}
        for piece, n in corpus.items():
            for i in range(len(piece) - 1):
                counts[piece[i : i + 2]] = counts.get(piece[i : i + 2], 0) + n
        ranked = sorted((-n, pair) for pair, n in counts.items() if n > 1)
        if not ranked:
            break
        wanted = {pair for _, pair in ranked[:candidates]}
        end = ranked[candidates] if len(ranked) > candidates else None
        sequences = {}
        for piece, n in corpus.items():
            for run in pieces._cut(piece, wanted):
                for sequence, sign in pieces._sequences(run, length):
                    sequences[sequence] = sequences.get(sequence, 0) + sign * n
        simulated, middles = pieces._RunTable(sequences.items()), pieces._Middles(sequences, length)
        step, sure = 0, True
        while sure and len(out) < size:
            best = simulated.best()
            if best is None or best[0] < 2 or (end is not None and (-best[0], best[1]) >= end):
                break
            sure = middles.merge(best[1], chr(new))
            if not sure and step:
                break
            out.append(best[1])
            simulated.merge(best[1], chr(new))
            corpus = {piece.replace(best[1], chr(new)): n for piece, n in corpus.items()}
            new, step = new + 1, step + 1
        rounds.append(step)
    return out, rounds


@settings(max_examples=300, deadline=None)
@given(
    st.dictionaries(st.text(alphabet="abcd", min_size=1, max_size=40), st.integers(1, 9), min_size=1, max_size=12),
    st.integers(1, 12),
    st.sampled_from([4, 5, 8]),
)
def test_sequences_of_fixed_length_give_exact_merges(corpus, candidates, length):
    """Long pieces over few letters: runs are cut everywhere, and merges reach far."""
    merged = {}
    for piece, n in corpus.items():
        merged[piece] = n
    want = merge_one_by_one(merged, 25)
    got, _ = merge_by_sequences(merged, 25, candidates, length)
    assert got == want


def test_fixed_length_rounds_make_many_merges():
    rng = random.Random(4)
    words = ["".join(rng.choices("etaoinshrdlu", [12, 9, 8, 8, 7, 7, 6, 6, 6, 4, 4, 3], k=rng.randrange(2, 12))) for _ in range(3000)]
    corpus = {w: 1 + i % 50 for i, w in enumerate(words)}
    got, rounds = merge_by_sequences(corpus, 150, 64, 6)
    assert got == merge_one_by_one(corpus, 150) and len(rounds) < 50


def test_sequences_add_up_to_their_run():
    for run, length in [("abcdefgh", 4), ("abababab", 5), ("abc", 4), ("abcd", 4), ("aaaaaaa", 4)]:
        pairs = {}
        for sequence, sign in pieces._sequences(run, length):
            assert 2 <= len(sequence) <= length
            for i in range(len(sequence) - 1):
                pairs[sequence[i : i + 2]] = pairs.get(sequence[i : i + 2], 0) + sign
        want = {}
        for i in range(len(run) - 1):
            want[run[i : i + 2]] = want.get(run[i : i + 2], 0) + 1
        assert {p: n for p, n in pairs.items() if n} == want


def test_decoding_gives_the_text_back(spark):
    texts = invented_paths(50, 3) + ["a  b\n\n\tc", "naïve 😀"]
    model = pieces.train(frame(spark, texts), 300)
    back = {c: b for b, c in enumerate(BYTE_ALPHABET)}
    for row in pieces.with_tokens(frame(spark, texts), model).collect():
        assert bytes(back[c] for t in row.tokens for c in t).decode() == row.text


def test_frequency_agrees_with_encoded_texts(spark):
    texts = invented_paths(80, 5)
    df = frame(spark, texts)
    tokenizer, _ = library(texts, 120)
    model = pieces.train(df, 120)
    got = {r.token: r.frequency for r in pieces.token_frequency(pieces.piece_counts(df), model).collect()}
    want = {}
    for t in texts:
        for token in tokenizer.encode(t).tokens:
            want[token] = want.get(token, 0) + 1
    assert got == want


def test_long_piece(spark):
    texts = ["ab" * 20000, "ba ab ab"]
    tokenizer, merges = library(texts, 40)
    model = pieces.train(frame(spark, texts), 40)
    assert model.merges == merges
    row = pieces.with_tokens(frame(spark, texts[:1]), model).first()
    assert row.tokens == tokenizer.encode(texts[0]).tokens


def test_model_tables(spark, tmp_path):
    model = pieces.train(frame(spark, invented_paths(40, 1)), 80)
    pieces.save_model(model, spark, str(tmp_path / "m"))
    again = pieces.load_model(spark, str(tmp_path / "m"))
    assert again.vocab == model.vocab and again.merges == model.merges


def test_empty_corpus(spark):
    model = pieces.train(frame(spark, [""]).limit(0))
    assert model.merges == [] and list(model.vocab) == pieces.SPECIAL_TOKENS


def test_first_merges_are_a_smaller_model(spark):
    texts = invented_paths(60, 9)
    model = pieces.train(frame(spark, texts), 150)
    small = pieces.first_merges(model, 20)
    tokenizer, merges = library(texts, len(small.vocab))
    assert small.merges == merges == model.merges[:20] and small.vocab == tokenizer.get_vocab()
    got = {r.text: r.tokens for r in pieces.with_tokens(frame(spark, texts), small).collect()}
    assert got == {t: tokenizer.encode(t).tokens for t in texts}
    assert pieces.first_merges(model, 0).merges == []


def test_batches_are_encoded_some_pieces_at_once(monkeypatch):
    """Cuts between pieces, and rows that lie on both sides of a cut, change nothing."""
    monkeypatch.setattr(pieces, "_PIECES_AT_ONCE", 3)
    vocab = {c: i for i, c in enumerate("abc")}
    model = pieces.BpeModel({**vocab, "ab": 3, "abc": 4}, [("a", "b"), ("ab", "c")])
    rows = [["abc"], [], None, ["ab", "", "cab", "abcab"], ["c"], ["abc", "zz", "a"], []]
    want = [[model.tokens[t] for p in row or [] for t in model.encode_piece(p)] for row in rows]
    batch = pa.array([["skipped"], *rows], pa.list_(pa.string()))[1:]
    assert model.encode_batch(batch).to_pylist() == want
    assert model.encode_batch(batch[:0]).to_pylist() == []


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text(alphabet="abc", max_size=20), min_size=1, max_size=12),
    st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9), st.booleans()), max_size=9),
)
def test_pieces_are_rewritten_between_cuts(corpus, drawn):
    """As by merging whole pieces, also when a symbol comes from several merges."""
    symbols, merges = list("abc"), {}
    for a, b, again in drawn:
        pair = symbols[a % len(symbols)] + symbols[b % len(symbols)]
        new = symbols[-1] if again and len(symbols) > 3 else chr(0x1000 + len(symbols))
        if pair not in merges:
            merges[pair] = new
            symbols.append(new)
    table = {pair: (order, new) for order, (pair, new) in enumerate(merges.items())}
    seams = pieces._keys(pieces._seams(list(merges.items())))
    known = {}
    assert pieces._rewritten(corpus, table, seams, known) == [pieces._merged(p, table) for p in corpus]
    assert all(run in "".join(corpus) and len(run) > 1 for run in known)


def test_equal_stretches_are_rewritten_once(monkeypatch):
    """The work of a round follows the different stretches and not the pieces."""
    merged, calls = pieces._merged, []
    monkeypatch.setattr(pieces, "_merged", lambda *a: calls.append(a) or merged(*a))
    merges = [("ab", "\u1000"), ("\u1000a", "\u1001")]
    table = {pair: (order, new) for order, (pair, new) in enumerate(merges)}
    corpus = [f"{x}cabac{y}" for x in "defghij" for y in "defghij"]
    seams = pieces._keys(pieces._seams(merges))
    assert pieces._rewritten(corpus, table, seams, {}) == [f"{p[:2]}\u1001{p[5:]}" for p in corpus]
    assert len(calls) == 1
