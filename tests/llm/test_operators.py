"""The training-data operators against brute force, on small texts with nulls, ties, repeats and long rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from repoquarry.llm import ann, bpe, chat, decontaminate, lattice, lines, quality, simhash, substring, suffixes
from repoquarry.llm.components import components

tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, _gone string, marks int, component_id string"


def corpus():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 7))) for _ in range(300)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30, 120))) for _ in range(30)]
    shared = " ".join(rng.choice(vocabulary) for _ in range(150))
    texts += [f"{texts[i]} {shared} {texts[i + 1]}" for i in range(8)] + [texts[0]] * 4
    texts += ["", " \n\t ", "one", "a " * 400, "x" * 3000, "Line one\nline ONE \n\n" + texts[2][:200] + "\n" + texts[2][:200]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(90, None), (3, texts[3]), (None, texts[5]), (None, None)]
    return [(i, t, "g", 1, "c") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def distinct_docs():
    """Each (id, text) once, in order of ids; null ids last."""
    return sorted({(2**63 - 1 if i is None else i, t) for i, t, *_ in corpus()}, key=lambda x: (x[0], x[1] or ""))


def test_substrings(docs, empty):
    seen, want = set(), {}
    for i, t in distinct_docs():
        words = (t or "").encode().split()
        gone = bytearray(len(words))
        for j in range(len(words) - 19):
            gram = tuple(words[j : j + 20])
            if gram in seen:
                gone[j : j + 20] = b"\1" * 20
            seen.add(gram)
        want[i, t] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode())
    rows = substring.dedup_substrings(docs).collect()
    assert len(rows) == len(corpus()) and rows[0]["_gone"] == "g" and rows[0]["marks"] == 1
    for r in rows:
        key = 2**63 - 1 if r["doc_id"] is None else r["doc_id"]
        assert (r["n_words"], r["n_removed"], r["kept"]) == want[key, r["text"]]
    assert substring.dedup_substrings(empty).count() == 0


def test_suffixes(docs, empty):
    k, count, want = 40, Counter(), {}
    for _, t in distinct_docs():
        b = (t or "").encode()
        count.update(b[j : j + k] for j in range(len(b) - k + 1))
    for i, t in distinct_docs():
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - k + 1):
            if count[b[j : j + k]] > 1:
                gone[j : j + k] = b"\1" * k
        want[i, t] = (len(b), sum(gone), bytes(x for x, g in zip(b, gone, strict=True) if not g))
    for r in suffixes.remove_repeated_bytes(docs, k=k).collect():
        key = 2**63 - 1 if r["doc_id"] is None else r["doc_id"]
        assert (r["n_bytes"], r["n_removed"], bytes(r["kept"])) == want[key, r["text"]]
        assert sum(s["end"] - s["first"] for s in r["removed"]) == r["n_removed"]
    assert suffixes.remove_repeated_bytes(empty).count() == 0


def test_deep_shallow_sort_marks_common_prefixes():
    rng = random.Random(1)
    parts = ["".join(rng.choice("ab") for _ in range(rng.choice([60, 60, 90]))) for _ in range(20)]
    parts += [p[:45] + "z" * 40 for p in parts[:10]]
    data = "".join(parts).encode() + bytes(8)
    start = np.cumsum([0, *map(len, parts)])[:-1]
    first = Counter(p[:48] for p in parts)
    found = suffixes.repeated_suffixes(data, start, np.zeros(len(start), np.int64), 48, 16)
    assert found.tolist() == [first[p[:48]] > 1 for p in parts]


def test_simhash(docs, empty):
    def mark(text):
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
        return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))

    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(corpus())
    assert all(r["simhash"] % 2**64 == mark(r["text"]) for r in rows)
    ids = sorted({(i, mark(t)) for i, t, *_ in corpus() if i is not None})  # texts without id occur with one
    low = {i: i for i, _ in ids}
    for _ in ids:
        for a, x in ids:
            for b, y in ids:
                if (x ^ y).bit_count() <= 3:
                    low[a] = low[b] = min(low[a], low[b])
    for r in rows:
        if r["doc_id"] is not None:
            assert r["component_id"] == low[r["doc_id"]]
    assert simhash.near_duplicates(empty).count() == 0


def test_bk_trees_find_all_neighbours():
    rng = np.random.default_rng(2)
    marks = rng.integers(0, 1 << 12, 500, dtype=np.uint64)
    marks = np.unique(marks)
    trees = simhash.Forest(np.zeros(len(marks), np.int64), marks)
    found = {(int(a), int(b)) for q, n in trees.near(np.arange(len(marks)), 3) for a, b in zip(q, n, strict=True)}
    want = {(i, j) for i in range(len(marks)) for j in range(len(marks)) if i != j and int(marks[i] ^ marks[j]).bit_count() <= 3}
    assert found == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lines(docs, empty):
    rows = lines.dedup_lines(docs).collect()
    assert len(rows) == len(corpus()) and rows[0]["_gone"] == "g"
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[90]["kept"] is None and by_id[90]["n_lines"] == 0
    assert by_id[0]["n_removed"] == 0 and by_id[38]["n_removed"] == by_id[38]["n_lines"] == 1 and by_id[38]["kept"] == ""
    last = by_id[47]
    assert last["n_lines"] == 4 and last["kept"].startswith("Line one\n\n") and last["n_removed"] == 2
    assert {tuple(x) for x in last["removed"]} >= {(1, 47, 0)}
    assert lines.dedup_lines(empty).count() == 0


def test_near_lines_are_linked(spark):
    words = [f"word{i}" for i in range(40)]
    variant = [*words]
    variant[20] = "other"
    rows = [(1, " ".join(words)), (2, "unlike " * 3), (3, "start\n" + " ".join(variant))]
    got = {r["doc_id"]: r["n_removed"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 1}


def brute_lines(rows):
    """n_lines, kept text and removed lines of each row by all pairs of different lines."""
    places = {}
    for i, t in rows:
        for n, raw in enumerate((t or "").split("\n")):
            if raw.strip(" \t\r\v\f"):
                places.setdefault(raw.strip(" \t\r\v\f").lower(), []).append((i, n))
    sets = {x: {x[j : j + 16] for j in range(max(1, len(x) - 15))} for x in places}
    root = {x: x for x in places}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, a in sets.items():
        for y, b in sets.items():
            if x < y and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                root[find(x)] = find(y)
    groups = {}
    for x, at in places.items():
        groups.setdefault(find(x), []).extend(at)
    stays = {p: min(at) for at in groups.values() for p in at}
    out = {}
    for i, t in rows:
        parts = (t or "").split("\n")
        gone = [(n, *stays[i, n]) for n in range(len(parts)) if stays.get((i, n), (i, n)) != (i, n)]
        left = "\n".join(x for n, x in enumerate(parts) if n not in {g[0] for g in gone})
        out[i] = (sum(bool(x.strip(" \t\r\v\f")) for x in parts), gone, left)
    return out


def check_lines(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_lines"], [tuple(x) for x in r["removed"]], r["kept"]) for r in lines.dedup_lines(table).collect()}
    assert got == brute_lines(rows)
    return got


def test_lines_without_blanks_and_long_words(spark):
    rng = random.Random(8)

    def word(n):
        return "".join(rng.choice("abcdefgh漢字線文𝒳") for _ in range(n))

    host = "https://example.org/catalogue/"
    rows = [(i, "\n".join(host + word(40) for _ in range(4))) for i in range(6)]
    long = [word(30) for _ in range(5)]
    other = [w[:20] + word(10) for w in long]  # equal in the first characters of all words
    rows += [(10, " ".join(long)), (11, " ".join(other)), (12, word(400)), (13, "ab"), (14, "AB \n" + word(16))]
    rows += [(20, rows[8][1] + "x"), (21, rows[0][1].split("\n")[0] + "/"), (22, " ".join(long) + "\n" + word(17))]
    got = check_lines(spark, rows)
    assert [i for i in got if got[i][1]] and not any(got[i][1] for i in got if i < 13)


def test_all_pairs_of_a_bucket_are_verified(spark):
    rng = random.Random(9)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(n))

    def least(line):
        hashes = {xxhash.xxh64_intdigest(line[j : j + 16], seed=42) for j in range(len(line) - 15)}
        return sorted(h - (h >> 63 << 64) for h in hashes)[:4]

    # many different lines with the smallest hashes of one template, and a near copy of each: all in the same buckets
    template = words(25)
    texts = [template] * 3
    while len(texts) < 63:
        line = f"{template} {words(12)}"
        near = f"{line} {words(1)}"
        if least(line) == least(near) == least(template):
            texts += [line, near]
    got = check_lines(spark, list(enumerate(texts)))
    assert sum(len(x[1]) for x in got.values()) == 32


def test_long_lines_hand_in_few_hashes(spark, monkeypatch):
    """The search for the rest holds as many rows of a long line as its threshold needs, and finds its near copies."""
    rng, made = random.Random(21), []
    keep = lines.materialize

    def counted(df, name="stage"):
        table, path = keep(df, name)
        made.append((name, table.count()))
        return table, path

    monkeypatch.setattr(lines, "materialize", counted)

    def word(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    shared = word(1500)
    texts = [f"{shared}{word(900)}|{i}" for i in range(6)]
    texts += [f"{t[:1100]}{word(60)}{t[1100:2100]}" for t in texts[:3]]
    got = check_lines(spark, list(enumerate(texts)))
    assert sum(len(x[1]) for x in got.values()) == 3
    assert 0 < sum(n for name, n in made if name == "rest") <= 28 * len(texts)


def test_lines_that_share_a_passage_are_not_compared(spark, monkeypatch):
    """Lines of one length that have a third in common make no pairs to verify, and near copies among them are found."""
    rng, made = random.Random(33), []
    keep = lines.materialize

    def counted(df, name="stage"):
        table, path = keep(df, name)
        made.append((name, table.count()))
        return table, path

    monkeypatch.setattr(lines, "materialize", counted)

    def word(n):
        return "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))

    passage = word(200)
    texts = [f"{word(200)}{passage}{word(200)}|" for _ in range(30)]
    texts += [f"{t}{word(20)}|" for t in texts[:4]]
    got = check_lines(spark, list(enumerate(texts)))
    assert sum(len(x[1]) for x in got.values()) == 4
    assert sum(n for name, n in made if name == "others") <= 4


@pytest.mark.parametrize("common", lines.COMMON)
def test_handed_in_hashes_of_similar_lines(spark, common):
    """Lines at the threshold have as many handed-in hashes in common as they need, by all their hashes."""
    rng = random.Random(common)

    def word(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    pairs = []
    for n in (5, 20, 60, 200, 900):
        for text in (word(n + 15), (word(40) * 30)[: n + 15]):
            cut = n // 5
            pairs += [(text, text[cut:]), (text, text[: n + 15 - cut])]
    rows = [(i, side, t) for i, p in enumerate(pairs) for side, t in enumerate(p)]
    df = spark.createDataFrame(rows, "i int, side int, t string")
    exact, quick = (lines.smallest(F.col("t"), 0.8, common, x) for x in (True, False))
    found = df.select("i", "side", "t", exact.alias("e"), quick.alias("q")).select("*", lines.needed(F.col("e.size"), 0.8, common).alias("need")).collect()
    of = {(r["i"], r["side"]): r for r in found}
    for r in found:
        assert r["e"]["size"] == len({r["t"][j : j + 16] for j in range(max(1, len(r["t"]) - 15))})
        assert set(r["q"]["first"]) >= set(r["e"]["first"]) and r["e"]["first"] == sorted(set(r["e"]["first"]))
    for i, (a, b) in enumerate(pairs):
        x, y = ({t[j : j + 16] for j in range(max(1, len(t) - 15))} for t in (a, b))
        if len(x & y) >= 0.8 * len(x | y) - 1e-9:
            p, q = of[i, 0], of[i, 1]
            for kind in "eq":
                assert len(set(p[kind]["first"]) & set(q[kind]["first"])) >= max(p["need"], q["need"])


def test_white_space_around_lines(spark):
    got = check_lines(spark, [(1, "x\r\n\r\n\t\r\n\ty\t\n\f"), (2, "\r\nx\n\t\n y\r\nz \t\n  ")])
    assert got[1] == (2, [], "x\r\n\r\n\t\r\n\ty\t\n\f") and got[2] == (3, [(1, 1, 0), (3, 1, 3)], "\r\n\t\nz \t\n  ")


def test_decontamination(spark, docs, empty):
    text = corpus()[0][1]
    passage = " ".join(text.split()[3:20]).upper().replace("É", "é").replace("SS", "ß")
    items = spark.createDataFrame([(1, text.lower()), (2, "one"), (3, ""), (4, None), (None, text), (2, "one"), (5, passage)], "item_id long, text string")
    found = decontaminate.contamination(docs, items).collect()
    assert len(found) == len(corpus())
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[42]["items"] == [] and by_id[90]["n_words"] == 0
    assert 1 in by_id[0]["items"] and len(by_id[0]["hits"]) == by_id[0]["n_words"]
    one = next(r for r in found if r["text"] == "one")
    assert one["items"] == [2] and len(one["hits"]) == 1
    cut = decontaminate.contamination(docs, items)
    clean = {r["doc_id"]: r["t"] for r in cut.select("doc_id", decontaminate.without_hits(cut).alias("t")).collect()}
    assert clean[0].strip() == "" and clean[90] is None and clean[1] == corpus()[1][1]
    assert decontaminate.contamination(empty, items).count() == 0
    assert all(not r["hits"] for r in decontaminate.contamination(docs, items.limit(0)).collect())


def test_benchmark_is_cut_from_documents(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    passage = " ".join(f"Wörd{i}" for i in range(12))
    rows = [(1, f"ä, {passage}! öü {passage}ß"), (2, passage), (3, "ü clean"), (4, ""), (5, None), (None, f"{passage}. é é"), (1, f"é {passage}")]
    docs = spark.createDataFrame([(i, t, "de", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(7, passage.lower().replace("Ö", "ö"))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    cut = corpus_pipeline.cut_benchmark(spark, docs, str(tmp_path))
    assert cut.columns == docs.columns
    last = " ".join(passage.split()[-1:])
    got = Counter((r["doc_id"], r["text"], r["n_chars"]) for r in cut.collect())
    texts = [(1, f"ä, ! öü  {last}ß"), (3, "ü clean"), (4, ""), (5, None), (None, ". é é"), (1, "é ")]
    assert got == Counter((i, t, None if t is None else len(t)) for i, t in texts)


def test_byte_bpe(docs, empty):
    tiktoken = pytest.importorskip("tiktoken")
    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    for r in bpe.decode(bpe.encode(docs, path, tokenizers.PATTERN), path, tokenizers.PATTERN).collect():
        text = r["text"] or ""
        assert np.frombuffer(r["token_ids"], "<u4").tolist() == own.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode()
    assert bpe.encode(empty, path, tokenizers.PATTERN).count() == 0


def test_lattice(docs, empty):
    pieces = lattice.Pieces([b" a", b"a", b"b", b"ab", b" ab"], np.arange(5, 261), 261, np.log(np.full(262, 1 / 262)))

    def brute(word, memo=None):
        memo = {} if memo is None else memo
        if not word:
            return 1.0
        if word not in memo:
            ways = 1 / 262 * brute(word[1:], memo)
            memo[word] = ways + sum(1 / 262 * brute(word[len(p) :], memo) for p in pieces.strings if word.startswith(p))
        return memo[word]

    words = [b"ab", b"abba", b"", b"zz", b"ab" * 30]
    assert np.allclose(lattice.Lattice(pieces).log_probability(words), [np.log(brute(b" " + w)) for w in words])
    held = docs.withColumn("held", F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False)))
    rows = lattice.score_texts(held, tokenizers.path("piece_bpe_32k.model"), "held").collect()
    count = Counter()
    for i, t, *_ in corpus():
        if i is None or i % 2 == 0:
            count.update([*(t or "").encode().lower().split(), None])
    total, kinds = sum(count.values()), len(count)
    sums = Counter()
    for i, t, *_ in corpus():
        tokens = [*(t or "").encode().lower().split(), None]
        base = sum(np.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens)
        sums[i, len(tokens), sum(count[w] > 0 for w in tokens), round(base, 6)] += 1
    assert sums == Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in rows)
    assert all(r["train_tokens"] == total and r["score"] < 0 for r in rows)
    assert lattice.score_texts(empty.withColumn("held", F.lit(False)), tokenizers.path("piece_bpe_32k.model"), "held").count() == 0


def test_quality(spark, docs, empty):
    rng = random.Random(3)
    good = [(i, " ".join(rng.choice(["the", "cat", "sat", "on", "mat"]) for _ in range(40))) for i in range(120)]
    bad = [(i, " ".join(rng.choice(["THE!!", "cat%%%", "$$$", "on&&&"]) for _ in range(40))) for i in range(200, 320)]
    texts = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 200)) for i, _ in good + bad] + [(None, 1), (5, None)], "doc_id long, quality int")
    held = {i for i, _ in good + bad if zlib.crc32(str(i).encode()) % 4 == 2}
    scored = quality.score_quality(texts, labels.where(~F.col("doc_id").isin(held))).collect()
    assert all(r["predicted"] == (r["doc_id"] < 200) for r in scored if r["doc_id"] in held)
    assert all(0 <= r["score"] <= 1 for r in quality.score_quality(docs, labels).collect())
    assert {r["score"] for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(empty, labels).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "assistant", "b")]
    rows += [(4, 0, "user", "a"), (4, 1, "assistant", "c"), (4, 1, "assistant", "c"), (5, None, None, None), (None, 0, "user", "a")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: (r["n_turns"], r["copies"], r["rendered"]) for r in chat.render(chat.collapse(turns)).collect()}
    assert set(got) == {1, 4, 5} and got[1][:2] == (2, 2) and got[4][:2] == (2, 1)
    assert got[1][2] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert got[5][2] == "<|im_start|>unknown\n<|im_end|>\n"
    assert chat.collapse(turns.limit(0)).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(600, 16)).round(3)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(600 + i, vectors[0].tolist()) for i in range(30)]
    rows += [(700, None), (701, [0.0] * 16), (702, [float("nan")] * 16), (703, [1.0]), (None, vectors[1].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(table, F.col("vec_id") % 50 == 0).collect()
    own = {i: np.array(v, np.float32).astype(float) for i, v in rows[:630]}
    hit = 0
    queries = [i for i in own if i % 50 == 0]
    for q in queries:
        best = sorted((float(np.sqrt(((v - own[q]) ** 2).sum())), i) for i, v in own.items() if i != q)[:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        hit += len({m[1] for m in mine} & {i for _, i in best})
        if q in (0, 600):
            assert [m[1] for m in mine] == [i for _, i in best]
    assert hit >= 9 * len(queries)
    assert ann.nearest(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("few", [100, 0])
def test_nearest_in_thin_regions(spark, monkeypatch, few):
    monkeypatch.setattr(ann, "FEW", few)
    rng = np.random.default_rng(6)
    vectors = np.concatenate([rng.normal(size=(400, 8)) * 0.01 + 5, rng.normal(size=(60, 8)) * 100, rng.normal(size=(5, 8)) * 1e5])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    queries = [0, 100, *range(400, 465, 5), 464]
    got = ann.nearest(table, F.col("vec_id").isin(queries)).collect()
    hit = 0
    for q in queries:
        far = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        far[q] = np.inf
        mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        hit += len({m[1] for m in mine} & set(np.argsort(far)[:10].tolist()))
    assert hit >= 9 * len(queries)
    pair = ann.nearest(table.where("vec_id in (0, 400, 464)"), F.col("vec_id") >= 0).collect()
    assert Counter(r["query_id"] for r in pair) == {0: 2, 400: 2, 464: 2}


def test_pipeline_stages(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    base = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{base}/documents.parquet")
    kept = corpus_pipeline.keep_good(spark, source, base)
    assert kept.columns == source.columns
    assert {r["doc_id"] for r in kept.collect()} <= {r["doc_id"] for r in source.collect()}
    result = corpus_pipeline.run(spark, base).collect()
    assert result and all(r["same"] for r in result)
    assert hashlib.sha256(bytes(result[0]["token_ids"])).hexdigest()
