"""Every pipeline stage row by row against plain Python, beside columns named like the operators' results."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from repoquarry.llm import bpe, lines, quality, simhash
from tests.llm.test_operators import brute_lines

tokenizers = pytest.importorskip("public_tokenizers")
pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = (
    "tag string, doc_id long, text string, n_chars long, score double, kept string, n_words long, predicted int, hits string,"
    " items string, removed string, n_lines long, n_removed long, simhash long, component_id string"
)
EXTRA = (0.25, "mine", -1, 7, "h", "i", "r", -2, -3, 5, "c")


def words(rng, n, letters="abcdefghij"):
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(n)]


def texts():
    """Good and bad texts, exact and near copies, repeated lines, benchmark passages, one text of 2 MB."""
    rng = random.Random(11)
    passage = " ".join(words(rng, 14, "klmnop"))
    out = []
    for i in range(40):
        bad = i % 3 == 2
        body = words(rng, rng.randrange(20, 90), "vwxyz#%" if bad else "abcdefghij")
        cut = rng.randrange(5, 15)
        out.append(" ".join(body[:cut]) + "\n" + " ".join(body[cut:]))
    out += [out[0], out[1], out[3] + " xx", out[4].replace(" ", "  ", 1), f"{out[6]} {passage} end", passage.upper(), f"see: {passage}."]
    out += ["", "  \n\t", "one", "\r\n".join([out[9].split("\n")[1]] * 3), " ".join(words(rng, 350_000)), None]
    return out, passage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")
    rows, passage = texts()
    labels = [(i, int(i % 3 != 2), 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(base / "labels.parquet"))
    items = [(1, passage), (2, "too short"), (3, None), (4, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(base / "benchmark.parquet"))
    return str(base)


@pytest.fixture(scope="module")
def docs(spark):
    rows, _ = texts()
    made = [(f"t{i}", i, t, None if t is None else len(t), *EXTRA) for i, t in enumerate(rows)]
    made += [("null id", None, rows[5], len(rows[5]), *EXTRA), ("again", 7, rows[7], len(rows[7]), *EXTRA)]
    return spark.createDataFrame(made, SCHEMA).repartition(4)


def result(df, columns):
    """{tag: text}, after a check that every other column is as it was."""
    assert df.columns == columns
    out = {}
    for r in df.collect():
        assert tuple(r)[4:] == EXTRA, r["tag"]
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"])), r["tag"]
        out[r["tag"]] = r["text"]
    return out


def test_quality_stage(spark, docs, folder):
    vectors, network = quality.fit(docs, pipeline.learnable(pipeline.table(spark, folder, "labels")), "doc_id", "text", "quality")
    want = {}
    for r in docs.collect():
        batch = pa.RecordBatch.from_pydict({"text": pa.array([r["text"]], pa.string())})
        slots, _ = quality.token_slots(batch, "text")
        mean = np.zeros(quality.WIDTH)
        for slot in slots.tolist():
            mean += vectors[slot] / len(slots)
        x = np.append(mean, np.log1p(len(slots)))
        w1, b1, w2, b2 = network.weights
        logit = np.tanh((x - network.mean) / network.scale @ w1 + b1) @ w2 + b2
        if 1 / (1 + np.exp(-logit[0] / network.temperature)) >= 0.7:
            want[r["tag"]] = r["text"]
    got = result(pipeline.keep_good(spark, docs, folder), docs.columns)
    assert got == want and 20 < len(got) < docs.count()


def test_lines_stage(spark, docs, folder):
    unique = docs.where("tag not in ('null id', 'again')")
    got = result(pipeline.drop_repeated_lines(spark, unique, folder), docs.columns)
    want = brute_lines([(r["doc_id"], r["text"]) for r in unique.collect()])
    assert got == {f"t{i}": None if t is None and not left else left for (i, (_, _, left)), t in zip(sorted(want.items()), texts()[0], strict=True)}


def test_near_duplicates_stage(spark, docs, folder):
    rows = docs.collect()
    marks = [simhash.fingerprint((r["text"] or "").encode()) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same_id = rows[i]["doc_id"] is not None and rows[i]["doc_id"] == rows[j]["doc_id"]
            if same_id or (marks[i] ^ marks[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    smallest = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            smallest[find(i)] = min(smallest.get(find(i), r["doc_id"]), r["doc_id"])
    want = {r["tag"]: r["text"] for i, r in enumerate(rows) if r["doc_id"] is None or smallest[find(i)] == r["doc_id"]}
    assert result(pipeline.drop_near_duplicates(spark, docs, folder), docs.columns) == want


def test_decontamination_stage(spark, docs, folder):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    windows = set()
    for item in (texts()[1], "too short"):
        w = pattern.findall(lower(item))
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    want = {}
    for r in docs.collect():
        text = r["text"]
        found = list(pattern.finditer(lower(text or "")))
        w, hit = [m.group() for m in found], [False] * len(found)
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit[i : i + n] = [True] * n
        if found and all(hit):
            continue
        cut, last = "", 0
        for i, m in enumerate(found):
            if hit[i] and not (i and hit[i - 1]):
                cut += text[last : m.start()]
            if hit[i]:
                last = m.end()
        want[r["tag"]] = None if text is None else cut + text[last:]
    got = result(pipeline.cut_benchmark(spark, docs, folder), docs.columns)
    assert got == want and sum(got[t] != r for t, r in ((f"t{i}", x) for i, x in enumerate(texts()[0])) if t in got) >= 2


def test_tokens_stage(spark, docs, folder):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.read_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = pipeline.to_tokens(spark, docs, folder)
    assert rows.columns == ["doc_id", "n_tokens", "token_ids", "same"]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], bytes(r["token_ids"]), r["same"]) for r in rows.collect())
    want = []
    for r in docs.collect():
        ids = own.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"] is None, r["doc_id"] or 0, len(ids), np.array(ids, "<u4").tobytes(), True))
    assert got == sorted(want)


def test_stages_of_empty_documents(spark, docs, folder):
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_recall_on_a_skewed_table(spark):
    """Thousands of lines of one template, each with a near copy: links found by the bands."""
    rng = random.Random(5)
    template = " ".join(words(rng, 14, "abcdefghijklmnop"))
    rows, twins = [], 1400
    for i in range(twins):
        own = words(rng, 12, "abcdefghijklmnop")
        near = [*own]
        near[rng.randrange(12)] = "changed"[: rng.randrange(2, 8)]
        rows += [(2 * i, f"{template} {' '.join(own)}"), (2 * i + 1, f"{template} {' '.join(near)}")]
    sets = [{t[j : j + lines.SHINGLE] for j in range(len(t) - lines.SHINGLE + 1)} for _, t in rows]
    near = [i for i in range(twins) if len(sets[2 * i] & sets[2 * i + 1]) >= 0.8 * len(sets[2 * i] | sets[2 * i + 1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    removed = {r["doc_id"] for r in lines.dedup_lines(df).where("n_removed > 0").collect()}
    found = sum(2 * i + 1 in removed for i in near)
    print(f"found {found} of {len(near)} links")
    assert len(near) > 200 and found >= 0.95 * len(near)
    assert removed <= {2 * i + 1 for i in near} | {2 * i for i in near}


@pytest.mark.parametrize("slice_characters", [1 << 24, 20_000])
def test_every_link_of_a_skewed_table(spark, monkeypatch, slice_characters):
    """The same with lines that barely reach the threshold: none is left out, in one share of neighbours or in several."""
    monkeypatch.setattr(lines, "SLICE_CHARACTERS", slice_characters, raising=False)
    rng = random.Random(11)
    template = " ".join(words(rng, 14, "abcdefghijklmnop"))
    rows = []
    for i in range(500):
        own = " ".join(words(rng, 12, "abcdefghijklmnop"))
        line, near = f"{template} {own}", ""
        # cut from the end as far as the threshold allows
        n = len({line[j : j + lines.SHINGLE] for j in range(len(line) - lines.SHINGLE + 1)})
        for cut in range(n // 4, 0, -1):
            near = line[:-cut].strip()
            if n - cut >= lines.THRESHOLD * n:
                break
        rows += [(2 * i, line), (2 * i + 1, near)]
    sets = [{t[j : j + lines.SHINGLE] for j in range(len(t) - lines.SHINGLE + 1)} for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= lines.THRESHOLD * len(a | sets[j]) - 1e-9:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["removed"][0]["kept_id"] for r in lines.dedup_lines(df).where("n_removed > 0").collect()}
    assert got == {i: find(i) for i in range(len(rows)) if find(i) != i}
    assert len(got) > 300
