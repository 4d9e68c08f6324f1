"""Benchmark decontamination: a broadcast set of normalised benchmark n-grams, scanned over all texts.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lowered. Every n
consecutive words of a benchmark item are a window; an item with fewer words, but not none, is one
window. Null and empty texts have no words; rows repeated in either table count each by themselves in
documents and once in the benchmark. Null item ids take no part. Empty tables give no hits.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repoquarry.llm.common import SLICE, Rolling, batch_of, slices, utf8, with_fields
from repoquarry.session import drop_table, materialize, ship_package

WINDOW = 10
BLOCK_BYTES = 24 << 20  # n-grams handed to the tasks at once; a larger benchmark is scanned in several blocks
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_IS_WORD = np.ones(256, bool)
_IS_WORD[:0x30] = _IS_WORD[0x3A:0x61] = _IS_WORD[0x7B:0x80] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def item_windows(items: DataFrame, item_id: str, text: str, window: int = WINDOW) -> DataFrame:
    """(ngram, words, item): the different windows of each item, words joined by one space."""
    words = F.regexp_extract_all(F.translate(F.col(text), _UPPER, _LOWER), F.lit(_WORD), F.lit(0))
    listed = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item"), words.alias("w"))
    listed = listed.where(F.size("w") > 0).withColumn("words", F.least(F.size("w"), F.lit(window)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("words") + 1)
    grams = F.transform(starts, lambda i: F.concat_ws(" ", F.slice("w", i, F.col("words"))))
    return listed.select("item", "words", F.explode(grams).alias("ngram")).distinct()


class _Grams:
    """The n-grams of one block, by number of words: hashes in order, their words, their items."""

    def __init__(self, rows: list):
        self.items: dict[bytes, list] = defaultdict(list)
        by_length: dict[int, set[bytes]] = defaultdict(set)
        for r in rows:
            gram = r["ngram"].encode()
            self.items[gram].append(r["item"])
            by_length[r["words"]].add(gram)
        self.hashes = {}
        for n, grams in by_length.items():
            data, starts, ends = _words(np.frombuffer(b"\n".join(grams), np.uint8), None)
            hashes = Rolling(Rolling(data).of(starts, ends)).each(n)[::n]
            seen = np.zeros(1 << 20, bool)
            seen[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.hashes[n] = np.sort(hashes), seen


def _words(data: np.ndarray, offsets: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes and the places of words, which end at the end of a text."""
    data = _FOLD[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IS_WORD[data]
    change = inside[1:] != inside[:-1]
    first, last = change & inside[1:], change & inside[:-1]
    if offsets is not None and len(data):
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < len(data))]
        cut = edge[inside[edge] & inside[edge + 1]]
        first[cut] = last[cut] = True
    return data, np.flatnonzero(first), np.flatnonzero(last)


def _scan(batch: pa.RecordBatch, text: str, grams: _Grams) -> tuple[np.ndarray, list, list]:
    """Per row: number of words, hit stretches as (first, end) byte places, and items."""
    data, offsets = utf8(batch.column(text))
    data, starts, ends = _words(data, offsets)
    first = np.searchsorted(starts, offsets)  # first word of each text
    hashes = Rolling(data).of(starts, ends)
    rolling = Rolling(hashes)
    row_of = np.repeat(np.arange(batch.num_rows), np.diff(first))
    covered = np.zeros(len(starts) + 1, np.int64)
    items: dict[int, set] = defaultdict(set)
    for n, (known, seen) in grams.hashes.items():
        here = rolling.each(n)
        at = np.flatnonzero(seen[(here >> np.uint64(44)).astype(np.int64)])
        at = at[row_of[at] == row_of[at + n - 1]]
        at = at[known[np.minimum(np.searchsorted(known, here[at]), len(known) - 1)] == here[at]]
        for i in at.tolist():  # verified on the words themselves
            gram = b" ".join(data[a:b].tobytes() for a, b in zip(starts[i : i + n], ends[i : i + n], strict=True))
            found = grams.items.get(gram)
            if found:
                covered[i] += 1
                covered[i + n] -= 1
                items[int(row_of[i])].update(found)
    hit = np.cumsum(covered[:-1]) > 0
    places = [[] for _ in range(batch.num_rows)]
    for i in np.flatnonzero(hit).tolist():
        row = int(row_of[i])
        places[row].append((i - int(first[row]), int(starts[i] - offsets[row]), int(ends[i] - offsets[row])))
    return np.diff(first), places, [sorted(items[i]) if i in items else [] for i in range(batch.num_rows)]


def contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW
) -> DataFrame:
    """Every document with n_words, hits (word number, first and end byte of each hit word) and items.

    The n-grams are written, sized and split into blocks of BLOCK_BYTES at most by a hash; each block is
    fetched, broadcast and scanned by itself, and the blocks' hits are united. A usual benchmark is one.
    """
    spark = docs.sparkSession
    ship_package(spark)
    grams, path = materialize(item_windows(items, item_id, item_text, window), "ngrams")
    bytes_, kind = grams.agg(F.sum(F.octet_length("ngram") + 100)).first()[0] or 0, grams.schema["item"].dataType.simpleString()
    blocks = max(1, -(-2 * bytes_ // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("ngram", "item"), F.lit(blocks))
    for i in range(blocks):
        held = spark.sparkContext.broadcast(_Grams(grams.where(block == i).collect()))
        docs = _with_hits(docs, text, held, kind, first=i == 0)
        if i % 8 == 7:
            docs, _ = materialize(docs, "scanned")
    drop_table(spark, path)
    return docs


def _with_hits(docs: DataFrame, text: str, held, kind: str, first: bool) -> DataFrame:
    names = ("n_words", "hits", "items")
    fields = (("n_words", "bigint"), ("hits", "array<struct<word:int,first:int,end:int>>"), ("items", f"array<{kind}>"))
    schema = with_fields(docs.schema, *fields)
    types = {n: t for n, t in zip(names, (pa.int64(), pa.list_(pa.struct([("word", pa.int32()), ("first", pa.int32()), ("end", pa.int32())])), None), strict=True)}
    from pyspark.sql.pandas.types import to_arrow_type

    types["items"] = to_arrow_type(schema["items"].dataType)

    def scan(batches):
        grams = held.value
        for whole in batches:
            for batch in slices(whole, text, SLICE):
                words, places, items = _scan(batch, text, grams)
                if not first:
                    before = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
                    places = [sorted({*p, *((h["word"], h["first"], h["end"]) for h in q)}) for p, q in zip(places, before[0], strict=True)]
                    items = [sorted({*a, *b}) for a, b in zip(items, before[1], strict=True)]
                hits = [[{"word": w, "first": a, "end": b} for w, a, b in p] for p in places]
                added = {"n_words": pa.array(words, pa.int64()), "hits": pa.array(hits, types["hits"]), "items": pa.array(items, types["items"])}
                yield batch_of(batch, schema, added)

    return docs.mapInArrow(scan, schema)


def without_hits(docs: DataFrame, text: str = "text") -> Column:
    """The text of a scanned document without its hit words, cut between words: runs of hits go with the
    blanks inside them. Texts without hits are left as they are."""
    # columns of docs itself: a name inside a function would mean a new column of the same select
    whole, hits = docs[text], docs["hits"]
    raw = whole.cast("binary")
    ends, starts, words = hits["end"], hits["first"], hits["word"]
    kept_from = F.concat(F.array(F.lit(0)), ends)
    kept_to = F.concat(starts, F.array(F.octet_length(whole)))
    pieces = F.transform(
        F.arrays_zip(kept_from.alias("a"), kept_to.alias("b"), F.concat(F.array(F.lit(-2)), words).alias("p"), F.concat(words, F.array(F.lit(-2))).alias("n")),
        lambda z: F.when(z["n"] == z["p"] + 1, F.lit("")).otherwise(
            F.substring(raw, z["a"] + 1, z["b"] - z["a"]).cast("string")
        ),
    )
    return F.when(F.size(hits) > 0, F.array_join(pieces, "")).otherwise(whole)
