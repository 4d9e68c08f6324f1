"""Super-k-mers: runs of neighbouring windows that share their minimiser, cut from a batch of sequences.

The minimiser of a window of k symbols is its smallest m-symbol gram by hash, leftmost among equals. Equal
windows have the same one at the same distance, so all copies of a window meet where their minimiser is
sent; a run of windows with one minimiser travels as one string. Two windows of one run are never equal:
their distances to the same place differ.

A hot minimiser would gather a large share of all rows in one place. Its runs are cut at fixed distances
to it, ``_GRID`` windows a piece, and each piece is sent by the symbols that all windows at these distances
have in common. Copies still meet, and different contexts of the hot gram part. Minimisers are hot from
the share HOT_SHARE of all runs on, so there are never more than 1 / HOT_SHARE of them, whatever the input.

A minimiser of one run alone repeats nothing, so its run stays at home. Which minimisers are repeated is told
by a sketch of BITS bits, the same size whatever the input: a bit is set if a repeated one falls on it. The
more of them there are the less it spares; results do not depend on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from repoquarry.llm.common import Rolling, mixed, smallest_within
from repoquarry.session import drop_table, materialize

HOT_SHARE = 1 / 16384
BITS = 1 << 27  # 16 MB
OCCURRENCE = np.dtype([("key", "<i8"), ("mark", "<i4"), ("at", "<i4")])
SCHEMA = "place bigint, string binary, first int, windows int, occurrences binary"
_POSITION = np.uint64(0xFFFFFFFF)


class Packer:
    """Strings travel compressed, each by itself, with a dictionary from SAMPLE texts at most. Equal strings
    are equal compressed; the dictionary changes no result."""

    SAMPLE, SIZE = 400, 32 << 10

    def __init__(self, texts: list[str]):
        self.raw = b" ".join(t.encode() for t in texts)[: 64 * self.SIZE]
        pieces = [self.raw[i : i + 300] for i in range(0, len(self.raw), 300)]
        try:
            self.dictionary = zstandard.train_dictionary(self.SIZE, pieces).as_bytes()
        except zstandard.ZstdError:  # too little text
            self.dictionary = self.raw[: self.SIZE]
        del self.raw

    @classmethod
    def of(cls, docs: DataFrame, text: str) -> Packer:
        rows = docs.select(F.col(text).alias("t")).where(F.length("t") > 0).limit(cls.SAMPLE)
        return cls([r["t"] for r in rows.select(F.substring("t", 1, 8000).alias("t")).collect()])

    def __getstate__(self):
        return {"dictionary": self.dictionary}

    @cached_property
    def _pair(self):
        words = zstandard.ZstdCompressionDict(self.dictionary)
        plain = dict(write_checksum=False, write_content_size=True, write_dict_id=False)
        packing = zstandard.ZstdCompressor(level=3, dict_data=words, **plain)
        return packing, zstandard.ZstdDecompressor(dict_data=words)

    def pack(self, string: bytes) -> bytes:
        return self._pair[0].compress(string)

    def unpack(self, string: bytes) -> bytes:
        return self._pair[1].decompress(string)


@dataclass
class Runs:
    """Of each run: first window, number of windows, minimiser hash, distance of the first window to it."""

    start: np.ndarray
    windows: np.ndarray
    place: np.ndarray
    first: np.ndarray


def runs(values: np.ndarray, ends: np.ndarray, k: int, m: int, grid: int, places: Places | None) -> Runs:
    """values: the symbols of all sequences, one after the other; ends: where each sequence ends; places:
    what is known of the minimisers, or None for all runs uncut."""
    n, grid = len(values), min(grid, k - m + 1)  # all windows of a piece have some symbols in common
    none = np.zeros(0, np.int64)
    if n < k:
        return Runs(none, none, none.astype(np.uint64), none)
    starts = np.concatenate([[0], ends[:-1]])
    long = ends - starts >= k
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts[long], 1)
    np.add.at(change, ends[long] - k + 1, -1)
    valid = np.cumsum(change[: n - k + 1]) > 0
    rolling = Rolling(values)
    grams = rolling.each(m)
    ranked = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    least = (smallest_within(ranked, k - m + 1) & _POSITION).astype(np.int64)
    windows = np.flatnonzero(valid)
    if not len(windows):
        return Runs(none, none, none.astype(np.uint64), none)
    least = least[windows]
    block = np.full(len(windows), -1, np.int64)
    place = grams[least]
    if places is not None:
        bit = (place & np.uint64(BITS - 1)).astype(np.int64)
        stay = (places.repeated[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
        windows, least, block, place = windows[stay], least[stay], block[stay], place[stay]
        if not len(windows):
            return Runs(none, none, none.astype(np.uint64), none)
    if places is not None and len(hot := places.hot):
        is_hot = hot[np.minimum(np.searchsorted(hot, place), len(hot) - 1)] == place
        block[is_hot] = (least[is_hot] - windows[is_hot]) // grid
    new = np.ones(len(windows), bool)
    new[1:] = (np.diff(least) != 0) | (np.diff(windows) != 1) | (np.diff(block) != 0)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(windows)))
    start, least, place, block = windows[at], least[at], place[at], block[at]
    cut = block >= 0
    if cut.any():
        a = least[cut] - block[cut] * grid  # first symbol of the nearest window, last symbol of the farthest one
        b = a - grid + 1 + k
        shared = rolling.of(np.clip(a, 0, n), np.clip(b, 0, n))
        place[cut] = mixed(shared + block[cut].astype(np.uint64))
    return Runs(start, count, place, least - start)


@dataclass
class Places:
    """Minimisers by their hashes: the hot ones in order, and the sketch of those with several runs."""

    hot: np.ndarray
    repeated: np.ndarray


def known_places(docs: DataFrame, places) -> Places:
    """``places`` maps batches of docs to counted hashes of minimisers."""
    spark, seen = docs.sparkSession, Observation()
    listed = docs.mapInArrow(places, "place bigint, n bigint").observe(seen, F.sum("n").alias("total"))
    several, path = materialize(listed.groupBy("place").agg(F.sum("n").alias("n")).where("n > 1"), "places")
    most = several.where(F.col("n") > 2).orderBy(F.desc("n"), "place").limit(int(1 / HOT_SHARE)).collect()
    total = seen.get["total"] if most else 0  # nothing is observed where nothing was read
    hot = np.array([r["place"] for r in most if r["n"] >= total * HOT_SHARE], np.int64).view(np.uint64)
    bit = F.col("place").bitwiseAND(F.lit(BITS - 1))
    part, inside = F.shiftright(bit, 15).alias("part"), bit.bitwiseAND(F.lit((1 << 15) - 1))
    sketch = np.zeros(BITS // 8, np.uint8)
    for r in several.select(part, inside.alias("b")).groupBy("part").agg(F.bitmap_construct_agg("b").alias("bits")).collect():
        sketch[r["part"] << 12 : (r["part"] + 1) << 12] = np.frombuffer(r["bits"], np.uint8)
    drop_table(spark, path)
    return Places(np.sort(hot), sketch)


def counted(places: np.ndarray) -> pa.RecordBatch:
    place, n = np.unique(places, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(place.view(np.int64)), pa.array(n.astype(np.int64))], ["place", "n"])


def packed(runs_: Runs, strings: list[bytes], key: np.ndarray, mark: np.ndarray, at: np.ndarray, packer: Packer) -> pa.RecordBatch:
    """Rows of SCHEMA: equal strings of the batch are one row with all their occurrences."""
    place_of = runs_.place.view(np.int64)
    occurrence = np.empty(len(strings), OCCURRENCE)
    occurrence["key"], occurrence["mark"], occurrence["at"] = key, mark, at
    index: dict[tuple[int, int, bytes], int] = {}
    groups = np.fromiter(
        (index.setdefault(x, len(index)) for x in zip(place_of.tolist(), runs_.first.tolist(), strings, strict=True)),
        np.int64,
        len(strings),
    )
    order = np.argsort(groups, kind="stable")
    first = np.searchsorted(groups[order], np.arange(len(index) + 1))
    data, picked = occurrence[order], order[first[:-1]]
    listed = pa.Array.from_buffers(
        pa.binary(), len(index), [None, pa.py_buffer((first * OCCURRENCE.itemsize).astype(np.int32)), pa.py_buffer(data)]
    )
    columns = [
        pa.array(place_of[picked]),
        pa.array([packer.pack(x[2]) for x in index], pa.binary()),
        pa.array(runs_.first[picked], pa.int32()),
        pa.array(runs_.windows[picked], pa.int32()),
        listed,
    ]
    return pa.RecordBatch.from_arrays(columns, ["place", "string", "first", "windows", "occurrences"])


@dataclass
class Meeting:
    """The different strings that met at one place. first: distance of their first window to the minimiser."""

    strings: list[bytes]
    first: list[int]
    windows: list[int]
    occurrences: list[np.ndarray]  # sorted


def meetings(batches: Iterator[pa.RecordBatch], packer: Packer) -> Iterator[Meeting]:
    """Places where something is repeated, from rows sorted by place. Places of one string that occurs once
    are left out: they hold no two equal windows."""
    rows: list[tuple] = []
    last = None

    def settled() -> Meeting | None:
        if len(rows) < 2 and (not rows or len(rows[0][3]) <= OCCURRENCE.itemsize):
            return None
        found: dict[tuple[bytes, int], list] = {}
        for string, first, windows, raw in rows:
            found.setdefault((string, first), [windows]).append(raw)
        occurrences = [np.unique(np.frombuffer(b"".join(x[1:]), OCCURRENCE)) for x in found.values()]
        if len(found) == 1 and len(occurrences[0]) < 2:
            return None
        return Meeting([packer.unpack(s) for s, _ in found], [f for _, f in found], [x[0] for x in found.values()], occurrences)

    for batch in batches:
        if not batch.num_rows:
            continue
        place = np.asarray(batch.column("place"))
        # rows that share their place with a neighbour, or have several occurrences; and those at the edges
        same = np.flatnonzero(place[1:] == place[:-1])
        wanted = np.zeros(len(place), bool)
        wanted[same] = wanted[same + 1] = wanted[0] = wanted[-1] = True
        raw = batch.column("occurrences")
        wanted |= np.diff(np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]) > OCCURRENCE.itemsize
        part = batch.take(pa.array(np.flatnonzero(wanted)))
        columns = [part.column(c).to_pylist() for c in ("string", "first", "windows", "occurrences")]
        for p, row in zip(place[wanted].tolist(), zip(*columns, strict=True), strict=True):
            if p != last:
                if (meeting := settled()) is not None:
                    yield meeting
                rows, last = [], p
            rows.append(row)
    if (meeting := settled()) is not None:
        yield meeting


MARKS = "__document_key bigint, __document_mark int, first int, end int"


def mark_rows(occurrences: list[np.ndarray], first: list[int], length: list[int]) -> pa.RecordBatch:
    """Rows of MARKS: for each array of occurrences the stretch at ``first`` of that length."""
    if not occurrences:
        return pa.RecordBatch.from_pylist([], pa.schema([("__document_key", pa.int64()), ("__document_mark", pa.int32()), ("first", pa.int32()), ("end", pa.int32())]))
    sizes = [len(o) for o in occurrences]
    all_ = np.concatenate(occurrences)
    start = all_["at"] + np.repeat(np.array(first, np.int32), sizes)
    end = start + np.repeat(np.array(length, np.int32), sizes)
    columns = [np.ascontiguousarray(all_["key"]), np.ascontiguousarray(all_["mark"]), start.astype(np.int32), end.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["__document_key", "__document_mark", "first", "end"])


def stretches(marks: DataFrame) -> DataFrame:
    """(__document_key, __document_mark, __stretches): all stretches of a document, in order."""
    return marks.groupBy("__document_key", "__document_mark").agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("__stretches"))
