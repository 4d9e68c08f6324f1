"""Suffix-array dedup over bytes: all copies of every stretch of k bytes that occurs more than once go.

A stretch of k bytes of one text that also starts anywhere else, in another text or the same one, is
repeated; each byte that a repeated stretch covers is removed, overlaps included, judged on the input.
Super-k-mers (see superkmers) bring the suffixes of equal beginnings together. At each place the suffixes
are sorted, deep and shallow: multikey quicksort on symbols of eight bytes parts them down to SHALLOW bytes,
and only groups with that long a common prefix are ordered further by blind tries. A blind trie is grown
breadth first: all suffixes of a group walk down along its first one, compare only until they branch off,
and those that branch off at the same depth with the same symbol are the group below that edge. A suffix that
walks k bytes along another one is repeated.

Null and empty texts and texts of fewer than k bytes lose nothing. Rows equal in id and text are one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from repoquarry.llm import superkmers
from repoquarry.llm.common import batch_of, keyed, slices, utf8, with_fields
from repoquarry.session import materialize, ship_package

LENGTH, GRAM, GRID = 400, 40, 64
SHALLOW = 32
_SORTED_BYTES = 1 << 20  # strings of whole places sorted together


def _grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, the first one first, and in that order the number of each row's group."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.cumsum(new)


def repeated_suffixes(data: bytes, start: np.ndarray, group: np.ndarray, k: int, shallow: int = SHALLOW) -> np.ndarray:
    """Which suffixes share k bytes with another one of their group; each has k bytes in ``data``, k >= 8."""
    symbols = np.ndarray(len(data) - 7, ">u8", buffer=data, strides=(1,))
    out = np.zeros(len(start), bool)
    member, of = np.arange(len(start)), group
    depth = 0
    while depth < min(shallow, k):  # multikey quicksort: each level parts every group by its next symbol
        at = min(depth, k - 8)
        order, of = _grouped(of, symbols[start[member] + at].astype(np.uint64))
        alone = np.bincount(of)[of] < 2
        member, of = member[order][~alone], of[~alone]
        depth = at + 8
        if depth == k:
            out[member] = True
            return out
    known = np.full(len(member), depth, np.int64)
    while len(member):  # blind tries: one branching level of all groups at a time
        _, leader, inverse = np.unique(of, return_index=True, return_inverse=True)
        first = member[leader][inverse]
        walk = np.flatnonzero(member != first)
        deep = known.copy()
        branched = np.zeros(len(member), bool)
        symbol = np.zeros(len(member), np.uint64)
        while len(walk):
            at = np.minimum(deep[walk], k - 8)
            own = symbols[start[member[walk]] + at].astype(np.uint64)
            apart = own != symbols[start[first[walk]] + at].astype(np.uint64)
            off = walk[apart]
            branched[off], symbol[off], deep[off] = True, own[apart], at[apart]
            walk, at = walk[~apart], at[~apart]
            done = at + 8 >= k
            out[member[walk[done]]] = out[first[walk[done]]] = True
            walk = walk[~done]
            deep[walk] = at[~done] + 8
        member, of, deep, symbol = member[branched], of[branched], deep[branched], symbol[branched]
        order, below = _grouped(of, deep, symbol)
        alone = np.bincount(below, minlength=1)[below] < 2 if len(below) else np.zeros(0, bool)
        member, known, of = member[order][~alone], deep[order][~alone] + 8, below[~alone]
    return out


def _repeats(held: list[superkmers.Meeting], k: int) -> pa.RecordBatch:
    """MARKS of several places at once."""
    spans, first, length = [], [], []
    strings, owner, distance, place = [], [], [], []
    for p, m in enumerate(held):
        for occurrences, windows in zip(m.occurrences, m.windows, strict=True):
            if len(occurrences) > 1:
                spans.append(occurrences)
                first.append(0)
                length.append(windows + k - 1)
        if len(m.strings) > 1:
            strings += m.strings
            owner += zip(m.occurrences, m.windows, strict=True)
            distance += m.first
            place += [p] * len(m.strings)
    if strings:
        windows = np.array([w for _, w in owner], np.int64)
        offset = np.cumsum([0, *map(len, strings)])[:-1]
        string = np.repeat(np.arange(len(strings)), windows)
        within = np.arange(len(string)) - np.repeat(np.cumsum(windows) - windows, windows)
        # suffixes with equal first k bytes have the minimiser at the same distance
        where = np.array(distance)[string] - within
        group = _numbered(np.array(place)[string], where)
        found = np.flatnonzero(repeated_suffixes(b"".join(strings) + bytes(8), offset[string] + within, group, k))
        s, w = string[found], within[found]
        new = np.ones(len(found), bool)
        new[1:] = (np.diff(s) != 0) | (np.diff(w) != 1)
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(found)))
        for i, n in zip(at.tolist(), count.tolist(), strict=True):
            occurrences = owner[s[i]][0]
            if len(occurrences) == 1:  # others are removed as they are
                spans.append(occurrences)
                first.append(int(w[i]))
                length.append(n + k - 1)
    return superkmers.mark_rows(spans, first, length)


def _numbered(*keys: np.ndarray) -> np.ndarray:
    order, number = _grouped(*keys)
    out = np.empty(len(order), np.int64)
    out[order] = number
    return out


def repeats(docs: DataFrame, text: str, k: int) -> DataFrame:
    """(__document_key, __document_mark, first, end): byte stretches covered by repeated ones, of documents with _key and _mark."""
    ship_package(docs.sparkSession)
    gram = min(GRAM, k)

    def places(batches):
        for whole in batches:
            for batch in slices(whole, text):
                data, at = utf8(batch.column(text))
                yield superkmers.counted(superkmers.runs(data, at[1:], k, gram, GRID, None).place)

    known = docs.sparkSession.sparkContext.broadcast(superkmers.known_places(docs.select(text), places))
    packer = superkmers.Packer.of(docs, text)

    def cut(batches):
        for whole in batches:
            for batch in slices(whole, text):
                data, at = utf8(batch.column(text))
                runs = superkmers.runs(data, at[1:], k, gram, GRID, known.value)
                if not len(runs.start):
                    continue
                raw, end = data.tobytes(), runs.start + runs.windows + k - 1
                strings = [raw[x:y] for x, y in zip(runs.start.tolist(), end.tolist(), strict=True)]
                row = np.searchsorted(at, runs.start, "right") - 1
                key, mark = np.asarray(batch.column("__document_key"))[row], np.asarray(batch.column("__document_mark"))[row]
                yield superkmers.packed(runs, strings, key, mark, runs.start - at[row], packer)

    def sort(batches):
        held, size = [], 0
        for meeting in superkmers.meetings(batches, packer):
            held.append(meeting)
            size += sum(map(len, meeting.strings))
            if size >= _SORTED_BYTES:
                yield _repeats(held, k)
                held, size = [], 0
        yield _repeats(held, k)

    sent = docs.select("__document_key", "__document_mark", text).mapInArrow(cut, superkmers.SCHEMA)
    return sent.repartition("place").sortWithinPartitions("place").mapInArrow(sort, superkmers.MARKS)


def remove_repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = LENGTH) -> DataFrame:
    """Documents with n_bytes, n_removed, removed (maximal stretches of bytes) and kept, the bytes left.

    k is 8 at least. kept is binary: a cut may fall inside a character.
    """
    if k < 8:
        raise ValueError("a stretch has at least eight bytes")
    held = keyed(docs, doc_id, text)
    marks, _ = materialize(superkmers.stretches(repeats(held, text, k)), "repeats")
    schema = with_fields(docs.schema, ("n_bytes", "bigint"), ("n_removed", "bigint"), ("removed", "array<struct<first:int,end:int>>"), ("kept", "binary"))
    spans = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def remove(batches):
        for batch in batches:
            data, at = utf8(batch.column(text))
            n, gone, removed, kept = [], [], [], []
            for a, b, marked in zip(at.tolist(), at[1:].tolist(), batch.column("__stretches").to_pylist(), strict=False):
                raw, out, left = data[a:b].tobytes(), [], 0
                merged: list[dict] = []
                for m in marked or ():
                    if merged and m["first"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], m["end"])
                    else:
                        merged.append(dict(m))
                for m in merged:
                    out.append(raw[left : m["first"]])
                    left = m["end"]
                out.append(raw[left:])
                whole = b"".join(out)
                n.append(len(raw))
                gone.append(len(raw) - len(whole))
                removed.append(merged)
                kept.append(whole)
            added = {"n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "removed": pa.array(removed, spans), "kept": pa.array(kept, pa.binary())}
            yield batch_of(batch, schema, added)

    rest = [c for c in held.columns if c.lower() != "__stretches"]
    return held.select(*rest).join(marks, ["__document_key", "__document_mark"], "left").mapInArrow(remove, schema)
