"""Substring dedup over words: each window of k words stays where it first occurs.

Words are runs of other characters than blank, tab, line feed, vertical tab, form feed and carriage return.
A window is k neighbouring words of a text; it is a repeat if its words also start earlier: in a document
with a smaller id, or earlier in the same one. Every word that a repeat covers is removed; windows are
judged on the input. Super-k-mers (see superkmers) carry the windows to where equal ones meet; there the
windows are sorted, and all but the earliest of equal ones are marked.

Null and empty texts, and texts of fewer than k words, lose nothing. Rows equal in id and text are one
document; rows of one id with different texts are ordered by their texts' hash. A null id is the last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from repoquarry.llm import superkmers
from repoquarry.llm.common import Rolling, batch_of, keyed, slices, utf8, with_fields
from repoquarry.session import materialize, ship_package

WINDOW, GRAM, GRID = 20, 4, 6


def _words(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words joined by one blank each: bytes, word starts and ends, and for each row the number of
    words up to its end."""
    data, at = utf8(batch.column(text))
    raw = data.tobytes()
    rows = [raw[a:b].split() for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
    joined = np.frombuffer(b" ".join(b" ".join(r) for r in rows if r), np.uint8)
    ends = np.append(np.flatnonzero(joined == 32), len(joined)) if len(joined) else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    return joined, starts, ends, np.cumsum([len(r) for r in rows])


def _runs(batch: pa.RecordBatch, text: str, k: int, places: superkmers.Places | None):
    joined, starts, ends, until = _words(batch, text)
    hashes = Rolling(joined).of(starts, ends)
    return joined, starts, ends, until, superkmers.runs(hashes, until, k, min(GRAM, k), GRID, places)


def repeats(docs: DataFrame, text: str, k: int) -> DataFrame:
    """(__document_key, __document_mark, first, end): word stretches covered by repeats, of documents with _key and _mark."""
    ship_package(docs.sparkSession)

    def places(batches):
        for whole in batches:
            for batch in slices(whole, text):
                yield superkmers.counted(_runs(batch, text, k, None)[-1].place)

    known = docs.sparkSession.sparkContext.broadcast(superkmers.known_places(docs.select(text), places))
    packer = superkmers.Packer.of(docs, text)

    def cut(batches):
        for whole in batches:
            for batch in slices(whole, text):
                joined, starts, ends, until, runs = _runs(batch, text, k, known.value)
                if not len(runs.start):
                    continue
                raw = joined.tobytes()
                a, b = starts[runs.start], ends[runs.start + runs.windows + k - 2]
                strings = [raw[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                row = np.searchsorted(until, runs.start, "right")
                before = np.concatenate([[0], until[:-1]])[row]
                key, mark = np.asarray(batch.column("__document_key"))[row], np.asarray(batch.column("__document_mark"))[row]
                yield superkmers.packed(runs, strings, key, mark, runs.start - before, packer)

    def sort(batches):
        spans, first, length = [], [], []
        for meeting in superkmers.meetings(batches, packer):
            for occurrences, a, n in _marked(meeting, k):
                spans.append(occurrences)
                first.append(a)
                length.append(n)
            if len(spans) > 50_000:
                yield superkmers.mark_rows(spans, first, length)
                spans, first, length = [], [], []
        yield superkmers.mark_rows(spans, first, length)

    sent = docs.select("__document_key", "__document_mark", text).mapInArrow(cut, superkmers.SCHEMA)
    return sent.repartition("place").sortWithinPartitions("place").mapInArrow(sort, superkmers.MARKS)


def _marked(meeting: superkmers.Meeting, k: int):
    """(occurrences, first word, number of words) of the repeats at one place."""
    for occurrences, windows in zip(meeting.occurrences, meeting.windows, strict=True):
        if len(occurrences) > 1:  # the same string occurs earlier
            yield occurrences[1:], 0, windows + k - 1
    if len(meeting.strings) < 2:
        return
    listed = []
    for s, (string, first, windows) in enumerate(zip(meeting.strings, meeting.first, meeting.windows, strict=True)):
        words = string.split(b" ")
        key, mark, at = meeting.occurrences[s][0].item()
        listed += [(first - i, words[i : i + k], key, mark, at + i, s, i) for i in range(windows)]
    listed.sort()
    marked: dict[int, list[int]] = {}
    for before, here in zip(listed, listed[1:], strict=False):
        if before[0] == here[0] and before[1] == here[1]:
            marked.setdefault(here[5], []).append(here[6])
    for s, at in marked.items():
        at.sort()
        start = at[0]
        for i, nxt in zip(at, [*at[1:], -1], strict=True):
            if nxt != i + 1:
                yield meeting.occurrences[s][:1], start, i - start + k
                start = nxt


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = WINDOW) -> DataFrame:
    """Documents with n_words, n_removed, removed (stretches of word numbers) and kept, the words left."""
    if k < 1:
        raise ValueError("a window has at least one word")
    held = keyed(docs, doc_id, text)
    marks, _ = materialize(superkmers.stretches(repeats(held, text, k)), "repeats")
    schema = with_fields(docs.schema, ("n_words", "bigint"), ("n_removed", "bigint"), ("removed", "array<struct<first:int,end:int>>"), ("kept", "string"))
    spans = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def remove(batches):
        for batch in batches:
            texts = batch.column(text).cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"").to_pylist()
            n, gone, removed, kept = [], [], [], []
            for t, marked in zip(texts, batch.column("__stretches").to_pylist(), strict=True):
                words, out, left = t.split(), [], 0
                merged: list[dict] = []
                for m in marked or ():
                    if merged and m["first"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], m["end"])
                    else:
                        merged.append(dict(m))
                for m in merged:
                    out += words[left : m["first"]]
                    left = m["end"]
                out += words[left:]
                n.append(len(words))
                gone.append(len(words) - len(out))
                removed.append(merged)
                kept.append(b" ".join(out).decode())
            added = {"n_words": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "removed": pa.array(removed, spans), "kept": pa.array(kept, pa.string())}
            yield batch_of(batch, schema, added)

    rest = [c for c in held.columns if c.lower() != "__stretches"]
    return held.select(*rest).join(marks, ["__document_key", "__document_mark"], "left").mapInArrow(remove, schema)
