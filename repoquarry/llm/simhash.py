"""SimHash near-duplicates: 64-bit fingerprints, linked at a few differing bits by BK-trees.

Fingerprints at most r bits apart agree on at least two of r + 2 stretches of their 64 bits. Every
different fingerprint therefore goes to one shard for each pair of stretches, named by the bits there;
a shard's BK-tree stands where its fingerprints meet, and each of them is looked up in it. The trees
travel by the shuffle and not by a driver broadcast: together they are as large as the corpus.
A shard reports a spanning forest of its links, not all pairs, and the components of all shards'
forests are united by distributed union-find.

Texts without words have fingerprint zero. Rows with one doc_id are one document; rows without an id
are no document of their own: they can link others and get the component of their links.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.llm.common import SLICE, NO_ID, batch_of, id_of, slices, utf8, with_fields
from repoquarry.llm.components import components
from repoquarry.session import drop_table, materialize, ship_package

SEED, SHINGLE, RADIUS = 42, 3, 3
_SHARD_ROWS = 200_000  # rows of whole shards worked on together
_PAIRS = 2_000_000  # lookups of (fingerprint, tree node) held at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if it is set in over half the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    of = xxhash.xxh64_intdigest
    hashes = np.fromiter((of(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)), np.uint64, n)
    count = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i : i + (1 << 16)]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(count * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, keep_text: bool = True) -> DataFrame:
    """Documents with simhash, the fingerprint as a signed long."""
    ship_package(docs.sparkSession)
    schema = with_fields(docs.schema, ("simhash", "bigint"), drop=() if keep_text else (text,))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text, SLICE):
                data, at = utf8(batch.column(text))
                marks = [fingerprint(data[a:b].tobytes(), shingle) for a, b in zip(at, at[1:], strict=False)]
                yield batch_of(batch, schema, {"simhash": pa.array(np.array(marks, np.uint64).view(np.int64))})

    return docs.mapInArrow(run, schema)


class Forest:
    """The BK-trees of many shards. A child hangs on its parent by the integer distance between them.

    All trees are built level by level at once: the first fingerprint at a place becomes its node, and the
    others go on below it, parted by their distance to it.
    """

    def __init__(self, shard: np.ndarray, marks: np.ndarray):
        n = len(marks)
        self.marks, self.edge = marks, np.full(n, -1, np.int64)
        parent = np.full(n, -1, np.int64)
        waiting, place = np.arange(n), shard.astype(np.int64)  # place: the tree or edge it hangs on
        self.root = np.zeros(n, np.int64)
        above = np.full(n, -1, np.int64)
        while len(waiting):
            _, first, group = np.unique(place, return_index=True, return_inverse=True)
            node = waiting[first][group]
            if above[waiting[0]] < 0:
                self.root[waiting] = node
            here = waiting == node
            new = waiting[here]
            parent[new] = above[new]
            rest = ~here
            waiting, node = waiting[rest], node[rest]
            distance = np.bitwise_count(marks[waiting] ^ marks[node]).astype(np.int64)
            self.edge[waiting], above[waiting] = distance, node
            place = node * 65 + distance
        child = np.flatnonzero(parent >= 0)
        self._child = child[np.argsort(parent[child], kind="stable")]
        self._first = np.searchsorted(parent[self._child], np.arange(n + 1))

    def near(self, queries: np.ndarray, radius: int):
        """Pairs (query, node) within the radius, in pieces: only edges within it of the distance to the
        parent are followed. Queries are members of the forest, looked up in their own tree."""
        stack = [(queries, self.root[queries])]
        while stack:
            query, node = stack.pop()
            if len(query) > _PAIRS:
                half = len(query) // 2
                stack += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            distance = np.bitwise_count(self.marks[query] ^ self.marks[node]).astype(np.int64)
            hit = (distance <= radius) & (query != node)
            yield query[hit], node[hit]
            count = self._first[node + 1] - self._first[node]
            total = int(count.sum())
            if total:
                q, d = np.repeat(query, count), np.repeat(distance, count)
                at = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self._first[node], count)
                below = self._child[at]
                follow = np.abs(self.edge[below] - d) <= radius
                if follow.any():
                    stack.append((q[follow], below[follow]))


def _spanning(n: int, pieces) -> np.ndarray:
    """Smallest member of each one's component of the links, by pointer doubling on numpy arrays."""
    low = np.arange(n)
    for a, b in pieces:
        while len(a):
            ra, rb = low[a], low[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(low, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
            while True:
                down = low[low]
                if (down == low).all():
                    break
                low = down
    return low


def shards(marks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(shard, node, simhash) of different fingerprints: one row for each pair of stretches of bits."""
    pieces = radius + 2
    cut = [64 * i // pieces for i in range(pieces + 1)]
    masks = [((1 << cut[i + 1]) - (1 << cut[i])) | ((1 << cut[j + 1]) - (1 << cut[j])) for i, j in combinations(range(pieces), 2)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("simhash").bitwiseAND(F.lit(m))) for i, m in enumerate(signed)])
    return marks.select(F.explode(keys).alias("shard"), "node", "simhash")


def links(marks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) between nodes of different fingerprints: a spanning forest of each shard's links."""
    ship_package(marks.sparkSession)

    def forest(frames) -> pa.RecordBatch:
        batch = pa.Table.from_batches(frames)
        shard = np.unique(np.asarray(batch["shard"]), return_inverse=True)[1]
        node, simhash = np.asarray(batch["node"]), np.asarray(batch["simhash"]).view(np.uint64)
        trees = Forest(shard, simhash)
        members = np.flatnonzero(np.bincount(shard)[shard] > 1)
        low = _spanning(len(node), trees.near(members, radius))
        linked = np.flatnonzero(low != np.arange(len(low)))
        return pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[low[linked]])], ["a", "b"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if rows >= _SHARD_ROWS:  # what is complete: all before the first row of the last shard
                last = np.asarray(batch.column("shard"))
                new = np.flatnonzero(last != np.asarray(held[-1].column("shard"))[-1])
                cut = int(new[0]) if len(new) else batch.num_rows
                held.append(batch.slice(0, cut))
                batch = batch.slice(cut)
                if len(new):
                    yield forest(held)
                    held, rows = [], 0
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
        if held:
            yield forest(held)

    by_shard = shards(marks, radius).repartition("shard").sortWithinPartitions("shard")
    return by_shard.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, keep_text: bool = True) -> DataFrame:
    """Documents with simhash and component_id, the smallest doc_id reachable over links."""
    marked = fingerprints(docs, text, shingle, keep_text)
    if not keep_text:
        marked, _ = materialize(marked, "fingerprints")
    slim, _ = (marked, "") if not keep_text else materialize(marked.select(doc_id, "simhash"), "fingerprints")
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    nodes = slim.groupBy("simhash").agg(F.min(key).alias("node"))
    nodes, path = materialize(nodes, "nodes")
    same_id = slim.select(key.alias("a"), "simhash").where(F.col("a") != NO_ID).groupBy("a").agg(F.min("simhash").alias("s"), F.max("simhash").alias("t")).where("s != t").select("a")
    spread = slim.select(key.alias("a"), "simhash").join(same_id, "a", "left_semi").distinct()
    again = spread.join(nodes, "simhash").select("a", F.col("node").alias("b"))  # one id, several texts
    roots, _ = materialize(components(links(nodes, radius).union(again)), "roots")
    named = nodes.join(roots, "node", "left").select(
        F.col("simhash").alias("__simhash"), id_of(F.coalesce("root", "node")).alias("component_id")
    )
    named, _ = materialize(named, "named")
    rest = [c for c in marked.columns if c.lower() != "component_id"]
    return marked.select(*rest).join(named, F.col("simhash") == F.col("__simhash")).drop("__simhash")
