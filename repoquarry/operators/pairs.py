"""Cosine similarity of all unordered pairs of vectors, without a cross join.

Vectors are dealt into equal blocks by a hash of their index. Each pair of blocks is one group, and a
group computes its similarities as one matrix product. What leaves a group depends on the question:
its best pairs, a summary, or (for selections of tokens, where the listing is the result) its pairs.

The vectors are written to the shared folder and counted, and the number of blocks follows, so that no
group holds more than two blocks of ``block_rows``; ``blocks`` sets their number where it is known.
Each vector is sent once for every block. Where a group keeps few numbers only, it works on its matrix in
tiles and blocks grow with the table up to LARGE_ROWS, so that MANY_BLOCKS of them do for most tables. All
pairs are still computed, so the products, and they alone, grow with the square of the table.

Sums of products differ in their last digits with their order. Where pairs are ranked, similarities are
rounded to DIGITS first, so that equal pairs tie and the smaller indices come first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.functions.vectors import cosine
from repoquarry.operators.ranking import first_n_per_key
from repoquarry.session import materialize

BLOCK_ROWS = 1024
MANY_BLOCKS, LARGE_ROWS = 24, 32_768  # of groups that work in tiles
TILE = 1024  # rows and columns of a matrix held at once
DIGITS = 12


def blocks_for(rows: int, block_rows: int = BLOCK_ROWS) -> int:
    return max(1, -(-rows // block_rows))


def few_blocks_for(rows: int, block_rows: int = BLOCK_ROWS) -> int:
    """Blocks of ``block_rows``, or larger ones where these would be more than MANY_BLOCKS."""
    return max(min(blocks_for(rows, block_rows), MANY_BLOCKS), blocks_for(rows, LARGE_ROWS))


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    matrix = np.array(vectors.tolist(), dtype=np.float64)
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def _sides(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the two blocks of a group; the same rows twice for a block with itself."""
    block = group["_block"].to_numpy()
    return np.nonzero(block == group["_low"].iat[0])[0], np.nonzero(block == group["_high"].iat[0])[0]


def _own_pairs(group: pd.DataFrame, hits: np.ndarray | None = None):
    """Places (a, b) of a group's pairs in its matrix of similarities, and their row numbers (i, j), the
    smaller index first. ``hits`` leaves out all pairs but those where it is true."""
    rows, columns = _sides(group)
    if group["_low"].iat[0] != group["_high"].iat[0]:
        a, b = np.nonzero(hits) if hits is not None else (x.ravel() for x in np.indices((len(rows), len(columns))))
    else:
        a, b = np.nonzero(np.triu(hits, 1)) if hits is not None else np.triu_indices(len(rows), 1)
    i, j = rows[a], columns[b]
    idx = group["idx"].to_numpy()
    swap = idx[i] > idx[j]
    return a, b, np.where(swap, j, i), np.where(swap, i, j)


def _similarity_matrix(group: pd.DataFrame, name: str) -> np.ndarray:
    rows, columns = _sides(group)
    unit = _unit_rows(group[name])
    return unit[rows] @ unit[columns].T


def _group_similarities(group: pd.DataFrame, vec_columns: Sequence[str]):
    """Row numbers (i, j) of the group's own pairs, and their similarity under each vector column."""
    a, b, i, j = _own_pairs(group)
    return i, j, [_similarity_matrix(group, name)[a, b] for name in vec_columns]


def _pair_frame(group: pd.DataFrame, i, j, similarities, names) -> pd.DataFrame:
    idx, token = group["idx"].to_numpy(), group["token"].to_numpy()
    frame = {"idx_1": idx[i], "idx_2": idx[j], "token_1": token[i], "token_2": token[j]}
    frame.update(zip(names, similarities))
    return pd.DataFrame(frame)


def by_block_pair(
    vectors: DataFrame,
    blocks: int | None,
    columns: Sequence[str],
    kernel: Callable,
    schema: str,
    block_rows: int = BLOCK_ROWS,
    keys: Sequence[str] = (),
    number: Callable[[int, int], int] = blocks_for,
) -> DataFrame:
    """kernel(group) for every pair of blocks, and for each value of further ``keys`` by itself.

    Runs a job where the number of blocks is not given.
    """
    wanted = vectors.select("idx", "token", *keys, *columns)
    if blocks is None:
        wanted, _ = materialize(wanted, "vectors")
        blocks = number(wanted.select("idx").distinct().count() if keys else wanted.count(), block_rows)
    block = F.pmod(F.xxhash64("idx"), F.lit(blocks)).cast("int")
    dealt = wanted.withColumn("_block", block)
    partners = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    grouped = partners.select(
        "*",
        F.least("_block", "_other").alias("_low"),
        F.greatest("_block", "_other").alias("_high"),
    ).drop("_other")
    return grouped.groupBy("_low", "_high", *keys).applyInPandas(kernel, schema)


def pair_schema(vectors: DataFrame, names: Sequence[str]) -> str:
    idx = vectors.schema["idx"].dataType.simpleString()
    return f"idx_1 {idx}, idx_2 {idx}, token_1 STRING, token_2 STRING, " + ", ".join(f"{n} DOUBLE" for n in names)


def pair_listing(
    vectors: DataFrame,
    blocks: int | None = None,
    vec_columns: Sequence[str] = ("vec",),
    names: Sequence[str] = ("similarity",),
) -> DataFrame:
    """All pairs (idx_1 < idx_2) of a selection of tokens, n(n-1)/2 rows."""

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        i, j, similarities = _group_similarities(group, vec_columns)
        return _pair_frame(group, i, j, similarities, names)

    return by_block_pair(vectors, blocks, vec_columns, kernel, pair_schema(vectors, names))


def part_similarities(parts: DataFrame, blocks: int | None = None) -> DataFrame:
    """All pairs of a selection of tokens whose vectors are stored in parts: (idx, token, part, vec).

    A part is a stretch of slots, and equal parts have equal lengths. Each part of a pair of blocks gives
    partial products, which are added up over the parts; lengths are added up in the same way. So no
    vector is ever put together.
    """

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        a, b, i, j = _own_pairs(group)
        rows, columns = _sides(group)
        matrix = np.array(group["vec"].tolist(), dtype=np.float64)
        return _pair_frame(group, i, j, [(matrix[rows] @ matrix[columns].T)[a, b]], ["product"])

    products = by_block_pair(parts, blocks, ["vec"], kernel, pair_schema(parts, ["product"]), keys=["part"])
    squares = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x)
    lengths = parts.groupBy("idx").agg(F.sqrt(F.sum(squares)).alias("length"))
    one, two = (lengths.select(F.col("idx").alias(f"idx_{n}"), F.col("length").alias(f"_{n}")) for n in (1, 2))
    summed = products.groupBy("idx_1", "idx_2", "token_1", "token_2").agg(F.sum("product").alias("product"))
    similarity = F.coalesce(F.try_divide("product", F.col("_1") * F.col("_2")), F.lit(0.0)).alias("similarity")
    return summed.join(one, "idx_1").join(two, "idx_2").select("idx_1", "idx_2", "token_1", "token_2", similarity)


def _tiles(group: pd.DataFrame):
    """The matrix of a group's similarities in tiles: row numbers of both sides, the products, and whether
    the tile lies on the diagonal. Of a block with itself the tiles on and above the diagonal."""
    rows, columns = _sides(group)
    own = group["_low"].iat[0] == group["_high"].iat[0]
    unit = _unit_rows(group["vec"])
    for a in range(0, len(rows), TILE):
        for b in range(a if own else 0, len(columns), TILE):
            i, j = rows[a : a + TILE], columns[b : b + TILE]
            yield i, j, unit[i] @ unit[j].T, own and a == b


class _Best:
    """The ``k`` pairs of the smallest (value, smaller index, larger index) met so far, with their row numbers."""

    def __init__(self, idx: np.ndarray, k: int):
        self.idx, self.k = idx, k
        self.values, self.i, self.j = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, values: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
        if len(values) > self.k:
            last = np.partition(values, self.k - 1)[self.k - 1]
            keep = values <= last
            values, i, j = values[keep], i[keep], j[keep]
        swap = self.idx[i] > self.idx[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        if len(values) > 64 * self.k:  # many ties: those of the first indices do
            first = self.idx[i]
            tied = values == last
            if tied.sum() > self.k:
                keep = ~tied | (first <= np.partition(first[tied], self.k - 1)[self.k - 1])
                values, i, j = values[keep], i[keep], j[keep]
        values, i, j = (np.concatenate(x) for x in ((self.values, values), (self.i, i), (self.j, j)))
        order = np.lexsort((self.idx[j], self.idx[i], values))[: self.k]
        self.values, self.i, self.j = values[order], i[order], j[order]

    def bound(self) -> float:
        """A pair above it is none of the best."""
        return self.values[-1] if len(self.values) == self.k else np.inf


def extreme_pairs(
    vectors: DataFrame, k: int = 10, most: bool = True, blocks: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The ``k`` most (or least) similar pairs; each group passes on its own ``k`` best only."""
    sign = -1.0 if most else 1.0

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        best = _Best(group["idx"].to_numpy(), k)
        for i, j, tile, diagonal in _tiles(group):
            tile *= sign
            bound = best.bound()
            # the slack is more than rounding moves a similarity; pairs without one take no place of others
            if tile.size and np.isfinite(bound) and np.nanmin(tile, initial=np.inf) > bound + 10.0**-DIGITS:
                continue
            hits = tile <= bound + 10.0**-DIGITS if np.isfinite(bound) else np.ones(tile.shape, bool)
            a, b = np.nonzero(np.triu(hits, 1) if diagonal else hits)
            best.add(np.round(tile[a, b], DIGITS), i[a], j[b])
        return _pair_frame(group, best.i, best.j, [sign * best.values], ["similarity"])

    schema = pair_schema(vectors, ["similarity"])
    best = by_block_pair(vectors, blocks, ["vec"], kernel, schema, block_rows, number=few_blocks_for)
    order = F.desc("similarity") if most else F.asc("similarity")
    return best.orderBy(order, "idx_1", "idx_2").limit(k)


def similarity_summary(vectors: DataFrame, blocks: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(pairs, highest, lowest, average) over all pairs; a group passes on four numbers."""

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        n, total, high, low = 0, 0.0, [], []
        for i, j, tile, diagonal in _tiles(group):
            if diagonal:
                tile = tile[np.triu_indices(len(i), 1)]
            if tile.size:
                n, total = n + tile.size, total + tile.sum()
                high.append(tile.max())
                low.append(tile.min())
        if not n:
            return pd.DataFrame({"n": [], "total": [], "high": [], "low": []})
        return pd.DataFrame({"n": [n], "total": [total], "high": [np.max(high)], "low": [np.min(low)]})

    schema = "n BIGINT, total DOUBLE, high DOUBLE, low DOUBLE"
    parts = by_block_pair(vectors, blocks, ["vec"], kernel, schema, block_rows, number=few_blocks_for)
    return parts.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("pairs"),
        F.max("high").alias("highest_similarity"),
        F.min("low").alias("lowest_similarity"),
        F.try_divide(F.sum("total"), F.sum("n")).alias("average_similarity"),
    )


def lookup_pairs(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Cosine similarity of given (token_a, token_b) pairs by two equi-joins."""
    a = vectors.select(F.col("token").alias("token_a"), F.col("vec").alias("_a"))
    b = vectors.select(F.col("token").alias("token_b"), F.col("vec").alias("_b"))
    joined = pairs.join(a, "token_a").join(b, "token_b")
    return joined.select("token_a", "token_b", cosine(F.col("_a"), F.col("_b")).alias("cosine_similarity"))


def mean_vectors(vectors: DataFrame, key: str, vec: str = "vec") -> DataFrame:
    """Element-wise mean of the vectors of each key, as (key, vec).

    Grouping by key and slot keeps partial sums on the map side, so a hot key costs no more than
    a rare one after the shuffle.
    """
    slots = vectors.select(key, F.posexplode_outer(vec).alias("slot", "value")).filter(F.col("slot").isNotNull())
    means = slots.groupBy(key, "slot").agg(F.avg(F.col("value").cast("double")).alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("slot", "value")))
    return means.groupBy(key).agg(F.transform(ordered, lambda x: x["value"]).alias("vec"))


def top_per_approach(listings: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most similar pairs of each approach, with their rank from 1."""
    order = [F.round("similarity", DIGITS).desc(), F.asc("idx_1"), F.asc("idx_2")]
    return first_n_per_key(listings, ["approach"], order, n, rank="rank")


def compare_approaches(listings: DataFrame) -> DataFrame:
    """Highest, lowest and average similarity per approach; an approach without pairs has no row."""
    return listings.groupBy("approach").agg(
        F.max("similarity").alias("highest_similarity"),
        F.min("similarity").alias("lowest_similarity"),
        F.avg("similarity").alias("average_similarity"),
    )
