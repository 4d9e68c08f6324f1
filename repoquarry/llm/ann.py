"""Approximate nearest neighbours by multi-probe p-stable hashing, for Euclidean distance.

Each of TABLES hashes takes PROJECTIONS normal projections of a vector, shifted and cut into steps of one
width. A query looks into its own bucket and into perturbed ones, in the order of their estimated success: the
expected squared distances to the steps' bounds order the sets of perturbations once, and a query's
own distances, sorted, say which projections they mean. Candidates of all tables are reranked by the exact
distance in double precision.

Width and number of probes are fitted on SAMPLE vectors at most: the width follows their median distance to
the tenth neighbour, and probes are doubled until the sample's own neighbours are found with TARGET. Vectors
become nearer the more there are, so the sample errs on the side of more probes. If all probes do not reach TARGET,
the width is doubled. Queries that found fewer than k rows, or the last of them beyond FAR times the distance
that the width was fitted to, are searched again with a doubled width, DOUBLINGS times at most and as long as
they are more than FEW; what is left meets all vectors.

Equal vectors are one class with its smallest ids. Buckets are dealt into cells of a few thousand vectors; a
bucket with more is split by vector, and its queries go to all of its splits. A cell meets its
queries once and sends each query's best on, so no pairs are shuffled. Vectors that are null, zero, or hold
null or non-finite components, rows without id, and vectors of another length than most have take no part.
Ids should be unique; of rows equal in id and vector one counts. Empty tables give no rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repoquarry.llm.common import joinable, mixed
from repoquarry.session import materialize, ship_package

TABLES, PROJECTIONS, SEED = 10, 8, 23
SAMPLE, SAMPLE_QUERIES, TARGET = 2_000, 60, 0.95
MOST_PROBES = 3**PROJECTIONS  # every bucket whose numbers differ by one at most
CELL = 2_000
FAR, DOUBLINGS, FEW = 2, 3, 100
_WIDTH = 1.35  # of the median distance to the tenth neighbour


def perturbations(count: int, projections: int = PROJECTIONS) -> np.ndarray:
    """(sets, 2 * projections) of 0 and 1 in the order of expected cost; the first is empty.

    Place j stands for the j-th nearest of a query's bounds; j and its mirror image are the two bounds of
    one projection and never occur together.
    """
    m = projections
    j = np.arange(1, 2 * m + 1)
    cost = np.where(j <= m, j * (j + 1) / (4 * (m + 1) * (m + 2)), 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)))
    out, heap = [()], [(cost[0], (0,))]
    while heap and len(out) < count:
        score, chosen = heapq.heappop(heap)
        if not any(2 * m - 1 - c in chosen for c in chosen):
            out.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (score - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (score + cost[last + 1], (*chosen, last + 1)))
    sets = np.zeros((len(out), 2 * m), np.int8)
    for i, chosen in enumerate(out):
        sets[i, list(chosen)] = 1
    return sets


@dataclass
class Hashes:
    planes: np.ndarray  # (tables, length, projections)
    shift: np.ndarray
    width: float
    sets: np.ndarray

    def _steps(self, table: int, x: np.ndarray) -> np.ndarray:
        return x @ self.planes[table] / self.width + self.shift[table]

    @staticmethod
    def _named(table: int, steps: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng([SEED, table])
        odd = rng.integers(0, 1 << 63, steps.shape[-1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        return mixed((steps.astype(np.int64).view(np.uint64) * odd).sum(-1, dtype=np.uint64) + np.uint64(table)).view(np.int64)

    def buckets(self, table: int, x: np.ndarray) -> np.ndarray:
        return self._named(table, np.floor(self._steps(table, x)))

    def probes(self, table: int, x: np.ndarray) -> np.ndarray:
        """(queries, probes): bucket names, best first."""
        at = self._steps(table, x)
        low = np.floor(at)
        below = at - low
        m = low.shape[1]
        order = np.argsort(np.concatenate([below, 1 - below], 1) ** 2, axis=1, kind="stable")
        out = np.empty((len(x), len(self.sets)), np.int64)
        for i in range(len(x)):
            turn = np.zeros((2 * m, m), np.int8)
            turn[np.arange(2 * m), order[i] % m] = np.where(order[i] < m, -1, 1)
            out[i] = self._named(table, low[i] + self.sets @ turn)
        return out


def fit(sample: np.ndarray, k: int = 10) -> Hashes:
    """Planes, width and probes for vectors like those of the sample."""
    n, length = sample.shape
    rng = np.random.default_rng(SEED)
    planes, shift = rng.normal(size=(TABLES, length, PROJECTIONS)), rng.uniform(0, 1, (TABLES, PROJECTIONS))
    queries = np.arange(min(n, SAMPLE_QUERIES))
    apart = np.sqrt(((sample[queries][:, None] - sample[None]) ** 2).sum(-1))
    apart[queries, queries] = np.inf
    near = np.argsort(apart, 1)[:, : max(1, min(k, n - 1))]
    reach = float(np.median(apart[queries, near[:, -1]])) if n > 1 else 1.0
    hashes = Hashes(planes, shift, _WIDTH * reach if np.isfinite(reach) and reach > 0 else 1.0, perturbations(1))
    if n < 2:
        return hashes
    all_sets = perturbations(MOST_PROBES)
    while True:
        hashes.sets = all_sets
        place = np.full(near.shape, len(all_sets))  # first probe that finds a neighbour, over the tables
        for t in range(TABLES):
            names, own = hashes.probes(t, sample[queries]), hashes.buckets(t, sample)
            for q in queries.tolist():
                order = np.argsort(names[q], kind="stable")
                sorted_ = names[q][order]
                i = np.minimum(np.searchsorted(sorted_, own[near[q]]), len(order) - 1)
                place[q] = np.minimum(place[q], np.where(sorted_[i] == own[near[q]], order[i], len(order)))
        if (place < len(all_sets)).mean() >= TARGET:
            break
        hashes.width *= 2
    count = 16
    while count < len(all_sets) and (place < count).mean() < TARGET:
        count *= 2
    hashes.sets = all_sets[:count]
    return hashes


def _unpacked(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows)).reshape(len(rows), -1) if rows else np.zeros((0, 0))


def nearest(vectors: DataFrame, queries, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row for which ``queries``, a condition
    on the id column, holds; never the row itself; ties to the smaller id."""
    spark = vectors.sparkSession
    ship_package(spark)
    numbers = F.transform(F.col(embedding), lambda x: x.cast("double"))
    good = F.forall(numbers, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))) & F.exists(numbers, lambda x: x != 0)
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()).where(good)
    rows = rows.select(F.col(vec_id).cast("long").alias("id"), numbers.alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("v") == lengths[0][0]).distinct()
    # a class of equal vectors: its smallest ids, enough for k results besides the asking row
    first = Window.partitionBy("v").orderBy("id")
    kept = rows.select("id", "v").withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    classes = kept.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes, _ = materialize(classes.select(F.element_at("ids", 1).alias("class"), "ids", "v"), "classes")
    asking = rows.where("asks").select("id", "v").join(classes.select("class", "v"), "v").select("id", "class", "v")
    asking, _ = materialize(asking, "asking")
    drawn = classes.orderBy(F.xxhash64(F.lit(SEED), "class"), "class").limit(SAMPLE).collect()
    hashes = fit(np.array([r["v"] for r in drawn], float), k)
    n_classes, n_ids = classes.agg(F.count("*"), F.sum(F.size("ids"))).first()
    cells = max(1, -(-n_classes // CELL))
    asked, found = asking.groupBy("class").agg(F.first("v").alias("v")), []
    for turn in range(DOUBLINGS + 2):
        last = turn > DOUBLINGS or (turn > 0 and asked.count() <= FEW)
        members, _ = materialize(_search(classes, asked, None if last else hashes, cells, k), "found")
        if last:
            found.append(members)
            break
        reached = (F.count("*") >= min(k + 1, n_ids)) & (F.max("score") <= FAR * hashes.width / _WIDTH)
        enough = members.groupBy("query").agg(reached.alias("enough")).where("enough").select("query")
        found.append(members.join(enough, "query", "left_semi"))
        asked, _ = materialize(asked.join(enough, F.col("class") == F.col("query"), "left_anti"), "asked")
        if asked.isEmpty():
            break
        hashes = replace(hashes, width=2 * hashes.width)
    own = asking.select(F.col("id").alias("query_id"), F.col("class").alias("query"))
    results = own.join(reduce(DataFrame.union, found), "query").where("vec_id != query_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _dealt(classes: DataFrame, asked: DataFrame, index, probe, cells: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the cells: vectors by their buckets, queries by the buckets they look into."""
    stored = classes.select("class", "v").mapInArrow(index, "bucket bigint, class bigint, v binary")
    full = stored.groupBy("bucket").count().where(F.col("count") > CELL)
    full = joinable(full.select(F.col("bucket").alias("b"), F.ceil(F.col("count") / CELL).cast("int").alias("splits")), "buckets")
    split = F.when(F.col("splits").isNotNull(), F.pmod(F.xxhash64("class"), F.col("splits"))).otherwise(0).cast("int")
    table_cell = F.pmod("bucket", F.lit(cells)).alias("cell")
    stored = stored.join(full, F.col("bucket") == F.col("b"), "left").select(table_cell, split.alias("split"), "bucket", "class", "v")
    most = full.agg(F.coalesce(F.max("splits"), F.lit(1))).first()[0]
    asked = asked.select("class", "v").mapInArrow(probe, "table int, cell bigint, query bigint, q binary, names binary")
    # names of one table never meet another's: the table is part of a name
    asked = asked.select("cell", "query", "q", "names")
    if most > 1:
        split_cells = full.select(F.pmod("b", F.lit(cells)).alias("cell"), "splits").groupBy("cell").agg(F.max("splits").alias("splits"))
        asked = asked.join(F.broadcast(split_cells), "cell", "left")
        asked = asked.withColumn("split", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("splits") - 1, F.lit(0)))))
    else:
        asked = asked.withColumn("split", F.lit(0))
    return stored, asked.select("cell", "split", "query", "q", "names")


def _search(classes: DataFrame, asked: DataFrame, fitted: Hashes | None, cells: int, k: int) -> DataFrame:
    """(query, score, vec_id): the k + 1 nearest ids found for each asked class; without hashes, of all classes."""
    hashes = classes.sparkSession.sparkContext.broadcast(fitted)

    def packed(v: np.ndarray) -> list[bytes]:
        return [x.tobytes() for x in v]

    def index(batches):
        for batch in batches:
            v = np.array(batch.column("v").to_pylist(), float)
            if not len(v):
                continue
            raw = pa.array(packed(v), pa.binary())
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays([pa.array(hashes.value.buckets(t, v)), batch.column("class"), raw], ["bucket", "class", "v"])

    def probe(batches):
        for batch in batches:
            v = np.array(batch.column("v").to_pylist(), float)
            if not len(v):
                continue
            for t in range(TABLES):
                names = hashes.value.probes(t, v)
                for i, (own, raw) in enumerate(zip(names, packed(v), strict=True)):
                    cell = np.mod(own, cells)
                    order = np.argsort(cell, kind="stable")
                    cuts = np.flatnonzero(np.diff(cell[order])) + 1
                    parts = np.split(own[order], cuts)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(parts), t, np.int32)),
                            pa.array(cell[order][np.append(0, cuts)]),
                            pa.array([batch.column("class")[i].as_py()] * len(parts), pa.int64()),
                            pa.array([raw] * len(parts), pa.binary()),
                            pa.array([p.tobytes() for p in parts], pa.binary()),
                        ],
                        ["table", "cell", "query", "q", "names"],
                    )

    def pack(batches):
        for batch in batches:
            v = np.array(batch.column("v").to_pylist(), float)
            if len(v):
                yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(packed(v), pa.binary())], ["class", "v"])

    if fitted is None:
        stored = classes.select("class", "v").mapInArrow(pack, "class bigint, v binary")
        stored = stored.select(F.pmod(F.xxhash64("class"), F.lit(cells)).alias("cell"), F.lit(0).alias("split"), F.lit(0).cast("long").alias("bucket"), "class", "v")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))).alias("cell")
        asked = asked.select("class", "v").mapInArrow(pack, "class bigint, v binary").select(every, F.col("class").alias("query"), F.col("v").alias("q"))
        asked = asked.select("cell", F.lit(0).alias("split"), "query", "q", F.lit(bytes(8)).alias("names"))
    else:
        stored, asked = _dealt(classes, asked, index, probe, cells)

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            bucket, ids, v = np.asarray(left["bucket"]), np.asarray(left["class"]), _unpacked(left["v"].combine_chunks())
            order = np.argsort(bucket, kind="stable")
            bucket, ids, v = bucket[order], ids[order], v[order]
            # one search for a query, however many rows name it
            asks: dict[int, list] = {}
            for query, raw, names in zip(right["query"].to_pylist(), right["q"].to_pylist(), right["names"].to_pylist(), strict=True):
                asks.setdefault(query, [raw]).append(names)
            for query, (raw, *names) in asks.items():
                wanted = np.frombuffer(b"".join(names), np.int64)
                a, b = np.searchsorted(bucket, wanted), np.searchsorted(bucket, wanted, "right")
                some = b > a
                if not some.any():
                    continue
                a, n = a[some], (b - a)[some]
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
                # a vector is in one bucket of each table, so it can be listed several times
                at = at[np.unique(ids[at], return_index=True)[1]]
                far = np.sqrt(((v[at] - np.frombuffer(raw)) ** 2).sum(1))
                best = np.lexsort((ids[at], far))[: k + 1]
                found.append((query, ids[at][best], far[best]))
        return pa.table(
            {
                "query": pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)),
                "class": pa.array(np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)),
                "score": pa.array(np.concatenate([f[2] for f in found]) if found else np.zeros(0)),
            }
        )

    met = stored.groupBy("cell", "split").cogroup(asked.groupBy("cell", "split"))
    near = met.applyInArrow(rerank, "query bigint, class bigint, score double").distinct()
    by_query = Window.partitionBy("query").orderBy("score", "class")
    near = near.withColumn("r", F.row_number().over(by_query)).where(F.col("r") <= k + 1)
    members = near.join(classes.select("class", "ids"), "class").select("query", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    return members.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
