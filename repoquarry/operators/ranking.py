"""Top-n and ranks that never sort a whole table, or a whole hot key, in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repoquarry.session import materialize


def _keep_first(df: DataFrame, keys: Sequence, order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n)


def first_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each key in ``order``; ``rank`` names an optional 1-based column.

    Spark cuts to ``n`` rows per key before the shuffle as long as ``n`` is at most its window group
    limit. For larger ``n`` the cut is made here first, over the part of each key in each input
    partition, so a key that holds a third of all rows, or copies of one row, is sorted by many tasks.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        parts = df.withColumn("_part", F.spark_partition_id())
        df = _keep_first(parts, [*keys, "_part"], order, n).drop("_part", "_rank")
    kept = _keep_first(df, keys, order, n)
    return kept.withColumnRenamed("_rank", rank) if rank else kept.drop("_rank")


def top_n(df: DataFrame, order: Sequence[Column], n: int, keys: Sequence[str] = ()) -> DataFrame:
    """Top ``n`` overall, or of each key."""
    if keys:
        return first_n_per_key(df, keys, order, n)
    return df.orderBy(*order).limit(n)


def rank_ids(df: DataFrame, order: Sequence[Column], name: str = "token_id", start: int = 1) -> DataFrame:
    """Number all rows by a total order without a one-partition window.

    Rows are range-partitioned and sorted, and each notes its partition and its place in it. That
    table is written once; the row counts of its partitions (one number per partition) then give the
    offset to add, a small table joined by partition. Runs a job.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    table, _ = materialize(ranged.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_place", 33)
    counts = table.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], start
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((row["_part"], total))
        total += row["n"]
    before = df.sparkSession.createDataFrame(offsets, "_part BIGINT, _before BIGINT")
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before")
    placed = table.withColumn("_part", part).join(F.broadcast(before), "_part")
    return placed.withColumn(name, place.cast("bigint")).drop("_place", "_part", "_before")
