"""Writers: tables, vocabularies, vectors, reports and files by name. Running again replaces the output."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repoquarry import schemas
from repoquarry.operators.ranking import rank_ids
from repoquarry.sources.file_systems import hadoop_settings, open_root, resolved

LOG_LINES = 5_000  # of one file of a log


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_sorted_csv(df: DataFrame, path: str, columns: Sequence[str], order: Sequence) -> None:
    """Full listing in order: a range-partitioned sort, so part files follow one another."""
    write_csv(df.orderBy(*order), path, columns)


def write_combined(df: DataFrame, path: str) -> None:
    """Partitioned by repository, so that later reads of some repositories skip the others.

    Rows are rebalanced: a huge repository is written by as many tasks as its bytes ask for, and
    small ones share a task, each with one file.
    """
    (
        df.select(*schemas.COMBINED_COLUMNS)
        .hint("rebalance", "repository")
        .write.mode("overwrite")
        .partitionBy("repository")
        .parquet(path)
    )


def write_vocabulary(vocabulary: DataFrame, path: str) -> None:
    vocabulary.select("token", "token_id", "frequency").write.mode("overwrite").parquet(path)


def write_embeddings(vectors: DataFrame, path: str) -> None:
    vectors.select("idx", "token", "vec").write.mode("overwrite").parquet(path)


def write_statistics_json(statistics: DataFrame, path: str) -> None:
    """Long-form statistics (section, key, value) as JSON lines.

    A single nested object would have to gather every repository in one row.
    """
    statistics.write.mode("overwrite").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """Report rows as text lines in reading order, one folder per repository."""
    line = F.concat_ws(" | ", "section", "key", "value")
    (
        report.repartition("repository")
        .sortWithinPartitions("repository", "section", "ord")
        .select("repository", line.alias("value"))
        .write.mode("overwrite")
        .partitionBy("repository")
        .text(path)
    )


def write_files(files: DataFrame, root: str) -> int:
    """Write (path, content) rows as files below a root and return their number.

    For layouts that Spark's own writers cannot name. The tasks write, and a repeated task writes the same
    file again; the file system's settings are those of Spark's readers.
    """
    spark = files.sparkSession
    where, settings = resolved(spark, root), hadoop_settings(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_system, base = open_root(where, settings)
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                address = f"{base}/{path}"
                file_system.create_dir(address.rpartition("/")[0], recursive=True)
                with file_system.open_output_stream(address) as out:
                    out.write(content)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    rows = files.select("path", F.col("content").cast("binary").alias("content"))
    return rows.mapInArrow(run, "n BIGINT").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def log_files(lines: DataFrame, order: Sequence[Column], name: str, header: str = "") -> DataFrame:
    """(path, content) of one log per repository, from rows (repository, value) in an order.

    A long log becomes several files whose names follow the order, so no task holds a whole log:
    <repository>/<name>/part-<number>. Runs a job.
    """
    ranked = rank_ids(lines, [F.asc("repository"), *order], "_line", start=0)
    part = F.floor(F.col("_line") / LOG_LINES).alias("_part")
    ordered = F.array_sort(F.collect_list(F.struct("_line", "value")))
    grouped = ranked.groupBy("repository", part).agg(F.transform(ordered, lambda x: x["value"]).alias("values"))
    path = F.concat("repository", F.lit(f"/{name}/part-"), F.lpad(F.col("_part").cast("string"), 9, "0"))
    content = F.concat(F.lit(header), F.array_join("values", "\n"), F.lit("\n"))
    return grouped.select(path.alias("path"), content.alias("content"))
