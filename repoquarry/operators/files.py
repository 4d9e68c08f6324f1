"""File metrics of repository snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.functions import paths
from repoquarry.functions.numbers import ratio
from repoquarry.operators.ranking import top_n

KEYS = ("repository",)


def describe_files(files: DataFrame) -> DataFrame:
    """Add extension (lower case) and language (null if the file is not source code)."""
    suffix = paths.extension(F.col("file_path"))
    return files.withColumn("extension", suffix).withColumn("language", paths.language(F.col("extension")))


def measure_text(files: DataFrame, text: str = "text") -> DataFrame:
    """Line and byte counts of files whose content is a text column, which is then dropped."""
    content = F.col(text)
    return (
        files.withColumn("loc", paths.line_count(content))
        .withColumn("size_bytes", F.octet_length(content).cast("bigint"))
        .drop(text)
    )


def file_metrics(sources: DataFrame) -> DataFrame:
    """One row per source file (repository, file_path, language, extension, loc, size_bytes)."""
    return (
        describe_files(sources)
        .filter(F.col("language").isNotNull())
        .select("repository", "file_path", "language", "extension", "loc", "size_bytes")
    )


def extension_counts(files: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Files per extension, over all files."""
    label = paths.extension_label(F.col("file_path"))
    return files.groupBy(*keys, label.alias("extension")).agg(F.count(F.lit(1)).alias("files"))


def language_counts(metrics: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return metrics.groupBy(*keys, "language").agg(F.count(F.lit(1)).alias("files"))


def folder_counts(files: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Distinct folders that hold files at any depth.

    Files are first reduced to their own folder, so that ancestors are listed per folder, not per file.
    Folders without any file below them do not show in a listing of files.
    """
    own = F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1)
    folders = files.select(*keys, own.alias("folder")).filter(F.col("folder") != "").distinct()
    with_ancestors = folders.select(
        *keys, F.explode(F.concat(paths.parent_folders(F.col("folder")), F.array("folder"))).alias("folder")
    ).distinct()
    return with_ancestors.groupBy(*keys).agg(F.count(F.lit(1)).alias("directories"))


def tree_totals(
    files: DataFrame, metrics: DataFrame, keys: Sequence[str] = KEYS, folders: DataFrame | None = None
) -> DataFrame:
    """Files, source files, folders, lines and average lines per source file, 0 where there is none.

    ``folders`` lists the folders themselves, empty ones too; without it they follow from the files.
    """
    one, measures = F.lit(1), ("total_files", "source_code_files", "directories", "total_loc")

    def counting(df: DataFrame, **counted) -> DataFrame:
        """Rows with what they add to each measure, so that one grouping sums all of them."""
        return df.select(*keys, *[counted.get(m, F.lit(0)).cast("bigint").alias(m) for m in measures])

    if folders is None:
        directories = counting(folder_counts(files, keys), directories=F.col("directories"))
    else:
        directories = counting(folders, directories=one)
    rows = (
        counting(files, total_files=one)
        .unionByName(counting(metrics, source_code_files=one, total_loc=F.coalesce("loc", F.lit(0))))
        .unionByName(directories)
    )
    sums = rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    return sums.filter(F.col("total_files") > 0).withColumn(
        "average_loc_per_source_file", ratio(F.col("total_loc"), F.col("source_code_files"))
    )


def largest_files(metrics: DataFrame, n: int = 10, keys: Sequence[str] = KEYS) -> DataFrame:
    rows = metrics.select("repository", "file_path", "loc")
    return top_n(rows, [F.desc("loc"), F.asc("repository"), F.asc("file_path")], n, keys)
