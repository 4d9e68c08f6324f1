"""Summary report of repositories as rows (repository, section, ord, key, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _section(df: DataFrame, section: str, key: Column, value: Column, order: list[Column]) -> DataFrame:
    """Entries of one section in order; groups are one repository's already aggregated entries."""
    place = F.row_number().over(Window.partitionBy("repository").orderBy(*order))
    return df.select(
        "repository",
        F.lit(section).alias("section"),
        place.cast("bigint").alias("ord"),
        key.cast("string").alias("key"),
        value.alias("value"),
    )


def _scalars(df: DataFrame, section: str, entries: list[tuple[str, Column]]) -> DataFrame:
    rows = F.array(
        *[F.struct(F.lit(key).alias("key"), value.cast("string").alias("value")) for key, value in entries]
    )
    return df.select("repository", F.posexplode(rows).alias("pos", "e")).select(
        "repository",
        F.lit(section).alias("section"),
        (F.col("pos") + 1).cast("bigint").alias("ord"),
        F.col("e.key").alias("key"),
        F.col("e.value").alias("value"),
    )


def _whole(name: str) -> Column:
    return F.format_number(F.col(name), 0)


def _hundredths(name: str) -> Column:
    return F.format_number(F.col(name), 2)


def report_rows(
    totals: DataFrame,
    languages: DataFrame,
    extensions: DataFrame,
    largest: DataFrame,
    commits: DataFrame,
    churned: DataFrame,
    top_changed: DataFrame,
    months: DataFrame,
) -> DataFrame:
    inventory = _scalars(
        totals,
        "1 inventory",
        [
            ("total files", _whole("total_files")),
            ("source-code files", _whole("source_code_files")),
            ("directories", _whole("directories")),
            ("total lines", _whole("total_loc")),
            ("average lines per source file", _hundredths("average_loc_per_source_file")),
        ],
    )
    history = _scalars(
        commits.join(churned, "repository", "left"),
        "5 history",
        [
            ("total commits", _whole("total_commits")),
            ("contributors", _whole("number_of_contributors")),
            ("most active contributor", F.col("most_active_name")),
            ("commits of the most active", _whole("most_active_commits")),
            ("commits analyzed for changes", _whole("analyzed_commits")),
            ("average files changed per month", _hundredths("average_files_changed_per_month")),
            ("average lines added per commit", _hundredths("average_added_lines_per_commit")),
            ("average lines deleted per commit", _hundredths("average_deleted_lines_per_commit")),
        ],
    )
    parts = [
        inventory,
        _section(
            languages, "2 languages", F.col("language"), _whole("files"), [F.desc("files"), F.asc("language")]
        ),
        _section(
            extensions,
            "3 file types",
            F.col("extension"),
            _whole("files"),
            [F.desc("files"), F.asc("extension")],
        ),
        _section(
            largest, "4 largest files", F.col("file_path"), _whole("loc"), [F.desc("loc"), F.asc("file_path")]
        ),
        history,
        _section(
            top_changed,
            "6 most changed files",
            F.col("file_path"),
            _whole("change_count"),
            [F.desc("change_count"), F.asc("file_path")],
        ),
        _section(months, "7 commits per month", F.col("month"), _whole("commits"), [F.asc("month")]),
    ]
    return reduce(DataFrame.unionByName, parts)
