"""Commit history metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repoquarry.functions.arrays import open_array
from repoquarry.functions.numbers import digits_only, ratio
from repoquarry.functions.text import strip
from repoquarry.operators.ranking import first_n_per_key, top_n

KEYS = ("repository",)
HISTORY_WINDOW = 400


def contributors(commits: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return commits.groupBy(*keys, "author").agg(F.count(F.lit(1)).alias("commit_count"))


def commit_totals(commits: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Commits, contributors and the most active one, from the counts per author.

    Equal counts go to the first name. The second grouping shuffles one row per author at most.
    """
    leader = F.min(F.struct((-F.col("commit_count")).alias("n"), F.col("author")))
    return (
        contributors(commits, keys)
        .groupBy(*keys)
        .agg(
            F.sum("commit_count").alias("total_commits"),
            F.count(F.lit(1)).alias("number_of_contributors"),
            leader.alias("_leader"),
        )
        .withColumn("most_active_name", F.col("_leader.author"))
        .withColumn("most_active_commits", -F.col("_leader.n"))
        .drop("_leader")
    )


def commits_per_month(commits: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Commits per month of the author's own clock; commits without a valid date are left out."""
    dated = commits.filter(F.col("month").isNotNull())
    return dated.groupBy(*keys, "month").agg(F.count(F.lit(1)).alias("commits"))


def latest_commits(
    commits: DataFrame,
    n: int = HISTORY_WINDOW,
    order: Sequence[Column] | None = None,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """The first ``n`` commits of each log (logs are newest first, so log order is the default)."""
    return first_n_per_key(commits, keys, order or [F.asc("seq")], n)


def change_rows(commits: DataFrame, keys: Sequence[str] = KEYS, keep: Sequence[str] = ()) -> DataFrame:
    """One row per changed file of commits that carry their changes as an array."""
    exploded = open_array(commits, F.col("changes"), "c", [*keys, "commit_hash", *keep])
    return exploded.select(*keys, "commit_hash", *keep, "c.additions", "c.deletions", "c.file_path")


def change_counts(changes: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Changes per file; rows without a path are left out."""
    named = changes.withColumn("file_path", strip(F.col("file_path"))).filter(F.col("file_path") != "")
    return named.groupBy(*keys, "file_path").agg(F.count(F.lit(1)).alias("change_count"))


def churn(commits: DataFrame, changes: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Totals and averages of a commit window.

    Commits without files count in the denominators. A change without a path counts as a changed file
    but adds no lines; neither do the dashes of binary files.
    """
    zero = F.lit(0).cast("bigint")
    has_path = strip(F.col("file_path")) != ""
    lines = changes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_files_changed"),
        F.sum(F.when(has_path, digits_only(F.col("additions")))).alias("total_lines_added"),
        F.sum(F.when(has_path, digits_only(F.col("deletions")))).alias("total_lines_deleted"),
    )
    window = commits.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("analyzed_commits"), F.count_distinct("month").alias("months")
    )
    joined = window.join(lines, list(keys), "left")
    totals = ["total_files_changed", "total_lines_added", "total_lines_deleted"]
    filled = joined.select(
        *keys, "analyzed_commits", "months", *[F.coalesce(c, zero).alias(c) for c in totals]
    )
    return (
        filled.withColumn(
            "average_files_changed_per_month", ratio(F.col("total_files_changed"), F.col("months"))
        )
        .withColumn(
            "average_added_lines_per_commit", ratio(F.col("total_lines_added"), F.col("analyzed_commits"))
        )
        .withColumn(
            "average_deleted_lines_per_commit",
            ratio(F.col("total_lines_deleted"), F.col("analyzed_commits")),
        )
    )


def top_changed_files(counts: DataFrame, n: int = 10, keys: Sequence[str] = KEYS) -> DataFrame:
    order = [F.desc("change_count"), F.asc("repository"), F.asc("file_path")]
    return top_n(counts.select("repository", "file_path", "change_count"), order, n, keys)
