"""Dataset statistics in long form: (section, key, amount, average).

Long form keeps one row per entry, so a million repositories are a million rows and not one huge map.
Every breakdown comes from one scan: rows are first grouped by all dimensions at once, and the few
groups that remain are then dealt out to the sections they count for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repoquarry.functions.numbers import number
from repoquarry.operators.ranking import top_n


@dataclass(frozen=True)
class Section:
    """One statistic: ``kind`` of a ``measure`` (None counts rows), broken down by ``key`` if given."""

    name: str
    kind: str
    measure: str | None = None
    key: str | None = None
    distinct_as: str | None = None  # also report the number of different keys under this name


_EXACT = "decimal(38,18)"


def _is_whole(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.IntegralType)


def _number(df: DataFrame, name: str) -> Column:
    """The value as it is: only results are cut to whole numbers."""
    return F.col(name).cast("bigint") if _is_whole(df, name) else number(F.col(name))


def _entry(section: Section, kind: str) -> Column:
    m = section.measure
    null = F.lit(None).cast(kind)
    return F.struct(
        F.lit(section.name).alias("section"),
        (F.col(section.key).cast("string") if section.key else F.lit("")).alias("key"),
        F.lit(section.kind).alias("kind"),
        (F.col(f"{m}_n") if m else F.col("n")).alias("n"),
        (F.col(f"{m}_sum").cast(kind) if m else null).alias("total"),
        (F.col(f"{m}_min").cast(kind) if m else null).alias("low"),
        (F.col(f"{m}_max").cast(kind) if m else null).alias("high"),
    )


def summarize(df: DataFrame, dimensions: Sequence[str], sections: Sequence[Section]) -> DataFrame:
    measures = sorted({s.measure for s in sections if s.measure})
    aggregates = [F.count(F.lit(1)).alias("n")]
    for m in measures:
        value = _number(df, m)
        aggregates += [
            F.count(value).alias(f"{m}_n"),
            F.sum(value).alias(f"{m}_sum"),
            F.min(value).alias(f"{m}_min"),
            F.max(value).alias(f"{m}_max"),
        ]
    facts = df.groupBy(*dimensions).agg(*aggregates)
    held = "bigint" if all(_is_whole(df, m) for m in measures) else _EXACT
    entries = facts.select(F.explode(F.array(*[_entry(s, held) for s in sections])).alias("e")).select("e.*")
    merged = (
        entries.filter(F.col("key").isNotNull())
        .groupBy("section", "key", "kind")
        .agg(
            F.sum("n").alias("n"),
            F.sum("total").alias("total"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
    )
    kind = F.col("kind")
    amount = (
        F.when(kind == "count", F.col("n"))
        .when(kind == "sum", F.coalesce(F.col("total").cast("bigint"), F.lit(0).cast("bigint")))
        .when(kind == "min", F.col("low").cast("bigint"))
        .when(kind == "max", F.col("high").cast("bigint"))
    )
    average = F.when((kind == "average") & (F.col("n") > 0), F.col("total").cast("double") / F.col("n"))
    rows = merged.select("section", "key", amount.alias("amount"), average.alias("average"))

    named = {s.name: s.distinct_as for s in sections if s.distinct_as}
    if not named:
        return rows
    own = F.struct("section", "key", "amount", "average")
    extra = [
        F.when(
            F.col("section") == name,
            F.struct(
                F.lit(alias).alias("section"),
                F.lit("").alias("key"),
                F.lit(1).cast("bigint").alias("amount"),
                F.lit(None).cast("double").alias("average"),
            ),
        )
        for name, alias in named.items()
    ]
    dealt = rows.select(F.explode(F.array_compact(F.array(own, *extra))).alias("e")).select("e.*")
    return dealt.groupBy("section", "key").agg(
        F.sum("amount").alias("amount"), F.max("average").alias("average")
    )


def _distinct(df: DataFrame, column: str, section: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("amount")).select(
        F.lit(section).alias("section"),
        F.lit("").alias("key"),
        "amount",
        F.lit(None).cast("double").alias("average"),
    )


def source_statistics(df: DataFrame) -> DataFrame:
    sections = [
        Section("total_records", "count"),
        Section("languages", "count", key="language"),
        Section("extensions", "count", key="extension"),
        Section("records_per_repository", "count", key="repository", distinct_as="repositories"),
        Section("total_loc", "sum", "loc"),
        Section("average_loc", "average", "loc"),
        Section("maximum_loc", "max", "loc"),
        Section("minimum_loc", "min", "loc"),
        Section("total_size_bytes", "sum", "size_bytes"),
        Section("average_size_bytes", "average", "size_bytes"),
    ]
    rows = summarize(df, ["repository", "language", "extension"], sections)
    return rows.unionByName(_distinct(df, "file_path", "source_files"))


def history_statistics(df: DataFrame) -> DataFrame:
    sections = [
        Section("total_records", "count"),
        Section("records_per_repository", "count", key="repository", distinct_as="repositories"),
        Section("changes_per_repository", "sum", "change_count", key="repository"),
        Section("total_change_events", "sum", "change_count"),
        Section("average_change_count", "average", "change_count"),
        Section("maximum_change_count", "max", "change_count"),
        Section("minimum_change_count", "min", "change_count"),
    ]
    rows = summarize(df, ["repository"], sections)
    return rows.unionByName(_distinct(df, "file_path", "unique_files"))


def combined_statistics(df: DataFrame) -> DataFrame:
    sections = [
        Section("total_records", "count"),
        Section("languages", "count", key="language"),
        Section("records_per_repository", "count", key="repository", distinct_as="repositories"),
        Section("total_loc", "sum", "loc"),
        Section("average_loc", "average", "loc"),
        Section("total_size_bytes", "sum", "size_bytes"),
        Section("average_size_bytes", "average", "size_bytes"),
        Section("total_change_count", "sum", "change_count"),
        Section("average_change_count", "average", "change_count"),
        Section("files_with_history", "sum", "with_history"),
        Section("files_without_history", "sum", "without_history"),
    ]
    flagged = df.withColumn("with_history", F.col("history_present").cast("bigint")).withColumn(
        "without_history", (~F.col("history_present")).cast("bigint")
    )
    return summarize(flagged, ["repository", "language"], sections)


def hotspots(combined: DataFrame, n: int = 10) -> DataFrame:
    """Most frequently changed files of all repositories."""
    rows = combined.select("repository", "file_path", "change_count")
    return top_n(rows, [F.desc("change_count"), F.asc("repository"), F.asc("file_path")], n)


def largest(combined: DataFrame, n: int = 10) -> DataFrame:
    """Largest files of all repositories."""
    rows = combined.select("repository", "file_path", "loc")
    return top_n(rows, [F.desc("loc"), F.asc("repository"), F.asc("file_path")], n)
