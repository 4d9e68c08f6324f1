"""Cleaning and joining metric tables of many repositories."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repoquarry.functions.arrays import keep_rows
from repoquarry.functions.numbers import whole_not_negative
from repoquarry.functions.paths import forward_slashes
from repoquarry.functions.text import strip
from repoquarry.operators.ranking import first_n_per_key
from repoquarry.schemas import COMBINED_COLUMNS, require_columns

JOIN_KEYS = ["repository", "file_path"]


def union_repositories(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def tag_repository(df: DataFrame, name: str) -> DataFrame:
    """Put the repository name, trimmed and in lower case, in front."""
    return df.select(F.lower(strip(F.lit(name))).alias("repository"), *df.columns)


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Rows that are null in every column; a row number does not count as content."""
    return df.dropna(how="all", subset=[c for c in df.columns if not c.startswith("_")])


def _text(name: str) -> Column:
    return strip(F.coalesce(F.col(name).cast("string"), F.lit("")))


def _keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"repository": _text("repository"), "file_path": forward_slashes(_text("file_path"))})


def _valid(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Tidy keys that are not empty and whole non-negative numbers; other rows are dropped."""
    tidy = _keys(df).withColumns({name: whole_not_negative(F.col(name)) for name in measures})
    condition = (F.col("repository") != "") & (F.col("file_path") != "")
    for name in measures:
        condition = condition & F.col(name).isNotNull()
    return keep_rows(tidy, condition)


def clean_source(df: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """Valid source rows, the first of each (repository, file_path) in ``order``.

    ``order`` is the row order of the input, by default its ``_row`` column. The cut to one row per
    key runs before the shuffle too, so many copies of one key do not meet in one task.
    """
    df = drop_empty_rows(normalize_columns(df))
    require_columns(df, ["repository", "file_path", "language", "extension", "loc", "size_bytes"])
    for name in ("language", "extension"):
        df = df.withColumn(name, _text(name))
    valid = _valid(df, ["loc", "size_bytes"])
    return first_n_per_key(valid, JOIN_KEYS, order or [F.asc("_row")], 1)


def clean_history(df: DataFrame) -> DataFrame:
    """Valid history rows, duplicates of (repository, file_path) added up."""
    df = drop_empty_rows(normalize_columns(df))
    require_columns(df, ["repository", "file_path", "change_count"])
    valid = _valid(df, ["change_count"])
    return valid.groupBy(*JOIN_KEYS).agg(F.sum("change_count").alias("change_count"))


def combine(source: DataFrame, history: DataFrame) -> DataFrame:
    """Every source row with its change count, 0 where the history has none.

    ``history`` has one row per key, so no source row is multiplied; the join strategy and the
    splitting of hot partitions are left to adaptive execution.
    """
    joined = source.join(history, JOIN_KEYS, "left")
    counted = joined.withColumn("change_count", F.coalesce("change_count", F.lit(0)).cast("bigint"))
    return counted.withColumn("history_present", F.col("change_count") > 0).select(*COMBINED_COLUMNS)
