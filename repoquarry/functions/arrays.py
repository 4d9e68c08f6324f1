"""Opening computed arrays into rows.

For a plain explode the optimizer adds a filter on the array being filled, and for a computed array
that filter computes it again, twice, below the next exchange. The outer forms get no such filter; the
row they give for an empty array is dropped after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def open_array(df: DataFrame, array: Column, name: str, keep: Sequence[str | Column] = ()) -> DataFrame:
    """One row per element; elements are never null."""
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def open_places(
    df: DataFrame, array: Column, name: str, keep: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per element with its place ``pos`` and the array's length ``n``.

    The length is worked out before opening, so that the array itself does not travel with its rows.
    """
    sized = df.select(*keep, array.alias("_array")).withColumn("n", F.size("_array"))
    names = [c for c in sized.columns if c != "_array"]
    opened = sized.select(*names, F.posexplode_outer("_array").alias("pos", name))
    return opened.filter(F.col("pos").isNotNull())


def keep_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on costly computed columns without computing them a second time.

    A plain filter moves below the projection that computes its columns and repeats their
    expressions there. Opening a one-element or empty array instead stays where it is.
    """
    flag = F.when(condition, F.array(F.lit(True)))
    opened = df.select("*", F.explode_outer(flag).alias("_kept"))
    return opened.filter(F.col("_kept").isNotNull()).drop("_kept")
