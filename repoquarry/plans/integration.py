"""Stage two: metric tables of many repositories to one table and its statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repoquarry.operators import integration as io
from repoquarry.operators import statistics as so
from repoquarry.session import materialize
from repoquarry.sources import tables


def integrate(files: DataFrame, history: DataFrame) -> dict[str, DataFrame]:
    """The first two statistics describe the tables as they came in, the third the cleaned join.

    The join is written once for all that reads it. Runs a job.
    """
    combined, _ = materialize(io.combine(io.clean_source(files), io.clean_history(history)), "combined")
    return {
        "combined": combined,
        "source_statistics": so.source_statistics(files),
        "history_statistics": so.history_statistics(history),
        "combined_statistics": so.combined_statistics(combined),
        "hotspots": so.hotspots(combined),
        "largest_files": so.largest(combined),
    }


def integrate_folder(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return integrate(tables.read_file_metrics(spark, root), tables.read_history(spark, root))
