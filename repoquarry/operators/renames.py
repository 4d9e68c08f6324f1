"""Renamed files: one history per file instead of one per path.

A change log writes a rename as ``old => new`` or, with the common parts outside, ``a/{old => new}/b``. Every such
row is an edge between two paths, and connected paths are one file. Its name is the one it was given last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repoquarry.functions.text import strip
from repoquarry.operators.components import connected
from repoquarry.operators.history import KEYS
from repoquarry.session import materialize

_INSIDE = r"^(.*?)\{(.*?) => (.*?)\}(.*)$"
_WHOLE = r"^(.*?) => (.*)$"
ARROW = " => "


def _path(*parts: Column) -> Column:
    """Parts put together; an empty one leaves two slashes, or one at the front."""
    return F.regexp_replace(F.regexp_replace(F.concat(*parts), "/{2,}", "/"), "^/", "")


def rename_ends(path: Column) -> tuple[Column, Column]:
    """Old and new path of a rename; both null for any other path."""
    inside = [F.regexp_extract(path, _INSIDE, i) for i in range(1, 5)]
    front, old, new, back = inside
    arrow = path.contains(ARROW)  # most paths have none and meet no expression
    is_inside, is_whole = arrow & path.rlike(_INSIDE), arrow & path.rlike(_WHOLE)
    return (
        F.when(is_inside, _path(front, old, back)).when(is_whole, F.regexp_extract(path, _WHOLE, 1)),
        F.when(is_inside, _path(front, new, back)).when(is_whole, F.regexp_extract(path, _WHOLE, 2)),
    )


def with_new_paths(changes: DataFrame) -> DataFrame:
    """Renames carry the new path in file_path and the old one in renamed_from, which is null elsewhere."""
    old, new = rename_ends(F.col("file_path"))
    return changes.withColumns({"renamed_from": old, "file_path": F.coalesce(new, F.col("file_path"))})


def _written_paths(changes: DataFrame, order: Sequence[Column], keys: Sequence[str]) -> DataFrame:
    """(keys, file_path, change_count, place): one row of each path as the log writes it, renames with the place of
    the newest. Changes are read once; all that follows works on paths. Runs a job."""
    place = F.when(F.col("file_path").contains(ARROW), F.struct(*order))
    counted = changes.groupBy(*keys, "file_path").agg(F.count(F.lit(1)).alias("change_count"), F.min(place).alias("place"))
    return materialize(counted, "written")[0]


def _histories(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    named = with_new_paths(written).filter("renamed_from IS NOT NULL AND renamed_from != file_path")
    old, new = (F.struct(*keys, F.col(c).alias("path")) for c in ("renamed_from", "file_path"))
    renames, _ = materialize(named.select(old.alias("old"), new.alias("new"), F.struct("place", "file_path").alias("place")), "renames")
    files, _ = materialize(connected(renames.select("old", "new").distinct(), "old", "new"), "files")
    newest = renames.groupBy("new").agg(F.min("place").alias("place"))
    last = newest.join(files, F.col("new") == F.col("node")).groupBy("root").agg(F.min_by("new", "place").alias("last"))
    return files.join(last, "root").select("node.*", F.col("last.path").alias("file_path"))


def path_histories(changes: DataFrame, order: Sequence[Column], keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, path, file_path): the last name of every path that a rename touches. Runs jobs.

    ``order`` puts the newest change first; among renames at one place the smaller new path is the last.
    """
    return _histories(_written_paths(changes, order, keys), keys)


def renamed_change_counts(changes: DataFrame, order: Sequence[Column], keys: Sequence[str] = KEYS) -> DataFrame:
    """Changes per file over all its names, under the last one. Runs jobs.

    Changes are counted per written path before these are taken apart and meet their histories, so a path with many
    changes is one row of the join.
    """
    written = _written_paths(changes, order, keys)
    histories = _histories(written, keys)
    named = with_new_paths(written).withColumn("path", strip(F.col("file_path"))).filter(F.col("path") != "")
    counts = named.groupBy(*keys, "path").agg(F.sum("change_count").alias("change_count"))
    joined = counts.join(histories, [*keys, "path"], "left")
    name = F.coalesce("file_path", "path").alias("file_path")
    return joined.select(*keys, name, "change_count").groupBy(*keys, "file_path").agg(F.sum("change_count").alias("change_count"))
