"""File trees laid out as <root>/<repository>/<path>.

Spark's own file sources leave out names that begin with '_' or '.' and files without content, all of
which belong to a repository. Trees are therefore listed folder by folder: each round is a job whose
tasks open the folders found by the round before, so listing is shared out like any other data.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repoquarry.operators.files import describe_files
from repoquarry.session import materialize
from repoquarry.sources.file_systems import hadoop_settings, open_root, resolved

_ENTRY_SCHEMA = "path STRING, is_folder BOOLEAN, size_bytes BIGINT"
_CHUNK = 1 << 20
RANGE_BYTES = 64 << 20  # of a file read by one row of work


def _list_folders(root: str, settings: dict[str, str]):
    """Entries of folders given relative to the root; nothing below .git is listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_system, base = open_root(root, settings)
        for batch in batches:
            rows = []
            for folder in batch.column("path").to_pylist():
                address = f"{base}/{folder}" if folder else base
                for entry in file_system.get_file_info(pafs.FileSelector(address)):
                    if entry.base_name == ".git":
                        continue
                    is_folder = entry.type == pafs.FileType.Directory
                    size = 0 if is_folder else entry.size
                    rows.append((entry.path[len(base) + 1 :], is_folder, size))
            paths, folders, sizes = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(paths, pa.string()),
                    pa.array(folders, pa.bool_()),
                    pa.array(sizes, pa.int64()),
                ],
                names=["path", "is_folder", "size_bytes"],
            )

    return run


def scan(spark: SparkSession, root: str) -> DataFrame:
    """(repository, file_path, is_folder, size_bytes) of everything below the repositories' folders.

    Runs one job per folder depth; levels are kept in the shared folder.
    """
    root, settings = resolved(spark, root), hadoop_settings(spark)
    tasks = spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([("",)], "path STRING")
    levels = []
    while True:
        found = folders.repartition(tasks).mapInArrow(_list_folders(root, settings), _ENTRY_SCHEMA)
        level, _ = materialize(found, "tree")
        levels.append(level)
        folders = level.filter("is_folder").select("path")
        if not folders.limit(1).collect():
            break
    entries = reduce(DataFrame.unionByName, levels).filter(F.col("path").contains("/"))
    return entries.select(
        F.substring_index("path", "/", 1).alias("repository"),
        F.regexp_replace("path", r"^[^/]*/", "").alias("file_path"),
        "is_folder",
        "size_bytes",
    )


def files_of(entries: DataFrame) -> DataFrame:
    return entries.filter(~F.col("is_folder")).drop("is_folder")


def folders_of(entries: DataFrame) -> DataFrame:
    return entries.filter("is_folder").select("repository", F.col("file_path").alias("folder"))


def _count_range(file_system: pafs.FileSystem, address: str, start: int, length: int) -> tuple[int | None, bool]:
    """Line feeds of a stretch of a file, and whether its last byte is another one; (None, False) if it cannot be read."""
    lines, last = 0, b"\n"
    try:
        with file_system.open_input_file(address) as stream:
            stream.seek(start)
            while length > 0 and (chunk := stream.read(min(_CHUNK, length))):
                lines += chunk.count(b"\n")
                last, length = chunk[-1:], length - len(chunk)
    except OSError:
        return None, False
    return lines, last != b"\n"


def measure_sources(files: DataFrame, root: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(repository, file_path, size_bytes, loc) of source files: line feeds, plus one for an open last line.

    Files are read in ranges that are dealt over the tasks, so one huge file is the work of many. A file of
    which a part cannot be read counts 0 lines.
    """
    spark = files.sparkSession
    root, settings = resolved(spark, root), hadoop_settings(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_system, base = open_root(root, settings)
        for batch in batches:
            repositories, paths, starts, sizes = (batch.column(c).to_pylist() for c in ("repository", "file_path", "start", "size_bytes"))
            counted = [
                _count_range(file_system, f"{base}/{repository}/{path}", start, min(range_bytes, size - start))
                for repository, path, start, size in zip(repositories, paths, starts, sizes, strict=True)
            ]
            lines, is_open = zip(*counted) if counted else ((), ())
            ends = [flag and start + range_bytes >= size for flag, start, size in zip(is_open, starts, sizes, strict=True)]
            out = batch.append_column("lines", pa.array(lines, pa.int64())).append_column("is_open", pa.array(ends, pa.bool_()))
            yield out.drop_columns(["start"])

    sources = describe_files(files).filter(F.col("language").isNotNull()).select("repository", "file_path", "size_bytes")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size_bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint"))
    ranges = sources.select("*", F.explode(starts).alias("start"))
    dealt = ranges.repartition(spark.sparkContext.defaultParallelism * 4)
    counted = dealt.mapInArrow(run, "repository STRING, file_path STRING, size_bytes BIGINT, lines BIGINT, is_open BOOLEAN")
    whole = F.count("lines") == F.count(F.lit(1))
    loc = F.when(whole, F.sum("lines") + F.max(F.col("is_open").cast("int"))).otherwise(0)
    return counted.groupBy("repository", "file_path", "size_bytes").agg(loc.cast("bigint").alias("loc"))
