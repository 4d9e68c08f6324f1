"""Exported commit logs, one folder per repository: <root>/<repository>/<name>, or a folder of part files
there that follow one another by name; ``name`` says which folder name that is.

Two exports are read: the metadata log of all refs (``%H<TAB>%an<TAB>%aI`` per line) and the change
log of the current branch (``COMMIT<TAB>%H<TAB>%aI`` headers, each followed by numstat lines).
``seq`` is the place of a record in its log. It orders by split offset, then by row in the split, so
it needs no shuffle and a retried task gives the same value.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repoquarry.functions import dates


def parent_folder_of_file(name: str | None = None) -> Column:
    """Folder name of the file being read; the address is URL-encoded, a literal '+' is not a space.

    With ``name``, that of the folder that holds a file of this name, or a folder of part files.
    """
    below = r"[^/]*" if name is None else rf"{re.escape(name)}(?:/[^/]*)?"
    folder = F.regexp_extract("_metadata.file_path", rf"([^/]+)/{below}$", 1)
    return F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))


def place_in_file() -> Column:
    """Order of rows: by file, then as they stand in it, however Spark packs files into tasks."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def parse_commits(lines: DataFrame) -> DataFrame:
    """Lines (repository, seq, value) to commits; lines without three tab fields are skipped."""
    fields = F.split("value", "\t", 3)
    return (
        lines.filter(F.size(fields) == 3)
        .select(
            "repository",
            "seq",
            fields[0].alias("commit_hash"),
            F.when(fields[1] == "", "Unknown").otherwise(fields[1]).alias("author"),
            fields[2].alias("author_date"),
        )
        .withColumn("month", dates.local_month(F.col("author_date")))
    )


def parse_change_records(records: DataFrame) -> DataFrame:
    """Records (repository, seq, value), one commit each, to commits with an array of changes."""
    text = F.regexp_replace("value", r"^\s*COMMIT\t", "")
    lines = F.split(text, "\n")
    header = F.split(lines[0], "\t", 2)
    fields = F.transform(F.slice(lines, 2, F.size(lines)), lambda x: F.split(x, "\t", 3))
    changes = F.transform(
        F.filter(fields, lambda p: F.size(p) == 3),
        lambda p: F.struct(p[0].alias("additions"), p[1].alias("deletions"), p[2].alias("file_path")),
    )
    return (
        records.filter(F.trim(text) != "")
        .select(
            "repository",
            "seq",
            header[0].alias("commit_hash"),
            F.try_element_at(header, F.lit(2)).alias("author_date"),
            changes.alias("changes"),
        )
        .withColumn("month", dates.local_month(F.col("author_date")))
    )


def read_commits(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return parse_commits(
        lines.select(parent_folder_of_file(name).alias("repository"), place_in_file().alias("seq"), "value")
    )


def read_changes(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """The separator is the start of the next commit, so a commit is one record of a splittable scan."""
    records = spark.read.option("lineSep", "\nCOMMIT\t").text(path)
    return parse_change_records(
        records.select(parent_folder_of_file(name).alias("repository"), place_in_file().alias("seq"), "value")
    )
