"""Table schemas and column checks. The checks look only at column names, so they cost no job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE_METRIC_COLUMNS = ["file_path", "language", "extension", "loc", "size_bytes"]
HISTORY_COLUMNS = ["file_path", "change_count"]
COMBINED_COLUMNS = [
    "repository",
    "file_path",
    "language",
    "extension",
    "loc",
    "size_bytes",
    "change_count",
    "history_present",
]

VOCAB_SCHEMA = "token STRING, token_id BIGINT, frequency BIGINT"
EMBEDDING_SCHEMA = "idx INT, token STRING, vec ARRAY<DOUBLE>"
BPE_VOCAB_SCHEMA = "token STRING, id INT"
BPE_MERGES_SCHEMA = "rank INT, left STRING, right STRING"
CHANGES_TYPE = "ARRAY<STRUCT<additions: STRING, deletions: STRING, file_path: STRING>>"

# Column names accepted for tokens, frequencies and document text, first match wins.
TOKEN_COLUMNS = ["token", "tokens", "subword", "word"]
FREQUENCY_COLUMNS = ["frequency", "count", "token_frequency"]
TEXT_COLUMNS = ["source_code", "code", "file_path"]


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str:
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of {list(candidates)} among columns {df.columns}")


def text_column(df: DataFrame) -> Column:
    """Document text from the first of source_code, code, file_path; null becomes ''."""
    return F.coalesce(F.col(resolve_column(df, TEXT_COLUMNS)).cast("string"), F.lit(""))


def token_frequency_columns(df: DataFrame) -> DataFrame:
    """Any accepted spelling of a frequency table as (token, frequency)."""
    token = resolve_column(df, TOKEN_COLUMNS)
    frequency = resolve_column(df, FREQUENCY_COLUMNS)
    return df.select(F.col(token).alias("token"), F.col(frequency).alias("frequency"))
