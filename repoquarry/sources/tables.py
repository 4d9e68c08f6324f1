"""CSV metric tables, one folder per repository, and JSON vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repoquarry import schemas
from repoquarry.functions.text import strip
from repoquarry.sources.commit_log import parent_folder_of_file, place_in_file


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Columns by header name, all text: values are judged by the cleaning operators.

    Files whose headers disagree fail instead of being read by position.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(path)
    )


def _per_repository(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    schemas.require_columns(df, columns, what)
    return df.select(
        F.lower(strip(parent_folder_of_file(what))).alias("repository"),
        *columns,
        place_in_file().alias("_row"),
    )


def read_file_metrics(spark: SparkSession, root: str) -> DataFrame:
    df = read_csv(spark, f"{root}/*/file_metrics.csv")
    return _per_repository(df, schemas.FILE_METRIC_COLUMNS, "file_metrics.csv")


def read_history(spark: SparkSession, root: str) -> DataFrame:
    df = read_csv(spark, f"{root}/*/git_history_metrics.csv")
    return _per_repository(df, schemas.HISTORY_COLUMNS, "git_history_metrics.csv")


def read_token_frequency(spark: SparkSession, path: str) -> DataFrame:
    """(token, frequency); words such as null and NA stay tokens."""
    table = schemas.token_frequency_columns(read_csv(spark, path))
    return table.select("token", F.col("frequency").try_cast("bigint").alias("frequency"))


def read_vocabulary_json(spark: SparkSession, path: str) -> DataFrame:
    """(token, id) of a JSON object file."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "MAP<STRING,INT>")).alias("token", "id"))


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EMBEDDING_SCHEMA).parquet(path)


def unaligned_tokens(tokens: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Tokens without a vector and vectors without a token; no rows means the two fit together."""
    a = tokens.select("token")
    b = embeddings.select("token")
    return a.join(b, "token", "left_anti").withColumn("missing", F.lit("vector")).unionByName(
        b.join(a, "token", "left_anti").withColumn("missing", F.lit("token"))
    )


def load_aligned_embeddings(spark: SparkSession, path: str, tokens: DataFrame) -> DataFrame:
    embeddings = read_embeddings(spark, path)
    odd = unaligned_tokens(tokens, embeddings).limit(5).collect()
    if odd:
        raise ValueError(f"vectors and tokens do not match, for example {odd}")
    return embeddings
