"""Every operator as a query over the driver's tables, with the SQL that should give the same rows."""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from repoquarry.queries import embeddings, folders, integration, mining, tokens
from repoquarry.session import ship_package


def _shipped(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run



MODULES = (mining, integration, tokens, embeddings, folders)
QUERIES = {name: _shipped(query) for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
