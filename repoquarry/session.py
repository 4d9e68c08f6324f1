"""Shared-folder tables that cut lineage, and balancing of small inputs."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Rows a selection may have to be handed to every executor.
SELECTION_ROWS = 10_000

_LOCAL_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the tasks' Python this package, once per application, as Spark ships any Python file."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="repoquarry-")) / "repoquarry.zip"
    with zipfile.ZipFile(archive, "w") as zipped:
        for source in sorted(package.rglob("*.py")):
            zipped.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset a folder is made only for a local master, whose one machine holds all tasks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="repoquarry-")
    return _LOCAL_DIRS[app]


def application_folder(spark: SparkSession) -> str:
    """All written tables of one application lie together, to be removed after it."""
    return f"{scratch_dir(spark)}/repoquarry-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """Write ``df`` once to the shared folder and read it back: survives lost executors."""
    spark = df.sparkSession
    path = f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a table made by ``materialize`` once nothing reads it any more."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of tables that were written and that nothing uses any more.

    Spark does so when the driver's JVM collects its garbage, which may be long after the disk is needed.
    """
    for _ in range(2):  # what the first round ends may hold on to more
        gc.collect()  # Python's own references keep plans alive
        spark._jvm.System.gc()


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, the number that also decides on broadcasts."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def spread(df: DataFrame) -> DataFrame:
    """Spread an input over all cores when it is too small to do so by itself.

    A file with one row group is one task however many cores there are. Repartitioning is worth it
    only below one scan split per core; larger inputs already have enough splits and are left alone,
    so the rows moved are at most cores x maxPartitionBytes.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if cores > 1 and estimated_bytes(df) < cores * split:
        return df.repartition(cores)
    return df
