"""Settings and small helpers shared by the corpus operators."""

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.session import new_path

#: Word separators of the corpus contracts: ASCII white space only.
WORD = r"[^\x20\x09-\x0D]+"

_SETTINGS = {
    # Rows cross to Python in batches of at most so many rows and bytes, so that a run of long
    # texts cannot fill a worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds the batches that are sent to Python workers, and lets the workers find this package."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, _ROOT]))
    for name, value in _SETTINGS.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def stored(df: DataFrame, label: str, **options: str | int) -> tuple[DataFrame, str]:
    """`df` written to the shared folder and read back, and where it is; options are the writer's.

    Cuts the lineage: a lost executor then costs a re-read. Small results read back this way carry
    their true size, by which Spark decides on broadcasts.
    """
    path = new_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes intermediate tables that `stored` wrote."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[list[str]]:
    """A list for paths of tables that are removed when the block ends, also if it fails."""
    paths: list[str] = []
    try:
        yield paths
    finally:
        discard(spark, *paths)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within the block the files of a query's shuffles go when it ends, not when the driver collects garbage.

    For queries that each run once, such as those that `stored` writes.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or with underscores before it if `df` has such a column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
