"""Session settings and one shared folder for staged tables."""

import tempfile
import uuid

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    # All window keys are UTC wall-clock times, so text must be read on a UTC clock.
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles methods above 8000 bytes of bytecode, and cleaning two dozen columns
    # in one fused loop exceeds that: such stages ran half as fast as separate operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
_CHECKPOINT_DIR = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Sets the session's time zone and code-generation limit, which the operators rely on.

    Every reader calls it, so both settings then also hold for the caller's own queries.
    """
    for name, value in _SETTINGS.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode with none set."""
    context = spark.sparkContext
    folder = spark.conf.get(_CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"Set {_CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="windrose-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _on_file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks for the one path; nothing below it is listed."""
    files, place = _on_file_system(spark, path)
    return files.exists(place)


def staged(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    For results that several branches of one plan read: each branch then scans only the columns
    it needs, and a lost executor costs a re-read instead of the whole lineage.
    """
    path = path or new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes staged tables that nothing reads any more."""
    for path in paths:
        files, place = _on_file_system(spark, path)
        files.delete(place, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator:
    """A `staged` whose tables are removed when the block ends, also if it fails."""
    paths: list[str] = []

    def stage(df: DataFrame, label: str) -> DataFrame:
        paths.append(new_path(spark, label))
        return staged(df, label, paths[-1])

    try:
        yield stage
    finally:
        discard(spark, *paths)
