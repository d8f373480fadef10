"""Incremental run: new snapshot files flow through silver and gold into the KPI fact."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from windrose.operators.upsert import upsert_kpis
from windrose.plans.gold import gold_kpis
from windrose.plans.silver import silver
from windrose.schemas import SNAPSHOT_SCHEMA
from windrose.session import prepare
from windrose.sources.snapshots import explode_states, latest_documents, write_snapshots
from windrose.sources.tables import existing_folders, read_silver_windows, write_silver

KEY = T.StructField("window_key", T.StringType())


def refresh_windows(raw: DataFrame, keys: list, silver_path: str, fact_path: str) -> None:
    """Rebuild the windows `keys` from their `raw` rows: replace silver, upsert KPIs.

    `raw` holds those windows whole. KPI rows of countries that a window no longer reports stay.
    Only the folders of these windows are read again, so the cost does not grow with the history.
    """
    spark = raw.sparkSession
    write_silver(silver(raw), silver_path)
    upsert_kpis(spark, gold_kpis(read_silver_windows(spark, silver_path, keys)), fact_path)


def run_incremental(
    arrivals: DataFrame,
    read_windows: Callable[[list], DataFrame],
    *,
    silver_path: str,
    fact_path: str,
    checkpoint: str,
) -> None:
    """Process everything that has arrived since the last run with this checkpoint, then stop.

    `arrivals` is a stream with `window_key`; a micro-batch only says which windows changed.
    `read_windows` then reads those windows whole, so a window whose files arrive in different
    micro-batches, or that is landed again, ends up as one batch run over the landed files. The
    keys of a micro-batch, one for each window in it, pass through the driver.
    """

    def process(batch: DataFrame, _: int) -> None:
        keys = sorted((r[0] for r in batch.select("window_key").distinct().collect()), key=str)
        if keys:
            refresh_windows(read_windows(keys), keys, silver_path, fact_path)

    (
        arrivals.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def land_documents(spark: SparkSession, inbox: str, bronze_path: str, checkpoint: str) -> None:
    """Move new document files from a flat folder into bronze, one folder per window, then stop.

    A document for a window that is already in bronze replaces it.
    """

    def land(batch: DataFrame, _: int) -> None:
        write_snapshots(latest_documents(batch), bronze_path)

    (
        file_stream(spark, "json", SNAPSHOT_SCHEMA, inbox, None)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def run_snapshot_stream(
    spark: SparkSession,
    bronze_path: str,
    *,
    silver_path: str,
    fact_path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Incremental run over landed snapshot documents (see `write_snapshots`)."""
    schema = T.StructType([*SNAPSHOT_SCHEMA.fields, KEY])

    def read_windows(keys: list) -> DataFrame:
        folders = existing_folders(spark, bronze_path, "window_key", keys)
        reader = spark.read.schema(schema).option("mode", "FAILFAST").option("basePath", bronze_path)
        return explode_states(reader.json(folders))

    arrivals = file_stream(spark, "json", schema, bronze_path, files_per_batch)
    run_incremental(
        arrivals,
        read_windows,
        silver_path=silver_path,
        fact_path=fact_path,
        checkpoint=checkpoint,
    )


def run_state_stream(
    spark: SparkSession,
    raw_path: str,
    raw_schema: T.StructType,
    *,
    silver_path: str,
    fact_path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Incremental run over landed state rows, parquet partitioned by `window_key`."""
    schema = T.StructType([*raw_schema.fields, KEY])

    def read_windows(keys: list) -> DataFrame:
        folders = existing_folders(spark, raw_path, "window_key", keys)
        reader = spark.read.schema(schema).option("basePath", raw_path)
        return reader.parquet(*folders).drop("window_key")

    arrivals = file_stream(spark, "parquet", schema, raw_path, files_per_batch)
    run_incremental(
        arrivals,
        read_windows,
        silver_path=silver_path,
        fact_path=fact_path,
        checkpoint=checkpoint,
    )


def file_stream(
    spark: SparkSession, kind: str, schema: T.StructType, path: str, files_per_batch: int | None
) -> DataFrame:
    reader = prepare(spark).readStream.format(kind).schema(schema).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
