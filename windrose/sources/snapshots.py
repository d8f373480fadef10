"""Bronze layer: landed snapshot documents, one JSON document per window."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from windrose.schemas import (
    INGESTION_FIELD,
    LOW_VOLUME_STATES,
    SNAPSHOT_SCHEMA,
    STATE_COLUMNS,
    STATE_COLUMNS_WIDE,
    WINDOW_KEY_FORMAT,
)
from windrose.session import prepare


def read_snapshots(spark: SparkSession, path: str, *, multiline: bool = False) -> DataFrame:
    """Landed documents under `path`; broken JSON fails the read."""
    reader = prepare(spark).read.schema(SNAPSHOT_SCHEMA).option("mode", "FAILFAST")
    return reader.option("multiLine", multiline).json(path)


def window_key(window_start: Column) -> Column:
    return F.date_format(window_start, WINDOW_KEY_FORMAT)


def state_count(states: Column) -> Column:
    return F.coalesce(F.size(states), F.lit(0)).cast("bigint")


def with_ingestion_metadata(
    payloads: DataFrame,
    *,
    window_start: Column,
    requested_at: Column,
    received_at: Column,
    http_status: Column,
    authenticated: Column,
) -> DataFrame:
    """Attach the request record to raw payload rows (`time`, `states`)."""
    elapsed_ms = ((F.unix_micros(received_at) - F.unix_micros(requested_at)) / 1000).cast("bigint")
    record = F.struct(
        window_start.alias("window_start_utc"),
        state_count(F.col("states")).alias("state_count"),
        requested_at.alias("requested_at_utc"),
        received_at.alias("received_at_utc"),
        elapsed_ms.alias("response_time_ms"),
        http_status.cast("int").alias("http_status"),
        F.when(authenticated, "authenticated").otherwise("anonymous").alias("auth_mode"),
    )
    return payloads.select("time", "states", record.alias(INGESTION_FIELD))


def with_volume_flag(
    snapshots: DataFrame,
    count: Column | None = None,
    minimum: int = LOW_VOLUME_STATES,
) -> DataFrame:
    """Mark snapshots with suspiciously few states; they are processed all the same."""
    states = F.col(f"{INGESTION_FIELD}.state_count") if count is None else count
    return snapshots.withColumn("is_low_volume", states < minimum)


def observe_volume(
    snapshots: DataFrame, observation: Observation, minimum: int = LOW_VOLUME_STATES
) -> DataFrame:
    """Collect volume metrics while the snapshots flow by, with no extra job."""
    count = F.col(f"{INGESTION_FIELD}.state_count")
    return snapshots.observe(
        observation,
        F.count("*").alias("snapshots"),
        F.sum(count).alias("states"),
        F.count_if(count < minimum).alias("low_volume_snapshots"),
    )


def latest_documents(snapshots: DataFrame) -> DataFrame:
    """Of several documents for one window, those received last; documents are not shuffled."""
    window, received = (
        F.col(f"{INGESTION_FIELD}.{name}") for name in ("window_start_utc", "received_at_utc")
    )
    last = snapshots.groupBy(window.alias("_window")).agg(F.max(received).alias("_received"))
    is_last = (F.col("_window") == window) & F.col("_received").eqNullSafe(received)
    return snapshots.join(last, is_last, "left_semi")


def write_snapshots(snapshots: DataFrame, path: str) -> None:
    """Land documents under one folder per window; landing a window again replaces it."""
    (
        snapshots.withColumn("window_key", window_key(F.col(f"{INGESTION_FIELD}.window_start_utc")))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("window_key")
        .json(path)
    )


def _checked_states() -> Column:
    """`states`, or an error for widths the feed does not have.

    The first vector sets the width. Shorter vectors are padded with nulls later; longer ones
    have values no column could take, so they fail.
    """
    width = F.size(F.get("states", F.lit(0)))
    widest = F.array_max(F.transform("states", F.size))
    return (
        F.when(F.coalesce(F.size("states"), F.lit(0)) == 0, F.col("states"))
        .when(
            ~width.isin(len(STATE_COLUMNS), len(STATE_COLUMNS_WIDE)),
            F.raise_error(F.concat(F.lit("Unexpected state vector width: "), width)),
        )
        .when(
            widest > width,
            F.raise_error(F.concat(F.lit("State vector wider than the first one: "), widest)),
        )
        .otherwise(F.col("states"))
    )


def explode_states(snapshots: DataFrame) -> DataFrame:
    """One row per state vector: `pos`, `window_start` and the vector's named text columns."""
    return snapshots.select(
        F.date_trunc("second", f"{INGESTION_FIELD}.window_start_utc").alias("window_start"),
        F.posexplode(_checked_states()).alias("pos", "state"),
    ).select(
        F.col("pos").cast("bigint").alias("pos"),
        "window_start",
        *[F.get("state", F.lit(i)).alias(c) for i, c in enumerate(STATE_COLUMNS_WIDE)],
    )
