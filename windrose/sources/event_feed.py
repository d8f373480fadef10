"""Reads the generic `events` table as telemetry: raw state rows and raw override rows.

The mapping uses every event with a time and a user number of zero or more, as the given tables have;
events without one have no place in the mapping. It plants the feed's irregularities (nulls, blanks, tokens, bad
numbers, repeated vehicles, ties) by the integer `k` in the event's properties.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.schemas import STATE_COLUMNS
from windrose.session import prepare

WINDOW = "12 hours"
NATIONS = 25


def _located_events(spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark)
    events = spark.read.parquet(f"{folder}/events.parquet")
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    region = spark.read.parquet(f"{folder}/region.parquet")
    places = (
        nation.filter(F.col("n_nationkey").between(0, NATIONS - 1))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name")
    )
    # The key takes only NATIONS values, so this side stays that small at any scale.
    home = F.col("user_id") % NATIONS == F.col("n_nationkey")
    return events.join(F.broadcast(places), home).select(
        F.col("event_id").alias("pos"),
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        "r_name",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def assign_window(ts: Column, length: str = "30 minutes") -> Column:
    """Start of the tumbling window that holds `ts`."""
    return F.window(ts, length).getField("start")


def _text(c: Column) -> Column:
    return c.cast("string")


def read_raw_states(spark: SparkSession, folder: str) -> DataFrame:
    """`pos`, `window_start` and the state vector's text columns."""
    k, value = F.col("k"), F.col("value")
    null = F.lit(None).cast("string")
    epoch = F.unix_timestamp("window_start")
    columns = {
        "icao24": F.when(k == 98, null)
        .when(k == 99, "  ")
        .otherwise(
            F.concat(
                F.lit("AC"), F.lpad(_text(F.col("user_id") * 4 + k % 4), 6, "0"), F.lit(" ")
            )
        ),
        "callsign": F.when(k % 9 == 0, null)
        .when(k % 9 == 1, F.concat(F.lit('\t"C", \\S'), _text(F.col("user_id"))))
        .otherwise(F.concat(F.lit("\tCS"), _text(F.col("user_id")), F.lit(" "))),
        "origin_country": F.when(k == 97, null)
        .when(k == 96, "  ")
        .when(k == 95, "NA")
        .otherwise(F.concat(F.lit(" "), F.col("r_name"))),
        "time_position": F.when(k % 7 == 0, null).otherwise(_text(epoch - (k * 2 - 50))),
        "last_contact": F.when(k % 19 == 0, null)
        .when(k == 1, "bad")
        .otherwise(_text(epoch - (k * 3 - 100))),
        "longitude": F.when(k == 2, "").otherwise(_text((k - 50) * 2)),
        "latitude": _text(k - 45),
        "baro_altitude": F.when(k % 13 == 0, null).otherwise(_text(k * 250)),
        "on_ground": F.when(k % 23 == 0, null).otherwise(
            F.when(F.col("event_type") == "error", "true").otherwise("false")
        ),
        "velocity": F.when(k % 17 == 0, "n/a").otherwise(_text(value * 5)),
        "true_track": _text(k * 3),
        "vertical_rate": _text((k - 50) / 10),
        "sensors": null,
        "geo_altitude": F.when(k % 13 == 0, null).otherwise(_text(value * 100)),
        "squawk": F.lpad(_text(k), 4, "0"),
        "spi": F.lit("false"),
        "position_source": _text(k % 4),
    }
    events = _located_events(spark, folder).withColumn(
        "window_start", assign_window(F.col("ts"), WINDOW)
    )
    return events.select(
        "pos", "window_start", "ts", *[columns[c].alias(c) for c in STATE_COLUMNS]
    )


def read_raw_overrides(spark: SparkSession, folder: str) -> DataFrame:
    """Override rows as text, whole days long; `ordinal` is the event's number."""
    k = F.col("k")
    day = F.date_trunc("day", "ts")
    return _raw_overrides(
        spark,
        folder,
        severity=_text(F.col("value")),
        start=day,
        end=day + F.make_dt_interval(k % 4),
    )


def read_raw_incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Override rows a few hours long, so that windows differ in what covers them."""
    k = F.col("k")
    return _raw_overrides(
        spark,
        folder,
        severity=_text(F.col("value") / 4),
        start=F.col("ts"),
        end=F.col("ts") + F.make_dt_interval(F.lit(0), k % 4),
    )


def _raw_overrides(
    spark: SparkSession, folder: str, *, severity: Column, start: Column, end: Column
) -> DataFrame:
    k = F.col("k")
    name = F.col("r_name")
    null = F.lit(None).cast("string")
    bands = ["HIGH ", "watch", "Critical", "severe", None, "normal"]
    flags = ["Yes", "true", "1.0", None, " T "]

    def pick(options: list[str | None]) -> Column:
        texts = [F.lit(o).cast("string") for o in options]
        return F.get(F.array(*texts), k % len(options))

    return _located_events(spark, folder).select(
        F.col("pos").alias("ordinal"),
        F.when(k % 7 == 0, null)
        .when(k % 7 == 1, "COUNTRY ")
        .otherwise("country")
        .alias("region_type"),
        F.when(k % 11 == 0, "  ")
        .when(k % 2 == 0, F.lower(name))
        .otherwise(F.concat(F.lit(" "), name))
        .alias("region_value"),
        F.when(k % 9 != 0, F.upper("event_type")).alias("event_type"),
        F.when(k % 8 != 0, F.concat(F.lit("src"), _text(k % 3))).alias("source"),
        F.concat(pick([' say "go", now ', " C:\\logs\\", " two\nlines ", " note "]), _text(k)).alias("notes"),
        F.when(k % 10 == 0, "bad").otherwise(severity).alias("severity_score"),
        pick(bands).alias("min_disruption_band"),
        _text(start).alias("event_start_utc"),
        _text(end).alias("event_end_utc"),
        pick(flags).alias("is_active"),
    )
