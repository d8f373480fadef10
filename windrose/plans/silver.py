"""Silver: typed, cleaned, one row per (window, vehicle)."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrose.functions.text import number, strip, text_or, truthy
from windrose.operators.latest import latest_per_key
from windrose.schemas import (
    LOW_VELOCITY_MS,
    NUMERIC_STATE_COLUMNS,
    SILVER_COLUMNS,
    STALE_AFTER_SEC,
)


#: What ages and flags are computed from.
_FLAGGED = ["time_position", "last_contact", "on_ground", "velocity"]


def normalise_keys(raw: DataFrame) -> DataFrame:
    """Clean the vehicle, callsign and country texts; drop rows without a vehicle."""
    return raw.withColumns(
        {
            "icao24": strip(F.lower(F.coalesce("icao24", F.lit("")))),
            "callsign": text_or(F.col("callsign"), ""),
            "origin_country": text_or(F.col("origin_country"), "Unknown"),
        }
    ).filter(F.col("icao24") != "")


def coerce_numbers(raw: DataFrame) -> DataFrame:
    present = [c for c in NUMERIC_STATE_COLUMNS if c in raw.columns]
    return raw.withColumns({c: number(F.col(c)) for c in present})


def coerce_flags(raw: DataFrame) -> DataFrame:
    return raw.withColumn("on_ground", truthy(F.col("on_ground")))


def clean_states(raw: DataFrame) -> DataFrame:
    return coerce_flags(coerce_numbers(normalise_keys(raw)))


def latest_per_vehicle(states: DataFrame, kept: Sequence[str] | None = None) -> DataFrame:
    """The row with the latest contact per (window, vehicle); payload order breaks ties.

    Positions repeat between documents of one window; a hash of the row then decides, so that the
    result does not depend on the order of tasks.
    """
    order = [F.col("last_contact"), -F.col("pos"), F.xxhash64(*states.columns)]
    return latest_per_key(states, ["icao24", "window_start"], order, kept)


def _age(reference: Column, seen: Column) -> Column:
    """Seconds before the reference, not below zero; unknown stays null."""
    return F.when(seen.isNotNull(), F.greatest(reference - seen, F.lit(0.0)))


def _stale(age: Column, limit: int) -> Column:
    return F.coalesce(age, F.lit(float(limit + 1))) > limit


def with_ages_and_flags(
    states: DataFrame,
    *,
    reference_time: Column | None = None,
    stale_after_sec: int = STALE_AFTER_SEC,
    low_velocity_ms: float = LOW_VELOCITY_MS,
) -> DataFrame:
    """Ages against the window start (or `reference_time`) and the three quality flags."""
    reference = F.col("window_start") if reference_time is None else reference_time
    epoch = F.unix_timestamp(F.date_trunc("second", reference)).cast("double")
    slow = F.coalesce("velocity", F.lit(0.0)) < low_velocity_ms
    return states.withColumns(
        {
            "position_age_sec": _age(epoch, F.col("time_position")),
            "contact_age_sec": _age(epoch, F.col("last_contact")),
        }
    ).withColumns(
        {
            "is_stale_contact": _stale(F.col("contact_age_sec"), stale_after_sec),
            "is_stale_position": _stale(F.col("position_age_sec"), stale_after_sec),
            "is_low_velocity": ~F.col("on_ground") & slow,
        }
    )


def silver(raw: DataFrame, *, columns: Sequence[str] = SILVER_COLUMNS, **thresholds) -> DataFrame:
    """Raw state rows (`pos`, `window_start`, state columns) to the silver table, or some columns of it.

    All columns decide which of two rows is the latest, but only those that are asked for, and what
    ages and flags need, are shuffled with it.
    """
    states = raw.select("pos", *[c for c in SILVER_COLUMNS if c in raw.columns])
    latest = latest_per_vehicle(clean_states(states), [*columns, *_FLAGGED])
    flagged = with_ages_and_flags(latest, **thresholds)
    if "position_source" in columns:
        flagged = flagged.withColumn("position_source", F.col("position_source").try_cast("int"))
    return flagged.select(*columns)
