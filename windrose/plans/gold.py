"""Gold: KPIs per (window, country)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrose.functions.numeric import clip, exact_mean, half_even
from windrose.functions.quantiles import grouped_quantiles
from windrose.functions.text import csv_null
from windrose.operators.checks import require_columns
from windrose.schemas import (
    CLIMB_RATE,
    DESCENT_RATE,
    GOLD_COLUMNS,
    GOLD_INPUT_COLUMNS,
    GOLD_SCHEMA,
    KPI_KEY,
)
from windrose.sources.tables import conform


def with_measures(silver: DataFrame) -> DataFrame:
    """Rows that belong to a country, with the columns the KPIs aggregate.

    Country and vehicle texts that stand for a missing cell count as missing, and rows without a
    country leave the KPIs.
    """
    require_columns(silver, GOLD_INPUT_COLUMNS, "Silver table")
    airborne = ~F.col("on_ground")
    return (
        silver.select(*GOLD_INPUT_COLUMNS)
        .withColumns(
            {
                "origin_country": csv_null(F.col("origin_country")),
                "icao24": csv_null(F.col("icao24")),
            }
        )
        .filter(F.col("origin_country").isNotNull() & F.col("window_start").isNotNull())
        .withColumns(
            {
                "is_active": airborne,
                "airborne_velocity": F.when(airborne, F.col("velocity")),
                "airborne_altitude": F.when(airborne, F.col("geo_altitude")),
                "airborne_vertical_speed": F.when(airborne, F.abs("vertical_rate")),
                "is_complete": F.col("icao24").isNotNull()
                & F.col("velocity").isNotNull()
                & F.col("last_contact").isNotNull(),
            }
        )
    )


def count_kpis() -> list[Column]:
    rate = F.col("vertical_rate")
    return [
        F.count("icao24").alias("total_flights"),
        F.count_if("is_active").alias("active_flights"),
        F.count_if("on_ground").alias("on_ground"),
        F.count_if(F.col("is_active") & (rate > CLIMB_RATE)).alias("climbing_flights"),
        F.count_if(F.col("is_active") & (rate < DESCENT_RATE)).alias("descending_flights"),
    ]


def mean_kpis() -> list[Column]:
    def mean(measure: str) -> Column:
        return half_even(F.coalesce(exact_mean(F.col(measure)), F.lit(0.0)), 4)

    return [
        mean("airborne_velocity").alias("avg_velocity_active"),
        mean("airborne_vertical_speed").alias("avg_abs_vertical_rate_active"),
    ]


def rate_kpis() -> list[Column]:
    def percent(flag: str) -> Column:
        return half_even(F.count_if(flag) / F.count("*") * 100.0, 2)

    return [
        percent("is_stale_contact").alias("stale_contact_rate"),
        percent("is_low_velocity").alias("low_velocity_rate"),
        percent("is_complete").alias("data_completeness_score"),
    ]


def quantile_kpis(measures: DataFrame) -> DataFrame:
    """90th velocity percentile and median altitude of airborne vehicles, unrounded."""
    return grouped_quantiles(
        measures,
        KPI_KEY,
        {
            "p90_velocity_active": (F.col("airborne_velocity"), 0.90),
            "median_geo_altitude_active": (F.col("airborne_altitude"), 0.50),
        },
    )


def pct_grounded() -> Column:
    share = F.lit(100.0) * F.col("on_ground") / F.nullif(F.col("total_flights"), F.lit(0))
    return half_even(share, 2)


def stress_index() -> Column:
    """Weighted 0..100 score of the already rounded rates."""
    raw = (
        F.lit(0.45) * F.col("pct_grounded")
        + F.lit(0.25) * F.col("stale_contact_rate")
        + F.lit(0.20) * F.col("low_velocity_rate")
        + F.lit(0.10) * (F.lit(100.0) - F.col("data_completeness_score"))
    )
    return half_even(clip(raw, 0.0, 100.0), 2)


def gold_kpis(silver: DataFrame) -> DataFrame:
    """Silver rows of any number of windows to one KPI row per (window, country)."""
    measures = with_measures(silver)
    totals = measures.groupBy(*KPI_KEY).agg(*count_kpis(), *mean_kpis(), *rate_kpis())
    quantiles = quantile_kpis(measures)

    def rounded(name: str) -> Column:
        return half_even(F.coalesce(name, F.lit(0.0)), 4)

    kpis = (
        totals.join(quantiles, KPI_KEY, "left")
        .withColumns({n: rounded(n) for n in quantiles.columns if n not in KPI_KEY})
        .withColumn("pct_grounded", pct_grounded())
        .withColumn("operational_stress_index", stress_index())
    )
    return conform(kpis.select(*GOLD_COLUMNS), GOLD_SCHEMA)
