"""The analyst products on top of the KPI fact, the risk model and the override table.

Each product is an unordered `*_view`, for SQL and further work, and a report in its usual order.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrose.functions.numeric import exact_mean, half_up
from windrose.plans.risk import (
    country_disruption_risk,
    latest_risk,
    newest_risk,
    risk_with_moving_averages,
)
from windrose.sources.tables import read_kpis, read_overrides

# Thresholds and texts of the products.
MIN_TREND_FLIGHTS = 20
MIN_CAPACITY_FLIGHTS = 30
TOP_CANDIDATES = 20
LOW_COMPLETENESS_PCT = 90
HIGH_STALE_PCT = 25
ACTION_EVENT = "External disruption event active: execute contingency playbook"
ACTION_BY_BAND = {
    "critical": "Immediate escalation to network control center",
    "high": "Pre-position operations and customer comms resources",
    "watch": "Monitor next 1-2 windows and prepare fallback plans",
}
ACTION_NONE = "Normal operations"
SIGNAL_URGENT = "urgent trend deterioration"
SIGNAL_ELEVATED = "elevated deterioration"
SIGNAL_STABLE = "stable_or_improving"


def _rounded(column: str, digits: int, name: str | None = None) -> Column:
    return half_up(F.col(column), digits).alias(name or column)


def recommended_action() -> Column:
    action = F.when(F.col("active_event_override"), ACTION_EVENT)
    for band, text in ACTION_BY_BAND.items():
        action = action.when(F.col("disruption_band") == band, text)
    return action.otherwise(ACTION_NONE)


def newest_first() -> list[Column]:
    return [F.desc("window_start")]


def gravest_first() -> list[Column]:
    return [F.desc("disruption_risk_zscore"), F.desc("total_flights")]


def worst_first() -> list[Column]:
    """Highest risk first; unknown changes sort before known ones."""
    return [F.desc("risk_z_now"), F.desc_nulls_first("stress_delta_1_window")]


def most_impact_first() -> list[Column]:
    return [F.desc("impact_score"), F.asc("origin_country")]


def most_severe_first() -> list[Column]:
    return [F.desc("severity_score"), F.desc("event_start_utc")]


def numbered(rows: DataFrame, order: list[Column], *within: str) -> DataFrame:
    """Adds the place of each row in a report's order, equal for ties, of all rows or in a group."""
    return rows.withColumn("position", F.rank().over(Window.partitionBy(*within).orderBy(*order)))


def numbered_by_block(
    rows: DataFrame, order: list[Column], blocks: dict[str, Column], *within: str, descending: bool = True
) -> DataFrame:
    """`numbered` for reports that grow with the history: no task ranks all rows, or a whole group.

    `blocks` are coarse values, by name, that the order never goes against (days of a time, say); all
    fall or all rise along it, nulls last or first as usual. Rows are counted per block, the counts summed
    up along the order, one row for each block, and a row's place is its place in its block after
    the rows of the blocks before. Ties share a block, hence a place.
    """
    falling = [f"_block_{name}" for name in blocks]
    dealt = rows.select("*", *[value.alias(n) for n, value in zip(falling, blocks.values(), strict=True)])
    key = [*within, *falling]
    along = Window.partitionBy(*within).orderBy(*[F.desc(n) if descending else F.asc(n) for n in falling])
    earlier = F.sum("_rows").over(along.rowsBetween(Window.unboundedPreceding, -1))
    counts = dealt.groupBy(*key).agg(F.count("*").alias("_rows"))
    offsets = counts.select(
        *[F.col(n).alias(f"_of_{n}") for n in key], F.coalesce(earlier, F.lit(0)).alias("_earlier")
    )
    # Without within the sums are one partition, which the join must not gather the rows into.
    offsets = offsets.repartition(*[F.col(f"_of_{n}") for n in key])
    same = F.lit(True)
    for n in key:
        same &= F.col(n).eqNullSafe(F.col(f"_of_{n}"))
    place = F.rank().over(Window.partitionBy(*key).orderBy(*order))
    return (
        dealt.withColumn("_place", place)
        .join(offsets, same)
        .withColumn("position", (F.col("_earlier") + F.col("_place")).cast("int"))
        .select(*rows.columns, "position")
    )


def risk_history(kpis: DataFrame, overrides: DataFrame) -> DataFrame:
    """All risk rows, newest window first."""
    return country_disruption_risk(kpis, overrides).orderBy(*newest_first())


def global_risk_board_view(kpis: DataFrame, overrides: DataFrame) -> DataFrame:
    """All countries at the latest window."""
    return latest_risk(kpis, overrides).select(
        "window_start",
        "origin_country",
        "total_flights",
        _rounded("pct_grounded", 2),
        _rounded("capacity_drop_pct", 2),
        _rounded("avg_velocity_active", 2, "avg_velocity_active_ms"),
        _rounded("stale_contact_rate", 2, "stale_contact_rate_pct"),
        _rounded("low_velocity_rate", 2, "low_velocity_rate_pct"),
        _rounded("data_completeness_score", 2),
        _rounded("operational_stress_index", 2),
        _rounded("telemetry_risk_zscore", 3),
        _rounded("disruption_risk_zscore", 3),
        _rounded("event_severity_score", 2),
        "active_event_override",
        "event_type",
        "event_source",
        "disruption_band",
        recommended_action().alias("recommended_action"),
    )


def global_risk_board(kpis: DataFrame, overrides: DataFrame) -> DataFrame:
    """The board, gravest first."""
    return global_risk_board_view(kpis, overrides).orderBy(*gravest_first())


def country_trend_view(kpis: DataFrame, overrides: DataFrame) -> DataFrame:
    """History of every country with six-row averages."""
    return risk_with_moving_averages(kpis, overrides).select(
        "window_start",
        "origin_country",
        "total_flights",
        _rounded("flights_ma_6", 2),
        _rounded("pct_grounded", 2),
        _rounded("capacity_drop_pct", 2),
        _rounded("avg_velocity_active", 2, "avg_velocity_active_ms"),
        _rounded("stale_contact_rate", 2, "stale_contact_rate_pct"),
        _rounded("data_completeness_score", 2),
        _rounded("operational_stress_index", 2),
        _rounded("stress_ma_6", 2),
        _rounded("telemetry_risk_zscore", 3),
        _rounded("disruption_risk_zscore", 3),
        _rounded("event_severity_score", 2),
        "active_event_override",
        "event_type",
        "event_source",
    )


def country_trend(
    kpis: DataFrame, overrides: DataFrame, country: str | None = None
) -> DataFrame:
    """The history of one country or all, newest first."""
    if country is not None:
        kpis = kpis.filter(F.col("origin_country") == country)
    return country_trend_view(kpis, overrides).orderBy(*newest_first())


def last_three_windows(newest: DataFrame) -> DataFrame:
    """One row per country from rows ranked `rn` 1..3 by recency."""

    def at(rank: int, column: str) -> Column:
        return F.max(F.when(F.col("rn") == rank, F.col(column)))

    stress = "operational_stress_index"
    return newest.groupBy("origin_country").agg(
        at(1, "window_start").alias("latest_window"),
        at(1, "total_flights").alias("latest_total_flights"),
        at(1, stress).alias("stress_t0"),
        at(2, stress).alias("stress_t1"),
        at(3, stress).alias("stress_t2"),
        at(1, "disruption_risk_zscore").alias("risk_z_t0"),
    )


def one_window_change() -> Column:
    return F.col("stress_t0") - F.col("stress_t1")


def two_window_change() -> Column:
    return F.col("stress_t0") - F.coalesce("stress_t2", "stress_t1")


def trend_signal() -> Column:
    z, change = F.col("risk_z_t0"), one_window_change()
    return (
        F.when((z >= 1.5) & (change >= 5), SIGNAL_URGENT)
        .when((z >= 1.0) & (change >= 2), SIGNAL_ELEVATED)
        .otherwise(SIGNAL_STABLE)
    )


def worsening_risk_view(
    kpis: DataFrame, overrides: DataFrame, min_flights: int = MIN_TREND_FLIGHTS
) -> DataFrame:
    """Stress change over each country's last windows."""
    return (
        last_three_windows(newest_risk(kpis, overrides, rows=3))
        .filter(F.col("latest_total_flights") >= min_flights)
        .select(
            "latest_window",
            "origin_country",
            "latest_total_flights",
            _rounded("stress_t0", 2, "stress_now"),
            _rounded("stress_t1", 2, "stress_prev"),
            _rounded("stress_t2", 2, "stress_prev2"),
            half_up(one_window_change(), 2).alias("stress_delta_1_window"),
            half_up(two_window_change(), 2).alias("stress_delta_2_windows"),
            _rounded("risk_z_t0", 3, "risk_z_now"),
            trend_signal().alias("trend_signal"),
        )
    )


def worsening_risk(
    kpis: DataFrame, overrides: DataFrame, min_flights: int = MIN_TREND_FLIGHTS
) -> DataFrame:
    """The changes, highest risk first."""
    return worsening_risk_view(kpis, overrides, min_flights).orderBy(*worst_first())


def impact_score() -> Column:
    return F.col("total_flights") * F.greatest(F.col("disruption_risk_zscore"), F.lit(0.0))


def capacity_candidates_view(
    kpis: DataFrame, overrides: DataFrame, min_flights: int = MIN_CAPACITY_FLIGHTS
) -> DataFrame:
    """Busy countries at the latest window with their flights at risk."""
    return (
        latest_risk(kpis, overrides)
        .filter(F.col("total_flights") >= min_flights)
        .select(
            "origin_country",
            "total_flights",
            _rounded("capacity_drop_pct", 2),
            _rounded("telemetry_risk_zscore", 3),
            _rounded("disruption_risk_zscore", 3),
            _rounded("event_severity_score", 2),
            "active_event_override",
            "event_type",
            "event_source",
            _rounded("operational_stress_index", 2),
            _rounded("pct_grounded", 2),
            half_up(impact_score(), 2).alias("impact_score"),
        )
    )


def capacity_candidates(
    kpis: DataFrame,
    overrides: DataFrame,
    min_flights: int = MIN_CAPACITY_FLIGHTS,
    top: int = TOP_CANDIDATES,
) -> DataFrame:
    """The `top` countries by flights at risk; the name settles ties."""
    return (
        capacity_candidates_view(kpis, overrides, min_flights)
        .orderBy(*most_impact_first())
        .limit(top)
    )


def confidence_monitor_view(kpis: DataFrame) -> DataFrame:
    """Data quality per window."""
    return (
        kpis.groupBy("window_start")
        .agg(
            half_up(exact_mean(F.col("data_completeness_score")), 2).alias(
                "avg_data_completeness_score"
            ),
            half_up(exact_mean(F.col("stale_contact_rate")), 2).alias("avg_stale_contact_rate_pct"),
            F.count_if(F.col("data_completeness_score") < LOW_COMPLETENESS_PCT).alias(
                "countries_below_quality_threshold"
            ),
            F.count_if(F.col("stale_contact_rate") > HIGH_STALE_PCT).alias(
                "countries_with_stale_signal"
            ),
            F.count("*").alias("total_countries_observed"),
        )
    )


def confidence_monitor(kpis: DataFrame) -> DataFrame:
    """The monitor, newest window first."""
    return confidence_monitor_view(kpis).orderBy(*newest_first())


def active_overrides_view(overrides: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Overrides in force at `as_of` (default: now)."""
    moment = F.current_timestamp() if as_of is None else as_of
    return (
        overrides.filter(
            F.col("is_active") & moment.between(F.col("event_start_utc"), F.col("event_end_utc"))
        )
        .select(
            "region_type",
            "region_value",
            "event_type",
            "source",
            "notes",
            "severity_score",
            "min_disruption_band",
            "event_start_utc",
            "event_end_utc",
            "is_active",
            "updated_at",
        )
    )


def active_overrides(overrides: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Overrides in force, gravest first."""
    return active_overrides_view(overrides, as_of).orderBy(*most_severe_first())


def switched_on(overrides: DataFrame) -> DataFrame:
    """All overrides whose flag is set, whatever their dates."""
    return overrides.filter("is_active")


def register_views(
    spark: SparkSession, kpis: DataFrame, overrides: DataFrame, as_of: Column | None = None
) -> list[str]:
    """Make the two tables and the seven products available to SQL; returns their names.

    The views show the tables as they are now. After a load, `refresh_views` shows the new state.
    """
    products = {
        "flight_kpis": kpis,
        "regional_event_overrides": overrides,
        "v_country_disruption_risk": country_disruption_risk(kpis, overrides),
        "v_exec_global_risk_board_latest": global_risk_board_view(kpis, overrides),
        "v_country_deep_dive_trend": country_trend_view(kpis, overrides),
        "v_worsening_risk_detection": worsening_risk_view(kpis, overrides),
        "v_capacity_allocation_candidates_latest": capacity_candidates_view(kpis, overrides),
        "v_decision_confidence_monitor": confidence_monitor_view(kpis),
        "v_active_event_overrides": active_overrides_view(overrides, as_of),
    }
    for name, view in products.items():
        view.createOrReplaceTempView(name)
    return list(products)


def refresh_views(
    spark: SparkSession, fact_path: str, overrides_path: str, as_of: Column | None = None
) -> list[str]:
    """Registers all views anew over the stored tables; call it after every load.

    A view, like any DataFrame, holds the file listing of its tables, and a load replaces files.
    """
    return register_views(spark, read_kpis(spark, fact_path), read_overrides(spark, overrides_path), as_of)
