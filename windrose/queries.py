"""Every operator and product as a query over the given tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.functions.numeric import half_even, half_up
from windrose.operators.frames import with_trailing_by_block
from windrose.operators.upsert import upsert_kpis, upsert_overrides
from windrose.plans import gold, overrides, risk, silver, views
from windrose.schemas import (
    CSV,
    GOLD_INPUT_COLUMNS,
    GOLD_SCHEMA,
    INGESTION_FIELD,
    KPI_KEY,
    NUMERIC_STATE_COLUMNS,
    OVERRIDE_INPUT_COLUMNS,
    OVERRIDE_SCHEMA,
    STATE_COLUMNS,
)
from windrose.session import new_path, staged
from windrose.sources.event_feed import (
    assign_window,
    read_raw_incidents,
    read_raw_overrides,
    read_raw_states,
)
from windrose.sources.override_files import read_override_csv, read_override_payload
from windrose.sources.snapshots import (
    explode_states,
    read_snapshots,
    window_key,
    with_ingestion_metadata,
    with_volume_flag,
    write_snapshots,
)
from windrose.sources.tables import (
    read_gold_csv,
    read_kpis,
    read_overrides,
    read_silver_csv,
    write_partitions,
)
from windrose.streaming.incremental import run_state_stream

Query = Callable[[SparkSession, str], DataFrame]

# The replayed loads below arrive in two batches that overlap between these moments.
_SECOND_BATCH_FROM = "2024-01-10 06:00:00"
_FIRST_BATCH_UNTIL = "2024-01-20 06:00:00"
_LOADED_AT = "2024-02-01 00:00:00"
_RELOADED_AT = "2024-02-02 00:00:00"
_AS_OF = "2024-01-15 12:00:00"
_REPLAYED_FROM, _REPLAYED_TO = "2024-01-12 00:00:00", "2024-01-14 00:00:00"
_GONE_COUNTRY = " ASIA"
_ONE_COUNTRY = "ASIA"

_STATES_PER_DOCUMENT = 5000

_ADDED_LATER = ["p90_velocity_active", "low_velocity_rate", "climbing_flights"]


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver(read_raw_states(spark, folder))


def _measures(spark: SparkSession, folder: str) -> DataFrame:
    return gold.with_measures(_silver(spark, folder))


def _kpis_of(raw: DataFrame) -> DataFrame:
    return gold.gold_kpis(silver.silver(raw, columns=GOLD_INPUT_COLUMNS))


def _gold(spark: SparkSession, folder: str) -> DataFrame:
    return _kpis_of(read_raw_states(spark, folder))


def _kpis(spark: SparkSession, folder: str) -> DataFrame:
    """The KPI table as stored rows: the risk model reads it several times."""
    return staged(_gold(spark, folder), "kpis")


def _overrides(spark: SparkSession, folder: str) -> DataFrame:
    """The override table after loading every incident."""
    rows = overrides.checked_overrides(read_raw_incidents(spark, folder))
    empty = spark.createDataFrame([], OVERRIDE_SCHEMA)
    return staged(overrides.merge_overrides(empty, rows, _moment(_LOADED_AT)), "overrides")


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return _score(_kpis(spark, folder))


def _score(kpis: DataFrame) -> DataFrame:
    return risk.with_telemetry_risk(risk.with_z_scores(risk.with_baselines(kpis)))


def _risk(spark: SparkSession, folder: str) -> DataFrame:
    return risk.country_disruption_risk(_kpis(spark, folder), _overrides(spark, folder))


# --- Files ---


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """The raw states as snapshot documents; `pos` is unique, so each holds a bounded number."""
    raw = read_raw_states(spark, folder)
    part = F.floor(F.col("pos") / _STATES_PER_DOCUMENT)
    payloads = raw.groupBy("window_start", part.alias("part")).agg(
        F.collect_list(F.array(*STATE_COLUMNS)).alias("states"),
        F.unix_timestamp(F.max("ts")).alias("time"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
    return with_ingestion_metadata(
        payloads,
        window_start=F.col("window_start"),
        requested_at=F.col("first_ts"),
        received_at=F.col("last_ts"),
        http_status=F.lit(200),
        authenticated=F.col("part") % 2 == 0,
    )


def _landed(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "bronze")
    write_snapshots(_documents(spark, folder), path)
    return read_snapshots(spark, path)


def snapshot_states(spark, folder):
    """Documents written to bronze, read back and exploded."""
    return explode_states(_landed(spark, folder)).select("window_start", *STATE_COLUMNS)


def snapshot_metadata(spark, folder):
    record = F.col(f"{INGESTION_FIELD}.*")
    flagged = with_volume_flag(_landed(spark, folder))
    return flagged.select("time", record, "is_low_volume")


def kpi_csv_round_trip(spark, folder):
    """KPIs of silver that went through CSV files, themselves through CSV files."""
    silver_path, gold_path = new_path(spark, "silver"), new_path(spark, "gold")
    _silver(spark, folder).write.options(**CSV).csv(silver_path)
    kpis = gold.gold_kpis(read_silver_csv(spark, silver_path))
    kpis.write.options(**CSV).csv(gold_path)
    return read_gold_csv(spark, gold_path)


def _as_read(rows: DataFrame) -> DataFrame:
    return overrides.parsed_overrides(rows).select(*OVERRIDE_INPUT_COLUMNS)


def override_csv_scan(spark, folder):
    path = new_path(spark, "overrides-csv")
    raw = read_raw_overrides(spark, folder).select(*OVERRIDE_INPUT_COLUMNS)
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.write.options(**CSV, **keep).csv(path)
    return _as_read(read_override_csv(spark, path))


def override_payload_scan(spark, folder):
    """Rows of JSON payload documents of a bounded number of rows, one document per file."""
    path = new_path(spark, "overrides-json")
    part = F.floor(F.col("ordinal") / _STATES_PER_DOCUMENT)
    rows = F.collect_list(F.struct(*OVERRIDE_INPUT_COLUMNS)).alias("overrides")
    documents = read_raw_overrides(spark, folder).groupBy(part).agg(rows)
    documents.select(F.to_json(F.struct("overrides"))).write.option("maxRecordsPerFile", 1).text(path)
    return _as_read(read_override_payload(spark, path))


# --- Silver ---


def silver_key_normalise(spark, folder):
    return silver.normalise_keys(read_raw_states(spark, folder)).select(
        "pos", "window_start", "icao24", "callsign", "origin_country"
    )


def silver_numeric_coercion(spark, folder):
    return silver.coerce_numbers(read_raw_states(spark, folder)).select(
        "pos", *NUMERIC_STATE_COLUMNS
    )


def silver_boolean_coercion(spark, folder):
    return silver.coerce_flags(read_raw_states(spark, folder)).select("pos", "on_ground")


def silver_latest_per_aircraft(spark, folder):
    states = silver.clean_states(read_raw_states(spark, folder))
    columns = ["window_start", "icao24", "pos", "origin_country", "last_contact", "velocity"]
    return silver.latest_per_vehicle(states.select(*columns))


def silver_ages_and_flags(spark, folder):
    return _silver(spark, folder).select(
        "window_start",
        "icao24",
        "position_age_sec",
        "contact_age_sec",
        "is_stale_contact",
        "is_stale_position",
        "is_low_velocity",
    )


# --- Gold ---


def gold_measures(spark, folder):
    return _measures(spark, folder).select(
        *KPI_KEY,
        "icao24",
        "is_active",
        "airborne_velocity",
        "airborne_altitude",
        "airborne_vertical_speed",
        "is_complete",
    )


def gold_counts(spark, folder):
    return _measures(spark, folder).groupBy(*KPI_KEY).agg(*gold.count_kpis())


def gold_active_means(spark, folder):
    return _measures(spark, folder).groupBy(*KPI_KEY).agg(*gold.mean_kpis())


def gold_percentiles(spark, folder):
    quantiles = gold.quantile_kpis(_measures(spark, folder))
    return quantiles.select(
        *KPI_KEY,
        *[half_even(F.col(c), 4).alias(c) for c in quantiles.columns if c not in KPI_KEY],
    )


def gold_rates(spark, folder):
    return _measures(spark, folder).groupBy(*KPI_KEY).agg(*gold.rate_kpis())


def gold_stress_index(spark, folder):
    return _gold(spark, folder).select(*KPI_KEY, "pct_grounded", "operational_stress_index")


# --- Risk model ---


def baseline_windows(spark, folder):
    framed = risk.with_baselines(_kpis(spark, folder))
    return framed.select(
        *KPI_KEY, *[half_up(F.col(c), 6).alias(c) for c in framed.columns if "baseline" in c]
    )


def _stored_fact(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "fact")
    upsert_kpis(spark, _gold(spark, folder), path)
    return read_kpis(spark, path)


def baselines_by_block(spark, folder):
    """The baselines of a stored fact whose countries are cut into blocks of a few days."""
    framed = with_trailing_by_block(
        _stored_fact(spark, folder), "origin_country", "window_start", "window_date", risk.baseline_frames(), days_per_block=5
    )
    return framed.select(
        *KPI_KEY, *[half_up(F.col(c), 6).alias(c) for c in framed.columns if "baseline" in c]
    )


def stored_fact_risk(spark, folder):
    """The risk view over the stored fact, which is partitioned by day."""
    return risk.country_disruption_risk(_stored_fact(spark, folder), _overrides(spark, folder))


def z_scores(spark, folder):
    return _scored(spark, folder).select(
        *KPI_KEY,
        *[half_up(F.col(c), 6).alias(c) for c in ("grounded_z", "stress_z", "capacity_drop_z")],
    )


def capacity_drop(spark, folder):
    return _scored(spark, folder).select(
        *KPI_KEY, half_up(F.col("capacity_drop_pct"), 6).alias("capacity_drop_pct")
    )


def telemetry_risk(spark, folder):
    return _scored(spark, folder).select(*KPI_KEY, "telemetry_risk_zscore")


def override_interval_join(spark, folder):
    best = risk.best_event_per_window(_kpis(spark, folder), _overrides(spark, folder))
    return best.withColumnsRenamed(
        {"best_severity": "severity_score", "best_start": "event_start", "best_end": "event_end"}
    ).drop("event_id")


def override_best_event(spark, folder):
    kpis = _kpis(spark, folder)
    best = risk.best_event_per_window(kpis, _overrides(spark, folder))
    return risk.blend_events(kpis.select(*KPI_KEY), best).select(
        *KPI_KEY,
        "event_type",
        "event_source",
        "event_notes",
        "event_severity_score",
        "active_event_override",
        "min_disruption_band",
    )


def risk_bands(spark, folder):
    kpis, events = _kpis(spark, folder), _overrides(spark, folder)
    best = risk.best_event_per_window(kpis, events)
    return risk.with_bands(risk.blend_events(_score(kpis), best)).select(
        *KPI_KEY,
        "telemetry_risk_zscore",
        half_up(F.col("disruption_risk_zscore"), 6).alias("disruption_risk_zscore"),
        "computed_band",
        "min_disruption_band",
        "disruption_band",
    )


def moving_average_6(spark, folder):
    return risk.with_moving_averages(_kpis(spark, folder)).select(
        *KPI_KEY, *[half_up(F.col(c), 6).alias(c) for c in ("stress_ma_6", "flights_ma_6")]
    )


def latest_window(spark, folder):
    kpis = _kpis(spark, folder)
    return risk.at_latest_window(kpis, kpis).select(*KPI_KEY, "total_flights")


def _last_three(spark, folder):
    newest = risk.newest_risk(_kpis(spark, folder), _overrides(spark, folder), rows=3)
    return views.last_three_windows(newest)


def last_three_pivot(spark, folder):
    return _last_three(spark, folder)


def trend_signal(spark, folder):
    return _last_three(spark, folder).select(
        "origin_country",
        half_up(views.one_window_change(), 4).alias("one_window_change"),
        half_up(views.two_window_change(), 4).alias("two_window_change"),
        views.trend_signal().alias("trend_signal"),
    )


def recommended_action(spark, folder):
    return _risk(spark, folder).select(
        *KPI_KEY,
        "active_event_override",
        "disruption_band",
        views.recommended_action().alias("recommended_action"),
    )


def impact_top20(spark, folder):
    """Flights at risk at the latest window, without the least number of flights."""
    latest = risk.latest_risk(_kpis(spark, folder), _overrides(spark, folder))
    return (
        latest.select(
            *KPI_KEY, "total_flights", half_up(views.impact_score(), 2).alias("impact_score")
        )
        .orderBy(*views.most_impact_first())
        .limit(views.TOP_CANDIDATES)
    )


def window_assign_30m(spark, folder):
    raw = read_raw_states(spark, folder)
    return raw.select("pos", assign_window(F.col("ts")).alias("window_start"))


def low_volume_windows(spark, folder):
    raw = read_raw_states(spark, folder)
    counts = raw.groupBy("window_start").agg(F.count("*").alias("state_count"))
    return with_volume_flag(counts, F.col("state_count"))


# --- Override load ---


def _parsed(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    parsed = overrides.parsed_overrides(read_raw_overrides(spark, folder))
    return parsed.select("ordinal", *columns)


def override_text_defaults(spark, folder):
    return _parsed(
        spark, folder, "region_type", "region_value", "event_type", "source", "notes"
    )


def override_severity_clamp(spark, folder):
    return _parsed(spark, folder, "severity_score")


def override_band_enum(spark, folder):
    return _parsed(spark, folder, "min_disruption_band")


def override_boolean_parse(spark, folder):
    return _parsed(spark, folder, "is_active")


def override_timestamps(spark, folder):
    rows = overrides.loadable(overrides.parsed_overrides(read_raw_incidents(spark, folder)))
    return rows.select("ordinal", "event_start_utc", "event_end_utc")


def override_range_violations(spark, folder):
    """Rows whose range would fail a load if start and end were swapped on input."""
    start, end = F.col("event_start_utc"), F.col("event_end_utc")
    swapped = read_raw_overrides(spark, folder).withColumns(
        {"event_start_utc": end, "event_end_utc": start}
    )
    return (
        overrides.parsed_overrides(swapped)
        .filter(overrides.range_violation())
        .select("ordinal", "event_start_utc", "event_end_utc")
    )


def override_upsert(spark, folder):
    """Two overlapping batches merged one after the other."""
    rows = overrides.checked_overrides(read_raw_overrides(spark, folder))
    moments = read_raw_states(spark, folder).select(F.col("pos").alias("ordinal"), "ts")
    timed = rows.join(moments, "ordinal")
    batches = [
        (timed.filter(F.col("ts") < _FIRST_BATCH_UNTIL), _LOADED_AT),
        (timed.filter(F.col("ts") >= _SECOND_BATCH_FROM), _RELOADED_AT),
    ]
    path = new_path(spark, "events")
    for batch, moment in batches:
        upsert_overrides(spark, batch.select("ordinal", *OVERRIDE_INPUT_COLUMNS), path, _moment(moment))
    return read_overrides(spark, path)


# --- KPI table maintenance ---


def _batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    raw = read_raw_states(spark, folder)
    first = raw.filter(F.col("ts") < _FIRST_BATCH_UNTIL)
    second = raw.filter(F.col("ts") >= _SECOND_BATCH_FROM)
    return _kpis_of(first), _kpis_of(second)


def kpi_upsert(spark, folder):
    """Two overlapping loads; the second replaces the rows it produces again."""
    path = new_path(spark, "fact")
    for batch in _batches(spark, folder):
        upsert_kpis(spark, batch, path)
    return read_kpis(spark, path).select(*GOLD_SCHEMA.fieldNames())


def kpi_earlier_version(spark, folder):
    """The fact as a reader that was made between two overlapping loads still shows it after both."""
    path = new_path(spark, "fact")
    first, second = _batches(spark, folder)
    upsert_kpis(spark, first, path)
    held = read_kpis(spark, path)
    upsert_kpis(spark, second, path)
    return held.select(*GOLD_SCHEMA.fieldNames())


def kpi_schema_evolution(spark, folder):
    """An older table without three of the columns takes a load that has them."""
    path = new_path(spark, "fact")
    first, second = _batches(spark, folder)
    older = first.drop(*_ADDED_LATER).withColumn("window_date", F.to_date("window_start"))
    write_partitions(older, path, "window_date")
    upsert_kpis(spark, second, path)
    return read_kpis(spark, path).select(*GOLD_SCHEMA.fieldNames())


def _land_states(raw: DataFrame, landed: str) -> None:
    keyed = raw.withColumn("window_key", window_key(F.col("window_start")))
    write_partitions(keyed, landed, "window_key")


def _stream_of(spark: SparkSession, landed: str, schema) -> tuple[Callable[[], None], str]:
    """A function that processes what has landed since its last call, and the fact it keeps."""
    places = {
        "silver_path": new_path(spark, "silver"),
        "fact_path": new_path(spark, "fact"),
        "checkpoint": new_path(spark, "progress"),
    }
    run = lambda: run_state_stream(spark, landed, schema, files_per_batch=24, **places)
    return run, places["fact_path"]


def kpi_incremental(spark, folder):
    """All state rows land as files and flow through the streaming job, some windows per batch."""
    landed = new_path(spark, "landed")
    raw = read_raw_states(spark, folder).drop("ts")
    _land_states(raw, landed)
    run, fact = _stream_of(spark, landed, raw.schema)
    run()
    return read_kpis(spark, fact).select(*GOLD_SCHEMA.fieldNames())


def kpi_replay(spark, folder):
    """Windows of some days land again without one country, whose old rows stay."""
    landed = new_path(spark, "landed")
    raw = read_raw_states(spark, folder).drop("ts")
    _land_states(raw, landed)
    run, fact = _stream_of(spark, landed, raw.schema)
    run()
    days = F.col("window_start").between(_moment(_REPLAYED_FROM), _moment(_REPLAYED_TO))
    gone = F.coalesce(F.col("origin_country") == _GONE_COUNTRY, F.lit(False))
    _land_states(raw.filter(days & ~gone), landed)
    run()
    return read_kpis(spark, fact).select(*GOLD_SCHEMA.fieldNames())


def views_after_upsert(spark, folder):
    """The views are registered over a first load and asked after a second one."""
    fact, events = new_path(spark, "fact"), new_path(spark, "events")
    rows = overrides.checked_overrides(read_raw_incidents(spark, folder))
    for batch in _batches(spark, folder):
        upsert_kpis(spark, batch, fact)
        upsert_overrides(spark, rows, events, _moment(_LOADED_AT))
        views.refresh_views(spark, fact, events, _moment(_AS_OF))
    return spark.sql(
        "SELECT m.*, count(r.origin_country) AS risk_rows,"
        " count_if(r.active_event_override) AS rows_with_event,"
        " (SELECT count(*) FROM v_active_event_overrides) AS events_in_force"
        " FROM v_decision_confidence_monitor m JOIN v_country_disruption_risk r USING (window_start)"
        " GROUP BY ALL"
    )


# --- Products ---


def _product(view: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: view(_kpis(spark, folder), _overrides(spark, folder))


def _ordered(
    product: Query,
    order: Callable[[], list[Column]],
    *columns: str,
    within: tuple[str, ...] = (),
    blocks: Callable[[], dict[str, Column]] | None = None,
) -> Query:
    """A product's key columns with the place of each row in the report's order."""

    def query(spark, folder):
        rows = product(spark, folder)
        if blocks:
            rows = views.numbered_by_block(rows, order(), blocks(), *within)
        else:
            rows = views.numbered(rows, order(), *within)
        return rows.select(*columns, "position")

    return query


def _by_day() -> dict[str, Column]:
    return {"day": F.to_date("window_start")}


def _by_severity() -> dict[str, Column]:
    return {"severity": F.col("severity_score"), "day": F.to_date("event_start_utc")}


def country_trend_of_one(spark, folder):
    return views.country_trend(_kpis(spark, folder), _overrides(spark, folder), _ONE_COUNTRY)


def confidence_monitor(spark, folder):
    return views.confidence_monitor(_gold(spark, folder))


def active_overrides(spark, folder):
    return views.active_overrides(_overrides(spark, folder), _moment(_AS_OF))


def switched_on_overrides(spark, folder):
    return views.switched_on(_overrides(spark, folder)).drop("created_at", "updated_at")


QUERIES: dict[str, Query] = {
    "snapshot_states": snapshot_states,
    "snapshot_metadata": snapshot_metadata,
    "kpi_csv_round_trip": kpi_csv_round_trip,
    "override_csv_scan": override_csv_scan,
    "override_payload_scan": override_payload_scan,
    "silver_key_normalise": silver_key_normalise,
    "silver_numeric_coercion": silver_numeric_coercion,
    "silver_boolean_coercion": silver_boolean_coercion,
    "silver_latest_per_aircraft": silver_latest_per_aircraft,
    "silver_ages_and_flags": silver_ages_and_flags,
    "silver_projection": _silver,
    "gold_measures": gold_measures,
    "gold_counts": gold_counts,
    "gold_active_means": gold_active_means,
    "gold_percentiles": gold_percentiles,
    "gold_rates": gold_rates,
    "gold_stress_index": gold_stress_index,
    "gold_kpis": _gold,
    "baseline_windows": baseline_windows,
    "baselines_by_block": baselines_by_block,
    "stored_fact_risk": stored_fact_risk,
    "z_scores": z_scores,
    "capacity_drop": capacity_drop,
    "telemetry_risk": telemetry_risk,
    "override_interval_join": override_interval_join,
    "override_best_event": override_best_event,
    "risk_bands": risk_bands,
    "moving_average_6": moving_average_6,
    "latest_window": latest_window,
    "last_three_pivot": last_three_pivot,
    "trend_signal": trend_signal,
    "recommended_action": recommended_action,
    "impact_top20": impact_top20,
    "window_assign_30m": window_assign_30m,
    "low_volume_windows": low_volume_windows,
    "override_text_defaults": override_text_defaults,
    "override_severity_clamp": override_severity_clamp,
    "override_band_enum": override_band_enum,
    "override_boolean_parse": override_boolean_parse,
    "override_timestamps": override_timestamps,
    "override_range_violations": override_range_violations,
    "override_upsert": override_upsert,
    "kpi_upsert": kpi_upsert,
    "kpi_earlier_version": kpi_earlier_version,
    "kpi_schema_evolution": kpi_schema_evolution,
    "kpi_incremental": kpi_incremental,
    "kpi_replay": kpi_replay,
    "views_after_upsert": views_after_upsert,
    "country_disruption_risk": _risk,
    "global_risk_board_latest": _product(views.global_risk_board),
    "country_trend": _product(views.country_trend),
    "worsening_risk": _product(views.worsening_risk),
    "capacity_candidates": _product(views.capacity_candidates),
    "confidence_monitor": confidence_monitor,
    "active_overrides": active_overrides,
    "switched_on_overrides": switched_on_overrides,
    "country_trend_of_one": country_trend_of_one,
    "history_order": _ordered(
        _risk, views.newest_first, *KPI_KEY, within=("origin_country",), blocks=_by_day
    ),
    "board_order": _ordered(_product(views.global_risk_board), views.gravest_first, *KPI_KEY),
    "trend_order": _ordered(
        _product(views.country_trend), views.newest_first, *KPI_KEY, within=("origin_country",), blocks=_by_day
    ),
    "worsening_order": _ordered(
        _product(views.worsening_risk), views.worst_first, "latest_window", "origin_country"
    ),
    "capacity_order": _ordered(
        _product(views.capacity_candidates), views.most_impact_first, "origin_country", "impact_score"
    ),
    "monitor_order": _ordered(confidence_monitor, views.newest_first, "window_start", blocks=_by_day),
    "overrides_order": _ordered(
        active_overrides, views.most_severe_first,
        "region_value", "event_type", "severity_score", "event_start_utc", "event_end_utc",
        blocks=_by_severity,
    ),
}
