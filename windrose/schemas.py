"""The data model: column lists, table types and the fixed values of the domain."""

from pyspark.sql import types as T

# --- Fixed values: feed, file and table formats that existing data already uses. ---

STATE_COLUMNS = [
    "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude",
    "latitude", "baro_altitude", "on_ground", "velocity", "true_track", "vertical_rate",
    "sensors", "geo_altitude", "squawk", "spi", "position_source",
]
STATE_COLUMNS_WIDE = [*STATE_COLUMNS, "category"]

NUMERIC_STATE_COLUMNS = [
    "time_position", "last_contact", "longitude", "latitude", "baro_altitude",
    "geo_altitude", "velocity", "true_track", "vertical_rate",
]

SILVER_COLUMNS = [
    "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude",
    "latitude", "baro_altitude", "geo_altitude", "on_ground", "velocity", "true_track",
    "vertical_rate", "squawk", "position_source", "window_start", "position_age_sec",
    "contact_age_sec", "is_stale_contact", "is_stale_position", "is_low_velocity",
]

GOLD_INPUT_COLUMNS = [
    "window_start", "origin_country", "icao24", "on_ground", "velocity", "vertical_rate",
    "geo_altitude", "last_contact", "is_stale_contact", "is_low_velocity",
]

GOLD_COLUMNS = [
    "window_start", "origin_country", "total_flights", "active_flights", "on_ground",
    "pct_grounded", "avg_velocity_active", "p90_velocity_active",
    "median_geo_altitude_active", "avg_abs_vertical_rate_active", "stale_contact_rate",
    "low_velocity_rate", "climbing_flights", "descending_flights",
    "data_completeness_score", "operational_stress_index",
]

OVERRIDE_INPUT_COLUMNS = [
    "region_type", "region_value", "event_type", "source", "notes", "severity_score",
    "min_disruption_band", "event_start_utc", "event_end_utc", "is_active",
]

#: CSV files: quotes inside cells are doubled, a backslash is a plain character.
CSV = {"header": "true", "quote": '"', "escape": '"'}

INGESTION_FIELD = "_pipeline_ingestion"
WINDOW_KEY_FORMAT = "yyyyMMdd_HHmmss"

# --- Fixed values: thresholds and weights of the quality and stress measures. ---

STALE_AFTER_SEC = 120
LOW_VELOCITY_MS = 70.0
CLIMB_RATE = 2.0
DESCENT_RATE = -2.0
LOW_VOLUME_STATES = 100

BANDS = ["normal", "watch", "high", "critical"]

# --- Table types. ---

KPI_KEY = ["window_start", "origin_country"]

SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("time", T.LongType()),
        T.StructField("states", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField(
            INGESTION_FIELD,
            T.StructType(
                [
                    T.StructField("window_start_utc", T.TimestampType()),
                    T.StructField("state_count", T.LongType()),
                    T.StructField("requested_at_utc", T.TimestampType()),
                    T.StructField("received_at_utc", T.TimestampType()),
                    T.StructField("response_time_ms", T.LongType()),
                    T.StructField("http_status", T.IntegerType()),
                    T.StructField("auth_mode", T.StringType()),
                ]
            ),
        ),
    ]
)

_SILVER_TYPES = {
    **{c: T.DoubleType() for c in NUMERIC_STATE_COLUMNS},
    "position_source": T.IntegerType(),
    "window_start": T.TimestampType(),
    "on_ground": T.BooleanType(),
    "position_age_sec": T.DoubleType(),
    "contact_age_sec": T.DoubleType(),
    "is_stale_contact": T.BooleanType(),
    "is_stale_position": T.BooleanType(),
    "is_low_velocity": T.BooleanType(),
}
SILVER_SCHEMA = T.StructType(
    [T.StructField(c, _SILVER_TYPES.get(c, T.StringType())) for c in SILVER_COLUMNS]
)

_COUNT_COLUMNS = {
    "total_flights", "active_flights", "on_ground", "climbing_flights", "descending_flights",
}
_REQUIRED = {*KPI_KEY, "total_flights", "active_flights", "on_ground"}


def _kpi_type(name: str) -> T.DataType:
    if name == "window_start":
        return T.TimestampType()
    if name == "origin_country":
        return T.StringType()
    return T.IntegerType() if name in _COUNT_COLUMNS else T.DoubleType()


GOLD_SCHEMA = T.StructType(
    [T.StructField(c, _kpi_type(c), nullable=c not in _REQUIRED) for c in GOLD_COLUMNS]
)
KPI_SCHEMA = T.StructType([*GOLD_SCHEMA.fields, T.StructField("load_time", T.TimestampType())])

_OVERRIDE_TYPES = {
    "severity_score": T.DoubleType(),
    "event_start_utc": T.TimestampType(),
    "event_end_utc": T.TimestampType(),
    "is_active": T.BooleanType(),
}
OVERRIDE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        *[
            T.StructField(
                c,
                _OVERRIDE_TYPES.get(c, T.StringType()),
                nullable=c in {"source", "notes", "min_disruption_band", "is_active"},
            )
            for c in OVERRIDE_INPUT_COLUMNS
        ],
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
