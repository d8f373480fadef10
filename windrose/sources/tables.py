"""Silver, gold, KPI fact and override tables as parquet (or CSV files) with declared types."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrose.functions.text import csv_flag, csv_null
from windrose.operators.checks import require_columns
from windrose.schemas import (
    CSV,
    GOLD_COLUMNS,
    GOLD_INPUT_COLUMNS,
    GOLD_SCHEMA,
    KPI_SCHEMA,
    OVERRIDE_SCHEMA,
    SILVER_SCHEMA,
)
from windrose.session import path_exists, prepare
from windrose.sources.snapshots import window_key
from windrose.sources.versions import NoSuchTable, Version, current_version, read_version

_FLAGS = ["on_ground", "is_stale_contact", "is_low_velocity"]


def write_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace exactly the partitions present in `df`.

    Rebalancing gathers a partition's rows into few files and splits a partition that is far
    larger than the rest, instead of every task writing a sliver of every partition.
    """
    (
        df.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def _read_partitions(spark: SparkSession, path: str, schema: T.StructType, column: str, kind):
    with_partition = T.StructType([*schema.fields, T.StructField(column, kind)])
    return prepare(spark).read.schema(with_partition).parquet(path)


def existing_folders(spark: SparkSession, path: str, column: str, values: list) -> list[str]:
    """Folders of the given partition values that are there; no other folder is looked at."""
    names = ("__HIVE_DEFAULT_PARTITION__" if v is None else v for v in values)
    folders = (f"{path}/{column}={name}" for name in names)
    return [f for f in folders if path_exists(spark, f)]


def write_silver(silver: DataFrame, path: str) -> None:
    """One partition per window; writing a window again replaces it."""
    write_partitions(silver.withColumn("window_key", window_key(F.col("window_start"))), path, "window_key")


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return _read_partitions(spark, path, SILVER_SCHEMA, "window_key", T.StringType())


def read_silver_windows(spark: SparkSession, path: str, keys: list) -> DataFrame:
    """Silver of some windows by their `window_key`, whatever else the table holds."""
    schema = T.StructType([*SILVER_SCHEMA.fields, T.StructField("window_key", T.StringType())])
    folders = existing_folders(spark, path, "window_key", keys)
    if not folders:
        return spark.createDataFrame([], schema)
    return prepare(spark).read.schema(schema).option("basePath", path).parquet(*folders)


def read_silver_csv(spark: SparkSession, path: str) -> DataFrame:
    """Silver from CSV files: missing-value tokens become null, flags are read from text."""
    raw = prepare(spark).read.options(**CSV).csv(path)
    require_columns(raw, GOLD_INPUT_COLUMNS, "Silver file")
    known = {f.name: f.dataType for f in SILVER_SCHEMA.fields}
    return raw.select(
        *[
            (
                csv_flag(F.col(c))
                if c in _FLAGS or known.get(c) == T.BooleanType()
                else csv_null(F.col(c)).cast(known.get(c, T.StringType()))
            ).alias(c)
            for c in raw.columns
        ]
    )


def write_gold(gold: DataFrame, path: str) -> None:
    write_partitions(
        conform(gold, GOLD_SCHEMA).withColumn("window_key", window_key(F.col("window_start"))),
        path,
        "window_key",
    )


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return _read_partitions(spark, path, GOLD_SCHEMA, "window_key", T.StringType()).drop("window_key")


def read_gold_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = prepare(spark).read.options(**CSV).csv(path)
    require_columns(raw, GOLD_COLUMNS, "Gold file")
    return conform(raw.select(*[csv_null(F.col(c)).alias(c) for c in raw.columns]), GOLD_SCHEMA)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the table's types and order; NaN is stored as null, absent columns as null."""

    def column(field: T.StructField):
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(field.name)
        if field.dataType == T.IntegerType() and df.schema[field.name].dataType == T.StringType():
            value = value.cast("double")  # "12.0" is a valid count in CSV text
        value = value.cast(field.dataType)
        if field.dataType == T.DoubleType():
            value = F.when(~F.isnan(value), value)
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


_DAY = T.StructField("window_date", T.DateType())
_MONTH = T.StructField("start_month", T.StringType())


def _version(spark: SparkSession, path: str, column: str, number: int | None) -> Version:
    version = current_version(spark, path, column, number)
    if not (version.number or version.folders):
        raise NoSuchTable(f"There is no table at {path}")
    return version


def read_kpis(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The KPI fact with its declared columns; columns that older files lack read as null.

    The newest version, or the one asked for. The DataFrame keeps showing it after later loads.
    """
    return kpis_of(spark, path, _version(spark, path, _DAY.name, version))


def kpis_of(spark: SparkSession, path: str, version: Version, days: list[str] | None = None) -> DataFrame:
    return read_version(spark, path, KPI_SCHEMA, _DAY, version, days)


def with_start_month(overrides: DataFrame) -> DataFrame:
    return overrides.withColumn("start_month", F.date_format("event_start_utc", "yyyy-MM"))


def overrides_of(spark: SparkSession, path: str, version: Version, months: list[str] | None = None) -> DataFrame:
    return read_version(spark, path, OVERRIDE_SCHEMA, _MONTH, version, months).drop(_MONTH.name)


def read_overrides(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The override table, its newest version or the one asked for."""
    return overrides_of(spark, path, _version(spark, path, _MONTH.name, version))
