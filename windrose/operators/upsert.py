"""Keyed upserts into the KPI fact and the override table."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.operators.checks import require_columns, require_keyed
from windrose.plans.overrides import merge_overrides
from windrose.schemas import GOLD_COLUMNS, GOLD_SCHEMA, KPI_KEY
from windrose.session import staging
from windrose.sources.tables import conform, kpis_of, overrides_of, with_start_month
from windrose.sources.versions import Version, commit, partitions_in

_REQUIRED_KPIS = [f.name for f in GOLD_SCHEMA.fields if not f.nullable]


def _dated(kpis: DataFrame) -> DataFrame:
    return kpis.withColumn("window_date", F.to_date("window_start"))


def merge_kpis(target: DataFrame, rows: DataFrame) -> DataFrame:
    """`target`, the days that `rows` touches, with `rows` replacing equal keys."""
    kept = target.join(rows.select(*KPI_KEY), KPI_KEY, "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def upsert_kpis(
    spark: SparkSession, gold: DataFrame, path: str, load_time: Column | None = None
) -> None:
    """Insert or replace KPI rows by (window, country); other rows of the fact stay.

    Only the days present in `gold` are read and written anew, to a folder of the load's own; then one
    version shows all of them at once (see `sources/versions.py`). Rows that violate the key or the
    not-null columns fail before anything is written.
    """
    require_columns(gold, GOLD_COLUMNS, "Gold table")
    stamp = F.current_timestamp() if load_time is None else load_time
    dated = _dated(conform(gold, GOLD_SCHEMA).withColumn("load_time", stamp))
    with staging(spark) as stage:
        rows = stage(dated, "kpi-rows")
        if not require_keyed(rows, KPI_KEY, _REQUIRED_KPIS):
            return
        days = partitions_in(rows, "window_date")

        def contents(version: Version) -> tuple[DataFrame, dict[str, int]]:
            return merge_kpis(kpis_of(spark, path, version, days), rows), {}

        commit(spark, path, "window_date", contents)


_LAST_ID = "last_event_id"


def upsert_overrides(
    spark: SparkSession, rows: DataFrame, path: str, now: Column | None = None
) -> None:
    """Merge checked override rows (with `ordinal`) into the override table.

    The key holds the start, so only the months of `rows` are read and written anew; one version then
    shows all of them at once, and carries the largest id in use. Two loads at a time never give out
    the same id: the later one is done again.
    """
    stamp = F.current_timestamp() if now is None else now
    with staging(spark) as stage:
        staged_rows = stage(rows, "override-rows")
        months = partitions_in(with_start_month(staged_rows), "start_month")
        if not months:
            return

        def contents(version: Version) -> tuple[DataFrame, dict[str, int]]:
            last_id = version.numbers.get(_LAST_ID)
            if last_id is None:
                last_id = overrides_of(spark, path, version).agg(F.max("event_id")).first()[0] or 0
            target = overrides_of(spark, path, version, months)
            merged = stage(merge_overrides(target, staged_rows, stamp, F.lit(last_id)), "overrides")
            largest = merged.agg(F.max("event_id")).first()[0]
            return with_start_month(merged), {_LAST_ID: max(last_id, largest)}

        commit(spark, path, "start_month", contents)
