"""Times the headline queries end to end and prints one JSON line."""

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from windrose.operators.upsert import upsert_kpis
from windrose.plans import views
from windrose.plans.gold import gold_kpis
from windrose.plans.silver import silver
from windrose.queries import QUERIES
from windrose.schemas import OVERRIDE_SCHEMA
from windrose.session import new_path
from windrose.sources.event_feed import read_raw_states
from windrose.sources.tables import read_kpis

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "silver_projection",
    "gold_kpis",
    "country_disruption_risk",
    "global_risk_board_latest",
    "country_trend",
    "worsening_risk",
    "capacity_candidates",
    "confidence_monitor",
    "active_overrides",
    "override_upsert",
    "kpi_upsert",
    "kpi_incremental",
]


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def history(spark: SparkSession) -> dict[str, float]:
    """Products over a long KPI history: the table's KPIs for ten more periods and ten times the countries."""
    kpis = gold_kpis(silver(read_raw_states(spark, FOLDER)))
    shift = F.make_dt_interval(F.col("period") * 30)
    long = (
        kpis.crossJoin(spark.range(20).select(F.col("id").cast("int").alias("period")))
        .crossJoin(spark.range(10).select(F.col("id").alias("part")))
        .withColumn("window_start", F.col("window_start") + shift)
        .withColumn("origin_country", F.concat("origin_country", F.lit(" "), F.col("part")))
        .drop("period", "part")
    )
    path = new_path(spark, "bench-fact")
    upsert_kpis(spark, long, path)
    fact, overrides = read_kpis(spark, path), spark.createDataFrame([], OVERRIDE_SCHEMA)
    products = {
        "history_risk": views.country_disruption_risk,
        "history_board": views.global_risk_board_view,
        "history_worsening": views.worsening_risk_view,
    }
    seconds = {}
    for name, product in products.items():
        start = time.perf_counter()
        product(fact, overrides).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    return {"history_rows": fact.count(), **seconds}


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("windrose-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="windrose-bench-"))
        # Without call-site capture the Python side builds plans with a third of the JVM calls.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "low_volume_windows")  # starts the JVM's workers, not part of the result
    seconds = {name: round(run(spark, name), 3) for name in HEADLINE}
    long = history(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "history": long,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
