"""Frames, interval lookup, latest row, checks and upserts."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from windrose.operators.checks import require_columns, require_keyed
from windrose.operators.frames import (
    Trailing,
    newest_rows,
    parts_of_newest,
    with_trailing,
    with_trailing_by_block,
)
from windrose.operators import intervals
from windrose.operators.intervals import best_covering
from windrose.operators.latest import latest_per_key
from windrose.operators.upsert import merge_kpis, upsert_kpis
from windrose.plans import silver
from windrose.schemas import GOLD_INPUT_COLUMNS, GOLD_SCHEMA, STATE_COLUMNS
from windrose.session import new_path
from windrose.sources.tables import kpis_of, read_kpis, write_partitions
from windrose.sources.versions import current_version, partitions_in

T0 = datetime(2024, 1, 1)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def history(spark, rows=700):
    random.seed(3)
    at, data = 0, []
    for _ in range(rows):
        at += random.choice([1, 1, 1, 40, 2000])
        data.append(("hot", at, float(random.randrange(100))))
        if random.random() < 0.1:
            data.append(("cold", at, float(random.randrange(100))))
    return spark.createDataFrame(data, "key string, at long, v double")


def test_trailing_frames_equal_plain_windows(spark):
    df = history(spark).withColumn("v", F.when(F.col("at") % 7 != 0, F.col("v") / 8))
    frames = {
        "mean": Trailing("v", 48, skip=1, deviation="sd"),
        "six": Trailing("v", 6),
        "one": Trailing("at", 1, skip=2),
    }
    ours = with_trailing(df, "key", "at", frames)
    w = Window.partitionBy("key").orderBy("at")
    past = w.rowsBetween(-48, -1)
    plain = df.select(
        "*",
        F.avg("v").over(past).alias("mean"),
        F.stddev_samp("v").over(past).alias("sd"),
        F.avg("v").over(w.rowsBetween(-5, 0)).alias("six"),
        F.avg("at").over(w.rowsBetween(-2, -2)).alias("one"),
    )
    assert set(ours.columns) == set(plain.columns)
    pairs = zip(sorted(ours.select(plain.columns).collect()), sorted(plain.collect()), strict=True)
    for a, b in pairs:
        assert a[:3] == b[:3]
        for x, y in zip(a[3:], b[3:], strict=True):
            assert x == (None if y is None else pytest.approx(y, abs=1e-9))


def test_trailing_frames_of_a_constant_history_have_no_deviation(spark):
    df = spark.range(300).select(F.lit("k").alias("key"), "id", F.lit(0.1).alias("v"))
    frames = {"mean": Trailing("v", 48, skip=1, deviation="sd")}
    rows = with_trailing(df, "key", "id", frames).where("id > 1").collect()
    assert {r.sd for r in rows} == {0.0}
    assert all(r.mean == pytest.approx(0.1, abs=1e-15) for r in rows)


def test_trailing_frames_sort_once(spark):
    frames = {"mean": Trailing("v", 48, skip=1, deviation="sd"), "six": Trailing("v", 6)}
    plan = physical(with_trailing(history(spark), "key", "at", frames))
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1


@pytest.mark.parametrize("days", [1, 3, 20, 10_000])
def test_trailing_frames_by_block_are_the_same(spark, days):
    """A hot key, one with long gaps, one with less rows than a frame, null values and a null key."""
    random.seed(days)
    rows, at = [], 0
    for _ in range(900):
        at += random.choice([0, 0, 0, 0, 1, 1, 5, 90])
        rows.append(("hot", at, len(rows), random.choice([None, random.randrange(10**6) / 1000])))
        if random.random() < 0.2:
            rows.append((random.choice(["cold", "cold", None]), at, len(rows), float(random.randrange(100))))
    rows += [("few", 3, 10**6, 1.0), ("few", 5000, 10**6 + 1, 2.0), ("new", None, 0, 1.5), ("new", 2, 7, 2.5)]
    df = spark.createDataFrame(rows, "key string, n int, at long, v double")
    df = df.select("key", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n")).alias("day"), "at", "v")
    frames = {
        "mean": Trailing("v", 48, skip=1, deviation="sd"),
        "six": Trailing("v", 6),
        "one": Trailing("v", 1, skip=2),
    }
    plain = with_trailing(df, "key", "at", frames)
    blocks = with_trailing_by_block(df, "key", "at", "day", frames, days)
    assert blocks.columns == plain.columns
    assert sorted(map(tuple, blocks.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_a_hot_key_is_worked_on_by_many_tasks(spark):
    """Half-hourly rows of two years, nine tenths of them of one key: no task holds two fifths of them."""
    rows = spark.range(35_040).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("k"), F.col("id") % 7)).otherwise(F.lit("hot")).alias("key"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 48).cast("int")).alias("day"),
        F.col("id").alias("at"),
        (F.col("id") % 100).cast("double").alias("v"),
    )
    frames = {"mean": Trailing("v", 48, skip=1, deviation="sd")}
    framed = with_trailing_by_block(rows.repartition(8), "key", "at", "day", frames)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = with_trailing(rows.repartition(8), "key", "at", frames)
        sizes, whole = (
            [r["rows"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows"), F.max("sd")).collect()]
            for df in (framed, plain)
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == sum(whole) == 35_040
    assert max(whole) >= 0.9 * 35_040
    assert max(sizes) < 0.4 * 35_040


def test_parts_of_newest_hold_just_enough(spark):
    df = history(spark).withColumn("part", F.floor(F.col("at") / 100))
    parts = parts_of_newest(df, ["key"], "part", 30)
    near = df.join(parts, ["key", "part"], "left_semi")
    newest = newest_rows(df, "key", "at", 30).drop("rn")
    assert newest.exceptAll(near.select(newest.columns)).isEmpty()
    oldest = parts.groupBy("key").agg(F.min("part").alias("part"))
    later = near.join(oldest, ["key", "part"], "left_anti").groupBy("key").count()
    assert all(r["count"] < 30 for r in later.collect())


def test_newest_rows_limits_groups_before_the_shuffle(spark):
    plan = physical(newest_rows(history(spark), "key", "at", 3))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_latest_takes_greatest_and_partial_aggregates(spark):
    rows = [("a", 5.0, 2, "x"), ("a", 5.0, 1, "first"), ("a", None, 0, "y"),
            ("b", None, 4, "z"), ("b", None, 3, "first")]
    df = spark.createDataFrame(rows, "key string, seen double, pos int, name string")
    latest = latest_per_key(df, ["key"], [F.col("seen"), -F.col("pos")])
    assert {r.key: r.name for r in latest.collect()} == {"a": "first", "b": "first"}
    plan = physical(latest)
    assert plan.rindex("partial_max_by") > plan.index("Exchange")


def test_only_asked_columns_go_through_the_latest_rows(spark):
    row = {c: "1" for c in STATE_COLUMNS} | {"pos": 1, "window_start": datetime(2024, 1, 1)}
    raw = spark.createDataFrame([row, row | {"pos": 2, "callsign": "x", "velocity": "2"}])
    whole, some = silver.silver(raw), silver.silver(raw, columns=GOLD_INPUT_COLUMNS)
    assert some.collect() == whole.select(*GOLD_INPUT_COLUMNS).collect() and len(some.collect()) == 1
    shuffled = re.search(r"max_by\(struct\(([^)]*)\)", some._jdf.queryExecution().optimizedPlan().toString())[1]
    assert "velocity" in shuffled and "callsign" not in shuffled


@pytest.mark.parametrize("grid", [1, 60, 1800])
def test_best_covering_equals_brute_force(spark, grid):
    random.seed(grid)
    span = 400 * grid
    points = [(i, random.choice("abAB"), random.randrange(0, span // grid) * grid) for i in range(300)]
    spans = []
    for i in range(200):
        first = random.randrange(-span, span)
        last = first + random.choice([0, -5, random.randrange(3 * grid), random.randrange(3 * span)])
        spans.append((i, random.choice("aBc"), first, last, random.randrange(8)))
    ours = best_covering(
        spark.createDataFrame(points, "id int, name string, at long"),
        spark.createDataFrame(spans, "event int, place string, first long, last long, rank int"),
        point_keys=["id"],
        point_match=F.upper("name"),
        point_second=F.col("at"),
        interval_match=F.upper("place"),
        first_second=F.col("first"),
        last_second=F.col("last"),
        best=[F.col("rank"), F.col("event")],
    )
    expected = {}
    for i, name, at in points:
        fits = [
            (rank, event)
            for event, place, first, last, rank in spans
            if place.upper() == name.upper() and first <= at <= last
        ]
        if fits:
            expected[i] = max(fits)
    assert {r.id: (r["rank"], r.event) for r in ours.collect()} == expected


def test_blocks_of_an_interval_do_not_depend_on_the_points(spark):
    """A ten-year interval and one window off the grid: a few blocks per level, not thousands."""
    ten_years = 315_360_000
    for first, last in ((0, ten_years), (7, ten_years + 11), (1, 2)):
        span = spark.range(1).select(F.lit(first).cast("long").alias("a"), F.lit(last + 1).cast("long").alias("b"))
        blocks = span.select(F.explode(intervals._covering_blocks(F.col("a"), F.col("b"))).alias("x")).select("x.*")
        rows = blocks.collect()
        assert len(rows) <= 2 * sum(b // a for a, b in zip(intervals._BLOCKS, intervals._BLOCKS[1:])) + 4
        seconds = sum(intervals._BLOCKS[r.level] for r in rows)
        assert seconds == last + 1 - first


def test_required_columns_are_named_in_order(spark):
    with pytest.raises(ValueError, match=r"\['a', 'c'\]"):
        require_columns(spark.range(1).withColumnRenamed("id", "b"), ["c", "b", "a"], "Table")


def test_key_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert require_keyed(df, ["k", "v"], ["v"]) == 2
    assert require_keyed(df.limit(0), ["k", "v"], ["v"]) == 0
    with pytest.raises(ValueError, match="not unique"):
        require_keyed(df, ["k"], ["v"])
    empty_cell = spark.createDataFrame([(1, None)], "k int, v string")
    with pytest.raises(ValueError, match="Null values"):
        require_keyed(empty_cell, ["k"], ["v"])


def kpi_rows(spark, rows):
    """(hours after T0, country, total flights) as full KPI rows."""
    data = []
    for hours, country, total in rows:
        row = {f.name: 0 if f.dataType.typeName() == "integer" else 0.0 for f in GOLD_SCHEMA.fields}
        row |= {"window_start": T0 + timedelta(hours=hours), "origin_country": country}
        row["total_flights"] = total
        data.append(tuple(row[f.name] for f in GOLD_SCHEMA.fields))
    return spark.createDataFrame(data, GOLD_SCHEMA)


def stored(spark, path):
    return {
        ((r.window_start - T0).total_seconds() / 3600, r.origin_country): (r.total_flights, r.load_time)
        for r in read_kpis(spark, path).collect()
    }


def test_upsert_inserts_updates_and_keeps(spark):
    path = new_path(spark, "fact")
    early, late = (F.lit(t).cast("timestamp") for t in ("2024-02-01", "2024-02-02"))
    upsert_kpis(spark, kpi_rows(spark, [(0, "X", 1), (0, "Y", 2), (30, "X", 3)]), path, early)
    replay = kpi_rows(spark, [(0, "X", 9), (0, "x", 5), (60, "Z", 6)])
    for _ in range(2):
        upsert_kpis(spark, replay, path, late)
        assert stored(spark, path) == {
            (0, "X"): (9, datetime(2024, 2, 2)),
            (0, "x"): (5, datetime(2024, 2, 2)),  # keys match in exact case
            (0, "Y"): (2, datetime(2024, 2, 1)),
            (30, "X"): (3, datetime(2024, 2, 1)),
            (60, "Z"): (6, datetime(2024, 2, 2)),
        }


def test_upsert_reads_only_touched_days(spark):
    path = new_path(spark, "fact")
    upsert_kpis(spark, kpi_rows(spark, [(24 * day, "X", day) for day in range(30)]), path)
    rows = kpi_rows(spark, [(24 * 7, "X", 70), (24 * 9, "Y", 90)])
    dated = rows.withColumn("window_date", F.to_date("window_start"))
    version = current_version(spark, path, "window_date")
    merged = merge_kpis(kpis_of(spark, path, version, partitions_in(dated, "window_date")), dated)
    assert sorted(r.total_flights for r in merged.collect()) == [9, 70, 90]
    execution = merged._jdf.queryExecution()
    scans = list_scans(execution.executedPlan())
    assert min(scans) == 2  # of 30 files: days 7 and 9


def list_scans(plan):
    """Files read by each parquet scan of an executed plan."""
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        return list_scans(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return list_scans(plan.plan())
    children = plan.children()
    if plan.nodeName().startswith("Scan parquet"):
        return [plan.metrics().apply("numFiles").value()]
    return [n for i in range(children.size()) for n in list_scans(children.apply(i))]


def test_upsert_of_nothing_changes_nothing(spark):
    path = new_path(spark, "fact")
    upsert_kpis(spark, kpi_rows(spark, [(0, "X", 1)]), path)
    before = stored(spark, path)
    upsert_kpis(spark, kpi_rows(spark, []), path)
    assert stored(spark, path) == before


def test_upsert_rejects_repeated_keys(spark):
    path = new_path(spark, "fact")
    upsert_kpis(spark, kpi_rows(spark, [(0, "X", 1)]), path)
    with pytest.raises(ValueError, match="not unique"):
        upsert_kpis(spark, kpi_rows(spark, [(0, "X", 2), (0, "X", 3)]), path)
    assert stored(spark, path)[(0, "X")][0] == 1


def test_upsert_adds_columns_to_an_older_table(spark):
    path = new_path(spark, "fact")
    old = kpi_rows(spark, [(0, "X", 1), (0, "Y", 2)]).drop("p90_velocity_active")
    write_partitions(old.withColumn("window_date", F.to_date("window_start")), path, "window_date")
    upsert_kpis(spark, kpi_rows(spark, [(0, "X", 7)]), path)
    rows = {r.origin_country: r.p90_velocity_active for r in read_kpis(spark, path).collect()}
    assert rows == {"X": 0.0, "Y": None}
