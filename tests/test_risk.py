"""Risk model and products on small histories worked out by hand."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from windrose.operators.upsert import upsert_kpis, upsert_overrides
from windrose.plans import risk, views
from windrose.plans.overrides import checked_overrides
from windrose.schemas import GOLD_SCHEMA, OVERRIDE_SCHEMA
from windrose.session import new_path, staged
from windrose.sources.tables import read_kpis

T0 = datetime(2024, 1, 1)
LONG = ("2024-01-01", "2024-02-01")


def kpis(spark, rows):
    """(half-hours after T0, country, total flights, stress, pct grounded)"""
    data = []
    for step, country, total, stress, grounded in rows:
        row = {f.name: 1 if f.dataType.typeName() == "integer" else 50.0 for f in GOLD_SCHEMA.fields}
        row |= {
            "window_start": T0 + timedelta(minutes=30 * step), "origin_country": country,
            "total_flights": total, "operational_stress_index": stress, "pct_grounded": grounded,
        }
        data.append(tuple(row[f.name] for f in GOLD_SCHEMA.fields))
    return spark.createDataFrame(data, GOLD_SCHEMA)


def events(spark, *rows):
    """(region type, region, event, severity, band, start, end, active)"""
    data = []
    for i, (kind, region, event, severity, band, start, end, active) in enumerate(rows):
        times = [datetime.fromisoformat(t) for t in (start, end)]
        data.append(
            (i + 1, kind, region, event, "desk", f"n{i}", float(severity), band, *times, active, T0, T0)
        )
    return spark.createDataFrame(data, OVERRIDE_SCHEMA)


def by_step(df, country="X"):
    rows = df.filter(F.col("origin_country") == country).collect()
    return {int((r.window_start - T0).total_seconds() // 1800): r for r in rows}


def test_short_and_constant_histories_have_no_anomaly(spark):
    df = kpis(spark, [(i, "X", 10, 20.0, 30.0) for i in range(5)])
    rows = by_step(risk.country_disruption_risk(df, events(spark)))
    assert {(r.telemetry_risk_zscore, r.disruption_band, r.capacity_drop_pct) for r in rows.values()} == {
        (0.0, "normal", 0.0)
    }
    two = by_step(risk.country_disruption_risk(kpis(spark, [(0, "X", 10, 0.0, 0.0), (1, "X", 5, 9.0, 9.0)]), events(spark)))
    assert (two[1].telemetry_risk_zscore, two[1].capacity_drop_pct) == (0.0, 50.0)


def test_scores_by_hand(spark):
    df = kpis(spark, [(0, "X", 10, 10.0, 20.0), (1, "X", 20, 20.0, 40.0), (9, "X", 9, 25.0, 20.0)])
    row = by_step(risk.country_disruption_risk(df, events(spark)))[9]
    sd = 50**0.5
    z = 0.45 * (10 / sd) + 0.25 * (-10 / (2 * sd)) + 0.30 * (6 / sd)
    assert row.telemetry_risk_zscore == round(z, 4)
    assert row.capacity_drop_pct == 40.0


def test_baseline_holds_48_rows_whatever_the_gaps(spark):
    steps = [i if i < 20 else i * 7 for i in range(60)]
    df = kpis(spark, [(s, "X", 10, 100.0 if i == 0 else 20.0 + i % 2, 30.0) for i, s in enumerate(steps)])
    rows = by_step(risk.with_baselines(df))
    assert rows[steps[48]].baseline_stress == pytest.approx((100 + 24 * 21 + 23 * 20) / 48)
    assert rows[steps[49]].baseline_stress == 20.5
    assert rows[0].baseline_stress is None and rows[1].baseline_stress_sd is None


@pytest.mark.parametrize(
    "z, band",
    [(2.0, "critical"), (1.9999, "high"), (1.0, "high"), (0.9999, "watch"), (0.2, "watch"), (0.1999, "normal")],
)
@pytest.mark.parametrize("floor", ["normal", "watch", "high", "critical"])
def test_bands_and_floors(spark, z, band, floor):
    df = spark.createDataFrame(
        [(z, 0.0, floor)],
        "telemetry_risk_zscore double, event_severity_score double, min_disruption_band string",
    )
    order = ["normal", "watch", "high", "critical"]
    row = risk.with_bands(df).first()
    assert row.computed_band == band
    assert row.disruption_band == max(band, floor, key=order.index)


def test_override_matching(spark):
    hour = [(2 * i, c, 10, 20.0, 30.0) for i in range(10) for c in ("Africa", "Asia", "Europe", "Oz", "Peru")]
    table = events(
        spark,
        ("country", "AFRICA", "storm", 80, "high", "2024-01-01 01:00", "2024-01-01 03:00", True),
        ("country", "africa", "strike", 80, "watch", "2024-01-01 02:00", "2024-01-01 05:00", True),
        ("country", "africa", "drizzle", 5, None, *LONG, True),
        ("country", "Asia", "volcano", 4, "critical", "2024-01-01 08:00", "2024-01-01 08:00", True),
        ("country", "EUROPE", "x", 99, "critical", *LONG, False),
        ("airport", "Oz", "closure", 90, "critical", *LONG, True),
        ("Country", "PERU", "drill", 0, "normal", *LONG, True),
    )
    df = risk.country_disruption_risk(kpis(spark, hour), table)

    def cells(country):
        return {s // 2: (r.event_type, r.disruption_band) for s, r in by_step(df, country).items()}

    drizzle = ("drizzle", "watch")
    assert cells("Africa") == {
        0: drizzle, 1: ("storm", "critical"), 2: ("strike", "critical"), 3: ("strike", "critical"),
        4: ("strike", "critical"), 5: ("strike", "critical"), **{h: drizzle for h in range(6, 10)},
    }
    assert [h for h, c in cells("Asia").items() if c == ("volcano", "critical")] == [8]
    assert set(cells("Europe").values()) == set(cells("Oz").values()) == {(None, "normal")}
    peru = by_step(df, "Peru").values()
    assert {(r.active_event_override, r.event_severity_score, r.disruption_band) for r in peru} == {
        (True, 0.0, "normal")
    }


def zigzag(spark, countries=("X", "Y")):
    rows = [(i, c, 40 + (i * 7) % 11, float((i * 13) % 17), float((i * 5) % 23)) for i in range(70) for c in countries]
    rows += [(i, "Ends early", 50, float(i % 5), 1.0) for i in range(60)]
    return kpis(spark, rows)


def test_newest_risk_equals_the_full_view(spark):
    df = zigzag(spark)
    table = events(spark, ("country", "x", "storm", 60, "high", "2024-01-01", "2024-01-02 10:30", True))
    full = risk.country_disruption_risk(df, table)
    newest = risk.newest_risk(df, table, rows=3)
    ranked = risk.newest_rows(full, "origin_country", "window_start", 3)
    assert newest.count() == 9
    assert newest.exceptAll(ranked.select(newest.columns)).isEmpty()
    latest, expected = risk.latest_risk(df, table), risk.at_latest_window(full, df)
    assert latest.count() == expected.count() == 2
    assert latest.exceptAll(expected).isEmpty()


def test_products_use_the_latest_window(spark):
    df, table = zigzag(spark), events(spark)
    board = views.global_risk_board(df, table).collect()
    assert {r.origin_country for r in board} == {"X", "Y"}
    assert views.capacity_candidates(df, table, top=1).count() == 1
    assert views.capacity_candidates(df, table, min_flights=1000).count() == 0
    assert views.worsening_risk(df, table).count() == 3


def test_trend_averages_and_filter(spark):
    rows = [(i, "X", 10 * i, float(i), 1.0) for i in range(8)] + [(0, "Y", 1, 1.0, 1.0)]
    trend = views.country_trend(kpis(spark, rows), events(spark), "X").collect()
    assert [r.flights_ma_6 for r in trend] == [45.0, 35.0, 25.0, 20.0, 15.0, 10.0, 5.0, 0.0]
    assert trend[0].stress_ma_6 == 4.5


@pytest.mark.parametrize(
    "z, now, before, signal",
    [
        (1.5, 15.0, 10.0, views.SIGNAL_URGENT),
        (1.4, 15.0, 10.0, views.SIGNAL_ELEVATED),
        (1.0, 12.0, 10.0, views.SIGNAL_ELEVATED),
        (9.0, 11.9, 10.0, views.SIGNAL_STABLE),
        (0.9, 99.0, 10.0, views.SIGNAL_STABLE),
        (9.0, 99.0, None, views.SIGNAL_STABLE),
    ],
)
def test_trend_signals(spark, z, now, before, signal):
    df = spark.createDataFrame(
        [(z, now, before, None)],
        "risk_z_t0 double, stress_t0 double, stress_t1 double, stress_t2 double",
    )
    row = df.select(views.trend_signal().alias("s"), views.two_window_change().alias("d")).first()
    assert row.s == signal
    assert row.d == (None if before is None else now - before)


@pytest.mark.parametrize(
    "active, band, start",
    [(True, "normal", "External"), (False, "critical", "Immediate"), (False, "high", "Pre-position"),
     (False, "watch", "Monitor"), (False, "normal", "Normal")],
)
def test_actions(spark, active, band, start):
    df = spark.createDataFrame([(active, band)], "active_event_override boolean, disruption_band string")
    assert df.select(views.recommended_action().alias("a")).first().a.startswith(start)


def test_active_overrides_include_both_ends(spark):
    table = events(
        spark,
        ("country", "A", "x", 1, "normal", "2024-01-01", "2024-01-02", True),
        ("country", "B", "x", 2, "normal", "2024-01-02", "2024-01-03", True),
        ("country", "C", "x", 3, "normal", "2024-01-02", "2024-01-03", False),
    )
    moment = F.lit("2024-01-02").cast("timestamp")
    assert [r.region_value for r in views.active_overrides(table, moment).collect()] == ["B", "A"]
    assert views.active_overrides(table).count() == 0
    assert views.switched_on(table).count() == 2


def test_views_answer_sql(spark):
    names = views.register_views(spark, zigzag(spark), events(spark))
    assert len(names) == 9
    top = spark.sql(
        "SELECT * FROM V_CAPACITY_ALLOCATION_CANDIDATES_LATEST ORDER BY impact_score DESC LIMIT 20"
    )
    assert top.count() == 2
    assert spark.sql("SELECT * FROM v_decision_confidence_monitor").count() == 70
    trend = spark.sql("SELECT * FROM V_COUNTRY_DEEP_DIVE_TREND WHERE origin_country = 'X'")
    assert trend.count() == 70


def test_country_filter_reaches_the_scan(spark):
    stored = staged(zigzag(spark), "kpis")
    views.register_views(spark, stored, events(spark))
    trend = spark.sql("SELECT * FROM v_country_deep_dive_trend WHERE origin_country = 'X'")
    plan = trend._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "origin_country" in line]
    assert scans and all("EqualTo(origin_country,X)" in scan for scan in scans)


def test_plan_shapes(spark):
    df, table = zigzag(spark), events(spark)
    plan = risk.country_disruption_risk(df, table)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    board = views.global_risk_board(df, table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in board


def dated_fact(spark, path, rows):
    upsert_kpis(spark, kpis(spark, rows), path)
    return read_kpis(spark, path)


def long_history(days=40):
    """X reports always, Gaps on some days, Young only lately, Silent long ago."""
    rows = [(48 * d + 12 * i, "X", 30 + (d * 7 + i) % 9, float((d * 3 + i) % 13), 1.0) for d in range(days) for i in range(4)]
    rows += [(48 * d + 12 * i, "Gaps", 20 + i, float(d % 11), 2.0) for d in range(0, days, 3) for i in range(4)]
    rows += [(48 * (days - 1) + 12 * i, "Young", 9 + i, float(i), 3.0) for i in range(4)]
    rows += [(48 * d, "Silent", 5, float(d % 4), 4.0) for d in range(5)]
    rows += [(48 * (days - 1) + 36, "Gaps", 25, 8.0, 2.0)] if (days - 1) % 3 else []
    return rows


def test_latest_products_read_only_the_days_they_need(spark):
    path = new_path(spark, "fact")
    fact = dated_fact(spark, path, long_history())
    table = events(spark)
    full = risk.country_disruption_risk(fact, table)
    latest, expected = risk.latest_risk(fact, table), risk.at_latest_window(full, fact)
    assert latest.count() == expected.count() == 3
    assert latest.exceptAll(expected.select(latest.columns)).isEmpty()
    for rows in (1, 3):
        newest = risk.newest_risk(fact, table, rows)
        ranked = risk.newest_rows(full, "origin_country", "window_start", rows)
        assert newest.count() == ranked.count()
        assert newest.exceptAll(ranked.select(newest.columns)).isEmpty()


def test_a_young_fact_prunes_to_its_newest_days(spark):
    path = new_path(spark, "fact")
    fact = dated_fact(spark, path, [r for r in long_history() if r[1] == "X"])
    needed = risk.parts_of_newest(fact, ["origin_country"], "window_date", 49).count()
    assert needed == 13  # four rows a day
    plan = risk.newest_history(fact, 49)._jdf.queryExecution().executedPlan().toString()
    assert path not in plan  # what follows reads the staged rows only


def test_views_follow_a_load(spark):
    fact, overrides = new_path(spark, "fact"), new_path(spark, "overrides")
    event = {"ordinal": 0, "region_type": "country", "region_value": "X", "event_type": "storm", "source": "s",
             "notes": "n", "severity_score": "90", "min_disruption_band": "high", "event_start_utc": "2024-01-01",
             "event_end_utc": "2024-02-01", "is_active": "true"}

    def load(rows, region):
        upsert_kpis(spark, kpis(spark, rows), fact)
        raw = spark.createDataFrame([tuple({**event, "region_value": region}.values())], "ordinal long, " + ", ".join(f"{c} string" for c in list(event)[1:]))
        upsert_overrides(spark, checked_overrides(raw), overrides)
        return views.refresh_views(spark, fact, overrides, F.lit("2024-01-02").cast("timestamp"))

    counts = lambda names: {n: spark.sql(f"SELECT * FROM {n}").count() for n in names}
    names = load([(i, "X", 40, float(i % 7), 1.0) for i in range(60)], "X")
    before = counts(names)
    names = load([(i, c, 40, float(i % 5), 1.0) for i in range(50, 70) for c in ("X", "Y")], "Y")
    after = counts(names)
    assert (before["flight_kpis"], after["flight_kpis"]) == (60, 90)
    assert (before["v_country_disruption_risk"], after["v_country_disruption_risk"]) == (60, 90)
    assert (before["v_active_event_overrides"], after["v_active_event_overrides"]) == (1, 2)
    assert (before["v_exec_global_risk_board_latest"], after["v_exec_global_risk_board_latest"]) == (1, 2)
    assert after["v_decision_confidence_monitor"] == 70
    assert after["v_country_deep_dive_trend"] == 90
    assert after["v_worsening_risk_detection"] == after["v_capacity_allocation_candidates_latest"] == 2


def test_numbered_reports_share_places_on_ties(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("b", 5)], "g string, v int")
    rows = views.numbered(df, [F.desc("v")], "g").collect()
    assert sorted((r.g, r.v, r.position) for r in rows) == [("a", 1, 3), ("a", 2, 1), ("a", 2, 1), ("b", 5, 1)]


@pytest.mark.parametrize("within", [(), ("g",)])
def test_places_by_block_equal_places_of_all(spark, within):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.choice([None, 1.0, 2.5, 7.0]), rng.choice([None, *range(40)]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, severity double, at int, id int")
    order = [F.desc("severity"), F.desc("at")]
    blocks = {"severity": F.col("severity"), "tens": F.floor(F.col("at") / 10)}
    plain = views.numbered(df, order, *within)
    ours = views.numbered_by_block(df, order, blocks, *within)
    assert ours.columns == plain.columns
    assert sorted(map(tuple, ours.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    rising = views.numbered_by_block(df, [F.asc("at")], {"tens": F.floor(F.col("at") / 10)}, *within, descending=False)
    expected = views.numbered(df, [F.asc("at")], *within)
    assert sorted(map(tuple, rising.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_a_long_report_is_not_ranked_in_one_task(spark):
    df = spark.range(20_000).select((F.col("id") * 1800).cast("timestamp").alias("window_start"))
    ranked = views.numbered_by_block(df.repartition(8), [F.desc("window_start")], {"day": F.to_date("window_start")})
    sizes = ranked.groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows"), F.max("position").alias("last")).collect()
    assert max(r["last"] for r in sizes) == sum(r["rows"] for r in sizes) == 20_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["rows"] for r in ranked.groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows"), F.max("position")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(sizes) < 0.3 * 20_000
