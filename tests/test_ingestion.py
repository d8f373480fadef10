"""Snapshot documents, silver and gold on tiny hand-computed inputs, and the streaming job."""

import json
import os
from datetime import datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from windrose.operators.upsert import upsert_kpis
from windrose.plans.gold import gold_kpis
from windrose.plans.silver import silver
from windrose.schemas import GOLD_COLUMNS, INGESTION_FIELD, SILVER_COLUMNS, SNAPSHOT_SCHEMA
from windrose.session import new_path
from windrose.sources import snapshots as S
from windrose.sources import tables
from windrose.streaming.incremental import land_documents, run_snapshot_stream

WINDOW = datetime(2024, 1, 1)
EPOCH = 1704067200


def state(icao="abc", country="X", contact=EPOCH - 10, ground=False, velocity=200.0, **more):
    row = [icao, "CS1 ", country, EPOCH - 200, contact, 1.5, 2.5, 900.0, ground, velocity, 10.0,
           more.get("rate", 0.0), [1, 2], more.get("altitude", 1000.0), "0001", False, 0]
    return row + ([3] if more.get("wide") else [])


def land(folder, name, states, window="2024-01-01T00:00:00+00:00"):
    os.makedirs(folder, exist_ok=True)
    document = {
        "time": EPOCH,
        "states": states,
        INGESTION_FIELD: {
            "window_start_utc": window,
            "state_count": len(states or []),
            "requested_at_utc": "2024-01-01T00:30:00.100000+00:00",
            "received_at_utc": "2024-01-01T00:30:01.350900+00:00",
            "response_time_ms": 1250,
            "http_status": 200,
            "auth_mode": "anonymous",
        },
    }
    with open(f"{folder}/{name}.json", "w") as file:
        json.dump(document, file)


def exploded(spark, tmp_path, *documents):
    for i, states in enumerate(documents):
        land(str(tmp_path / "in"), f"d{i}", states)
    return S.explode_states(S.read_snapshots(spark, str(tmp_path / "in")))


def test_documents_are_read_with_their_metadata(spark, tmp_path):
    land(str(tmp_path), "d", [state()], "2024-01-01T02:30:00+02:00")
    row = S.read_snapshots(spark, str(tmp_path)).first()
    assert row[INGESTION_FIELD].window_start_utc == datetime(2024, 1, 1, 0, 30)
    assert row[INGESTION_FIELD].response_time_ms == 1250
    assert row.states[0][8:10] == ["false", "200.0"]
    assert row.states[0][12] == "[1, 2]"


def test_broken_documents_fail(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"time": 1, "states": [[')
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD"):
        S.read_snapshots(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("wide", [False, True])
def test_vectors_become_named_columns(spark, tmp_path, wide):
    row = exploded(spark, tmp_path, [state("a1", wide=wide), state("a2", wide=wide)]).collect()[1]
    assert (row.pos, row.window_start, row.icao24, row.position_source) == (1, WINDOW, "a2", "0")
    assert row.category == ("3" if wide else None)


def test_shorter_vectors_are_padded(spark, tmp_path):
    rows = exploded(spark, tmp_path, [state(wide=True), state("b")]).collect()
    assert [r.category for r in rows] == ["3", None]


@pytest.mark.parametrize(
    "states", [[state()[:16]], [state(), state("b", wide=True)], [state() + [1, 2]]]
)
def test_other_widths_fail(spark, tmp_path, states):
    with pytest.raises(PySparkException, match="[Ss]tate vector"):
        exploded(spark, tmp_path, states).collect()


def test_snapshots_without_states_give_no_rows(spark, tmp_path):
    raw = exploded(spark, tmp_path, None, [])
    assert silver(raw).count() == 0
    assert gold_kpis(silver(raw)).count() == 0


def test_metadata_record_and_volume(spark):
    payloads = spark.createDataFrame(
        [(1, [["a"]] * 3), (2, None)], "time long, states array<array<string>>"
    )
    requested = F.lit("2024-01-01 00:30:00.100000").cast("timestamp")
    received = F.lit("2024-01-01 00:30:01.350900").cast("timestamp")
    enriched = S.with_ingestion_metadata(
        payloads,
        window_start=F.lit("2024-01-01").cast("timestamp"),
        requested_at=requested,
        received_at=received,
        http_status=F.lit(200),
        authenticated=F.col("time") == 1,
    )
    assert [f.name for f in enriched.schema.fields] == SNAPSHOT_SCHEMA.fieldNames()
    records = [r[INGESTION_FIELD] for r in enriched.orderBy("time").collect()]
    assert [r.state_count for r in records] == [3, 0]
    assert [r.response_time_ms for r in records] == [1250, 1250]
    assert [r.auth_mode for r in records] == ["authenticated", "anonymous"]
    assert [r.is_low_volume for r in S.with_volume_flag(enriched, minimum=3).collect()] == [False, True]
    seen = Observation("volume")
    S.observe_volume(enriched, seen, minimum=3).collect()
    assert seen.get == {"snapshots": 2, "states": 3, "low_volume_snapshots": 1}


def test_landing_a_window_again_replaces_it(spark, tmp_path):
    def landed(folder, name, states, window):
        land(str(tmp_path / folder), name, states, window)
        S.write_snapshots(S.read_snapshots(spark, str(tmp_path / folder)), str(tmp_path / "bronze"))

    landed("one", "a", [state("a")], "2024-01-01T00:00:00+00:00")
    landed("two", "b", [state("b")], "2024-01-01T00:30:00+00:00")
    landed("three", "a", [state("c"), state("d")], "2024-01-01T00:00:00+00:00")
    rows = S.explode_states(S.read_snapshots(spark, str(tmp_path / "bronze"))).collect()
    assert sorted((r.window_start.minute, r.icao24) for r in rows) == [(0, "c"), (0, "d"), (30, "b")]


def test_silver_rules(spark, tmp_path):
    states = [
        state(" ABC\t", "\xa0Y ", EPOCH - 121),
        state("dup", "X", None),
        state("dup", "X", EPOCH - 120, velocity=69.9),
        state("dup", "X", EPOCH - 120, velocity=300.0),
        state("future", None, EPOCH + 50, ground=True, velocity=None),
        state("slow", "X", "bad", velocity=None),
        state("  ", "X"),
        state(None, "X"),
    ]
    df = silver(exploded(spark, tmp_path, states))
    assert df.columns == SILVER_COLUMNS
    rows = {r.icao24: r for r in df.collect()}
    assert set(rows) == {"abc", "dup", "future", "slow"}
    assert (rows["abc"].origin_country, rows["abc"].callsign) == ("Y", "CS1")
    assert (rows["abc"].contact_age_sec, rows["abc"].is_stale_contact) == (121.0, True)
    assert (rows["dup"].velocity, rows["dup"].is_stale_contact) == (69.9, False)
    assert rows["dup"].is_low_velocity and rows["dup"].is_stale_position
    assert (rows["future"].origin_country, rows["future"].contact_age_sec) == ("Unknown", 0.0)
    assert not rows["future"].is_low_velocity
    assert (rows["slow"].last_contact, rows["slow"].is_stale_contact) == (None, True)
    assert rows["slow"].is_low_velocity


def test_silver_takes_another_reference_time(spark, tmp_path):
    raw = exploded(spark, tmp_path, [state(contact=EPOCH)])
    late = F.col("window_start") + F.expr("INTERVAL 30 MINUTES")
    assert silver(raw, reference_time=late).first().contact_age_sec == 1800.0


def test_gold_kpis_by_hand(spark, tmp_path):
    states = [
        state("a", "X", velocity=100.0, rate=2.5, altitude=10.0),
        state("b", "X", velocity=200.0, rate=-2.5, altitude=20.0),
        state("c", "X", velocity=None, rate=2.0, altitude=None),
        state("d", "X", None, ground=True, velocity=0.0),
        state("e", "Grounded", ground=True),
        state("f", " "),
        state("g", "NA"),
    ]
    df = gold_kpis(silver(exploded(spark, tmp_path, states)))
    assert df.columns == GOLD_COLUMNS
    rows = {r.origin_country: r.asDict() for r in df.collect()}
    assert set(rows) == {"X", "Grounded"}
    assert rows["X"] == {
        "window_start": WINDOW,
        "origin_country": "X",
        "total_flights": 4,
        "active_flights": 3,
        "on_ground": 1,
        "pct_grounded": 25.0,
        "avg_velocity_active": 150.0,
        "p90_velocity_active": 190.0,
        "median_geo_altitude_active": 15.0,
        "avg_abs_vertical_rate_active": 2.3333,
        "stale_contact_rate": 25.0,
        "low_velocity_rate": 25.0,
        "climbing_flights": 1,
        "descending_flights": 1,
        "data_completeness_score": 50.0,
        "operational_stress_index": 27.5,
    }
    grounded = rows["Grounded"]
    assert [grounded[c] for c in GOLD_COLUMNS[5:10]] == [100.0, 0.0, 0.0, 0.0, 0.0]


def test_gold_reads_the_cleaned_data_once(spark, tmp_path):
    df = gold_kpis(silver(exploded(spark, tmp_path, [state(), state("b")])))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Scan json") == 1
    assert final.count("ReusedExchange") >= 2


def test_gold_needs_its_columns(spark):
    with pytest.raises(ValueError, match="geo_altitude"):
        gold_kpis(spark.createDataFrame([(1,)], "icao24 int"))


def test_silver_and_gold_files_round_trip(spark, tmp_path):
    df = silver(exploded(spark, tmp_path, [state("a"), state("b", "NA"), state("c", ground=True)]))
    tables.write_silver(df, str(tmp_path / "silver"))
    again = tables.read_silver(spark, str(tmp_path / "silver"))
    assert again.drop("window_key").exceptAll(df).isEmpty()
    assert again.filter("window_key = '20240101_000000'").count() == 3
    df.write.option("header", True).csv(str(tmp_path / "csv"))
    from_csv = tables.read_silver_csv(spark, str(tmp_path / "csv"))
    assert gold_kpis(from_csv).collect() == gold_kpis(again).collect() == gold_kpis(df).collect()
    gold = gold_kpis(df)
    tables.write_gold(gold, str(tmp_path / "gold"))
    assert tables.read_gold(spark, str(tmp_path / "gold")).collect() == gold.collect()
    gold.write.option("header", True).csv(str(tmp_path / "gold_csv"))
    assert tables.read_gold_csv(spark, str(tmp_path / "gold_csv")).collect() == gold.collect()


def test_gold_csv_turns_missing_numbers_into_null(spark, tmp_path):
    values = ["2024-01-01 00:00:00", "X", "3.0", "2", "1"] + ["nan", ""] * 5 + ["1.5"]
    (tmp_path / "g.csv").write_text(",".join(GOLD_COLUMNS) + "\n" + ",".join(values) + "\n")
    row = tables.read_gold_csv(spark, str(tmp_path / "g.csv")).first()
    assert (row.total_flights, row.pct_grounded, row.climbing_flights) == (3, None, None)
    assert row.operational_stress_index == 1.5


def kpis_of(spark, path):
    rows = tables.read_kpis(spark, path).drop("load_time").collect()
    return sorted(map(tuple, rows), key=repr)


def test_stream_equals_batch_and_replays_windows(spark, tmp_path):
    bronze, fact = str(tmp_path / "bronze"), new_path(spark, "fact")
    places = {"silver_path": new_path(spark, "silver"), "fact_path": fact,
              "checkpoint": new_path(spark, "progress"), "files_per_batch": 1}

    def arrive(folder, states, window):
        land(str(tmp_path / folder), "d", states, window)
        S.write_snapshots(S.read_snapshots(spark, str(tmp_path / folder)), bronze)

    first, second = "2024-01-01T00:00:00+00:00", "2024-01-01T00:30:00+00:00"
    arrive("one", [state("a", "X"), state("b", "Y")], first)
    run_snapshot_stream(spark, bronze, **places)
    arrive("two", [state("a", "X"), state("c", "X")], second)
    run_snapshot_stream(spark, bronze, **places)

    batch = new_path(spark, "fact")
    raw = S.explode_states(S.read_snapshots(spark, bronze))
    upsert_kpis(spark, gold_kpis(silver(raw)), batch)
    assert kpis_of(spark, fact) == kpis_of(spark, batch)
    assert len(kpis_of(spark, fact)) == 3

    arrive("three", [state("a", "X"), state("d", "X")], first)  # the replay no longer has Y
    run_snapshot_stream(spark, bronze, **places)
    totals = {(r[0].minute, r[1]): r[2] for r in kpis_of(spark, fact)}
    assert totals == {(0, "X"): 2, (0, "Y"): 1, (30, "X"): 2}
    replaced = tables.read_silver(spark, places["silver_path"]).filter("window_key like '%_000000'")
    assert {r.icao24 for r in replaced.collect()} == {"a", "d"}
    run_snapshot_stream(spark, bronze, **places)
    assert len(kpis_of(spark, fact)) == 3


def test_stream_takes_documents_without_states(spark, tmp_path):
    bronze, fact = str(tmp_path / "bronze"), new_path(spark, "fact")
    places = {"silver_path": new_path(spark, "silver"), "fact_path": fact,
              "checkpoint": new_path(spark, "progress")}
    for name, states, minute in (("one", None, "00"), ("two", [state("a")], "30")):
        land(str(tmp_path / name), "d", states, f"2024-01-01T00:{minute}:00+00:00")
        S.write_snapshots(S.read_snapshots(spark, str(tmp_path / name)), bronze)
        run_snapshot_stream(spark, bronze, **places)
    assert len(kpis_of(spark, fact)) == 1


def test_documents_land_once_and_the_last_received_wins(spark, tmp_path):
    inbox, bronze, progress = (str(tmp_path / n) for n in ("inbox", "bronze", "progress"))

    def landed():
        land_documents(spark, inbox, bronze, progress)
        rows = S.explode_states(S.read_snapshots(spark, bronze)).collect()
        return sorted((r.window_start.minute, r.icao24) for r in rows)

    first, second = "2024-01-01T00:00:00+00:00", "2024-01-01T00:30:00+00:00"
    land(inbox, "a", [state("a")], first)
    land(inbox, "b", [state("b")], second)
    assert landed() == [(0, "a"), (30, "b")]
    land(inbox, "c", [state("c")], first)
    assert landed() == [(0, "c"), (30, "b")]
    assert landed() == [(0, "c"), (30, "b")]

    land(str(tmp_path / "both"), "early", [state("early")], first)
    early = S.read_snapshots(spark, str(tmp_path / "both"))
    shift = F.col(f"{INGESTION_FIELD}.received_at_utc") + F.expr("INTERVAL 1 HOUR")
    late = early.withColumn(INGESTION_FIELD, F.col(INGESTION_FIELD).withField("received_at_utc", shift))
    kept = S.latest_documents(early.withColumn("states", F.lit(None).cast("array<array<string>>")).union(late))
    assert [len(r.states) for r in kept.collect()] == [1]
