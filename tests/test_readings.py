import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidegrain.operators import readings
from tidegrain.schemas import QUARANTINE, READING

SCHEMA = "source_id string, raw_file string, record_index int, ingested_at timestamp, Dato string, Klokkeslett string, Sted string, Latitude string, Longitude string, Antall_ledige_plasser string"
UTC = dt.timezone.utc


def rows(spark, *recs):
    base = {"day": "28.09.2026", "clock": "14:00", "name": "A", "lat": "58.97", "lon": "5.73", "n": "10", "at": dt.datetime(2026, 9, 28, 12, 3, tzinfo=UTC)}
    out = []
    for i, r in enumerate(recs):
        x = base | r
        out.append(("s", x.get("file", "f"), x.get("i", i), x["at"], x["day"], x["clock"], x["name"], x["lat"], x["lon"], x["n"]))
    return spark.createDataFrame(out, SCHEMA)


def test_summer_time(spark):
    r, q = readings.parse_readings(rows(spark, {}))
    x = r.withColumn("u", F.unix_seconds("reading_at")).first()
    assert x["u"] == int(dt.datetime(2026, 9, 28, 12, tzinfo=UTC).timestamp())
    assert (x["reading_minute_of_day"], x["utc_offset_minutes"], x["dst_resolved"], x["status"], x["available_spaces"]) == (840, 120, False, "numeric", 10)
    assert r.schema.simpleString() == READING.simpleString() and q.schema.simpleString() == QUARANTINE.simpleString() and q.count() == 0


@pytest.mark.parametrize("n", ["open", "-3", "12.5", " 12", "Full", "fullt", "Fullt ", "99999999999", "12\n"])
def test_not_a_count(spark, n):
    r, q = readings.parse_readings(rows(spark, {"n": n}))
    assert (r.first()["available_spaces"], r.first()["status"]) == (None, "unknown")
    assert [(x["field"], x["raw_value"], x["reason"]) for x in q.collect()] == [("Antall_ledige_plasser", n, "not_a_count")]


def test_tokens_and_decimals(spark):
    r, q = readings.parse_readings(rows(spark, {"n": "Fullt"}, {"n": "Open"}, {"lat": "58.97218849"}, {"lat": "1e1", "lon": ""}))
    got = [(x["available_spaces"], x["status"], x["latitude"]) for x in r.orderBy("record_index").collect()]
    assert got == [(0, "numeric", Decimal("58.9700000")), (None, "open", Decimal("58.9700000")), (10, "numeric", Decimal("58.9721885")), (10, "numeric", None)]
    assert sorted((x["field"], x["reason"]) for x in q.collect()) == [("Latitude", "not_a_decimal"), ("Longitude", "missing_value")]


def test_gap_and_overlap_of_clocks(spark):
    overlap = {"day": "25.10.2026", "clock": "02:30"}
    df = rows(spark, {"day": "29.03.2026", "clock": "02:30"}, overlap | {"at": dt.datetime(2026, 10, 25, 0, 33, tzinfo=UTC)}, overlap | {"at": dt.datetime(2026, 10, 25, 1, 33, tzinfo=UTC)}, {"day": "29.03.2026", "clock": "03:00"}, {"day": "31.02.2026"})
    r, q = readings.parse_readings(df)
    got = [(x["record_index"], x["u"], x["utc_offset_minutes"], x["dst_resolved"]) for x in r.withColumn("u", F.date_format("reading_at", "HH:mm")).orderBy("record_index").collect()]
    assert got == [(1, "00:30", 120, True), (2, "01:30", 60, True), (3, "01:00", 120, False)]
    assert sorted((x["record_index"], x["reason"]) for x in q.collect()) == [(0, "nonexistent_local_time"), (4, "invalid_date_time")]


def test_missing_columns_are_null(spark):
    r, q = readings.parse_readings(rows(spark, {}).drop("Latitude", "Klokkeslett"))
    assert r.count() == 0
    assert sorted((x["field"], x["reason"]) for x in q.collect()) == [("Dato Klokkeslett", "missing_value"), ("Latitude", "missing_value")]


def test_first_wins_and_conflicts(spark):
    late, early = dt.datetime(2026, 9, 28, 12, 8, tzinfo=UTC), dt.datetime(2026, 9, 28, 12, 3, tzinfo=UTC)
    f, _ = readings.parse_readings(rows(spark, {"n": "280", "at": late, "file": "b"}, {"n": "285", "at": early, "file": "a"}, {"n": "285", "at": late, "file": "c"}))
    r, q = readings.deduplicate(f)
    assert [x["available_spaces"] for x in r.collect()] == [285]
    assert [(x["raw_file"], x["raw_value"], x["reason"]) for x in q.collect()] == [("b", "280", "conflicting_duplicate")]


def fetches(spark, *pairs):
    """(fetched, shown) in minutes after a start."""
    t0 = dt.datetime(2026, 9, 28, 12, 0, tzinfo=UTC)
    return spark.createDataFrame([("s", f"{i:03}", t0 + dt.timedelta(minutes=a), t0 + dt.timedelta(minutes=b)) for i, (a, b) in enumerate(pairs)], "source_id string, raw_file string, ingested_at timestamp, reading_at timestamp")


def test_staleness_is_strict(spark):
    f = readings.freshness(fetches(spark, (15, 0), (15.02, 0), (-1, 0)), 15).orderBy("raw_file").collect()
    assert [x["is_stale"] for x in f] == [False, True, False]
    assert [round(x["age_minutes"], 3) for x in f] == [15.0, 15.017, -1.0]


def test_stale_periods_are_islands(spark):
    s = readings.freshness(fetches(spark, (0, 0), (20, 0), (25, 0), (30, 28), (50, 0), (60, 0), (70, 10)), 15)
    p = [(x["m"], x["fetch_count"], x["ongoing"]) for x in readings.stale_periods(s, 15).withColumn("m", F.minute("first_stale_fetch_at") + 60 * (F.hour("first_stale_fetch_at") - 12)).orderBy("m").collect()]
    assert p == [(20, 2, False), (50, 2, False), (70, 1, True)]


def test_empty(spark):
    r, q = readings.parse_readings(rows(spark, {}).where("false"))
    assert r.count() == q.count() == 0
    assert readings.stale_periods(readings.freshness(r)).count() == 0
