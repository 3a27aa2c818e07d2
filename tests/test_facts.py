import hashlib
import json
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegrain.operators import calendar, facility, facts, polling, pricing, register
from tidegrain.operators.facts import Glitch
from tidegrain.schemas import AREA, FACILITY, HOURLY, STALE_PERIOD

UTC = dt.timezone.utc
T0 = dt.datetime(2026, 9, 28, 12, 0, tzinfo=UTC)
AV = "facility_key int, source_id string, valid_from timestamp, valid_to timestamp, last_fetched_at timestamp, available_spaces int, status string, is_source_glitch boolean"


def at(m):
    return None if m is None else T0 + dt.timedelta(minutes=m)


def series(spark, *recs):
    """(from, to, last fetch, spaces, glitch)"""
    return spark.createDataFrame([(1, "s", at(a), at(b), at(c), n, "numeric" if n is not None else "open", g) for a, b, c, n, g in recs], AV)


def periods(spark, *recs):
    return spark.createDataFrame([("s", at(a), at(b), at(b), at(c), 1, False) for a, b, c in recs], STALE_PERIOD)


def hours(spark, av, p=None, gap=20):
    return [x.asDict() for x in facts.hourly(av, p if p is not None else periods(spark), gap).orderBy("hour_start").collect()]


def test_weighted_average(spark):
    (h,) = hours(spark, series(spark, (0, 20, 20, 100, False), (20, 60, 60, 50, False)))
    assert h["avg_spaces"] == pytest.approx(200 / 3) and (h["min_spaces"], h["max_spaces"], h["observation_count"], h["covered_minutes"]) == (50, 100, 2, 60.0)


def test_interval_splits_at_hours(spark):
    assert [h["covered_minutes"] for h in hours(spark, series(spark, (30, 150, 150, 1, False)))] == [30.0, 60.0, 30.0]


def test_evidence_ends(spark):
    (h,) = hours(spark, series(spark, (0, 70, 10, 1, False)))
    assert h["covered_minutes"] == 30.0


def test_glitch_and_open_dont_count(spark):
    (h,) = hours(spark, series(spark, (0, 40, 40, 395, False), (40, 45, 45, 0, True), (45, 60, 60, 396, False)))
    assert h["avg_spaces"] == pytest.approx((395 * 40 + 396 * 15) / 55) and (h["counted_minutes"], h["observation_count"]) == (55.0, 3)
    (h,) = hours(spark, series(spark, (0, 30, 30, None, False)))
    assert (h["avg_spaces"], h["counted_minutes"], h["covered_minutes"]) == (None, 0.0, 30.0)


def test_stale_minutes_and_no_fan_out(spark):
    av = series(spark, (0, None, 100, 5, False))
    assert [(h["covered_minutes"], h["stale_minutes"]) for h in hours(spark, av, periods(spark, (0, 15, 100)))] == [(60.0, 45.0), (40.0, 40.0)]
    twice = hours(spark, av, periods(spark, (0, 15, 40), (0, 15, 100)))
    assert [(h["covered_minutes"], h["observation_count"]) for h in twice] == [(60.0, 1), (40.0, 1)]


def test_autumn_day_has_an_hour_twice(spark):
    t = dt.datetime(2026, 10, 25, 0, 0, tzinfo=UTC)
    av = spark.createDataFrame([(1, "s", t, t + dt.timedelta(hours=2), t + dt.timedelta(hours=2), 5, "numeric", False)], AV)
    h = facts.hourly(av, periods(spark), 20)
    assert [(x["date_key"], x["hour"]) for x in h.collect()] == [(20261025, 2), (20261025, 2)] and h.schema.simpleString() == HOURLY.simpleString()


@pytest.mark.parametrize(
    ("values", "flag"),
    [((395, 0, 396), True), ((395, 346, 396), False), ((395, 0, 384), False), ((100, 160, 110), True), ((None, 0, None), True), ((100, 50, 110), True), ((5, None, 5), False)],
)
def test_glitches(spark, values, flag):
    r = spark.createDataFrame([("s", "A", at(5 * i), dt.date(2026, 9, 28), 840, n, "numeric" if n is not None else "open") for i, n in enumerate(values)], "source_id string, facility string, reading_at timestamp, reading_date date, reading_minute_of_day int, available_spaces int, status string")
    r = r.withColumn("ingested_at", F.col("reading_at"))
    f = r.select("source_id", "facility", "reading_at", "ingested_at")
    dim = spark.createDataFrame([("A", 1, 400)], "facility_name string, facility_key int, capacity int")
    a = facts.availability(r, f, dim, periods(spark), Glitch(10, 50)).orderBy("valid_from").collect()
    assert [x["is_source_glitch"] for x in a] == [False, flag, False]
    assert a[-1]["valid_to"] is None and a[0]["duration_minutes"] == 5.0 and a[0]["time_key"] == 1400
    assert not any(x["is_source_glitch"] for x in facts.availability(r, f, dim, periods(spark), None).collect())


def test_unknown_facility_is_minus_one(spark):
    r = spark.createDataFrame([("s", "B", at(0), dt.date(2026, 9, 28), 840, 3, "numeric")], "source_id string, facility string, reading_at timestamp, reading_date date, reading_minute_of_day int, available_spaces int, status string")
    r = r.withColumn("ingested_at", F.col("reading_at"))
    f = r.select("source_id", "facility", "reading_at", "ingested_at")
    dim = spark.createDataFrame([], "facility_name string, facility_key int, capacity int")
    assert facts.availability(r, f, dim, periods(spark)).first()["facility_key"] == -1


def test_calendar(spark):
    d = {x["date"]: x for x in calendar.dim_date(spark).where("year in (2021, 2026, 2027, 2032)").collect()}
    x = d[dt.date(2021, 1, 1)]
    assert (x["iso_year"], x["iso_week"], x["weekday_number"], x["holiday_name"]) == (2020, 53, 5, "Første nyttårsdag")
    assert d[dt.date(2027, 5, 17)]["holiday_name"] == "Grunnlovsdag, Andre pinsedag" == d[dt.date(2032, 5, 17)]["holiday_name"]
    assert d[dt.date(2026, 4, 5)]["holiday_name"] == "Første påskedag" and not d[dt.date(2026, 4, 7)]["is_public_holiday"]
    t = {x["minute_of_day"]: x for x in calendar.dim_time(spark).collect()}
    assert len(t) == 1440 and (t[839]["time_key"], t[839]["quarter_hour"], t[839]["day_part"]) == (1359, "13:45", "midday")


def priced(spark, avg, hour, weekday_utc=T0, cap=100, base=40.0, rules=None, **over):
    h = spark.createDataFrame([(1, weekday_utc.replace(hour=hour - 2), 20260930, hour, avg, 5, over.get("top", 80), 1, over.get("covered", 60.0), 60.0, over.get("stale", 0.0))], HOURLY)
    dim = spark.createDataFrame([(1, "A", cap)], "facility_key int, facility_name string, capacity int")
    tariff = spark.createDataFrame([("A", d, x, base) for d in range(1, 8) for x in range(24)] if base else [], "facility string, weekday_number int, hour int, base_price double")
    return pricing.suggested_prices(h, dim, tariff, rules or pricing.Rules()).first()


def test_prices(spark):
    wed = dt.datetime(2026, 9, 30, 12, tzinfo=UTC)
    x = priced(spark, 60.0, 12, wed)
    assert (x["band"], x["suggested_price"], x["applied_rule"]) == ("low", 32.0, "occupancy:low")
    x = priced(spark, 5.0, 7, wed)
    assert (x["band"], x["suggested_price"], x["applied_rule"]) == ("high", 55.0, "occupancy:high rush:morning") and x["multiplier"] == pytest.approx(1.375)
    x = priced(spark, 0.0, 12, wed, base=60.0, rules=pricing.Rules(bands=(("high", None, 3.0),), rush=()))
    assert (x["suggested_price"], x["applied_rule"]) == (90.0, "occupancy:high (capped at the maximum)")
    assert priced(spark, 0.0, 12, wed, base=26.0)["suggested_price"] == 32.0  # 32.5, half to even
    assert priced(spark, None, 12, wed)["status"] == "no_data" == priced(spark, 5.0, 12, wed, covered=29.0)["status"] == priced(spark, 5.0, 12, wed, cap=0)["status"]
    assert priced(spark, 5.0, 12, wed, stale=31.0)["status"] == "stale" and priced(spark, 5.0, 12, wed, stale=30.0)["status"] == "priced"
    x = priced(spark, 5.0, 12, wed, base=None)
    assert (x["status"], x["applied_rule"], x["suggested_price"], x["band"]) == ("no_tariff", "no_tariff", None, "high")
    x = priced(spark, 40.0, 12, wed, cap=None)
    assert (x["capacity"], x["capacity_is_estimated"], x["occupancy"]) == (80, True, 0.5)


def test_price_rules_report_all_problems(spark):
    with pytest.raises(pricing.PricingError) as e:
        pricing.Rules(bands=(("a", 0.5, 0.0), ("b", 0.4, 1.0)), min_multiplier=2.0, rush=(("m", (1,), 7, 9, 1.0), ("n", (1,), 8, 9, 1.0)))
    assert str(e.value).count(";") >= 3
    with pytest.raises(pricing.PricingError):
        pricing.tariffs(spark, [{"facility": "A", "periods": [{"from": "07:00", "to": "24:00", "price": 1}]}])
    week = pricing.tariffs(spark, [{"facility": "A", "periods": [{"weekdays": ["fri"], "from": "11:00", "to": "12:00", "price": 30}, {"from": "00:00", "to": "24:00", "price": 20}]}])
    assert week.count() == 168 and week.where("weekday_number = 5 and hour = 11").first()["base_price"] == 60.0


def test_keys_and_merge(spark):
    old = spark.createDataFrame([(-1, facility.UNKNOWN, True), (1, "A", True), (2, "B", True)], "facility_key int, facility_name string, is_active boolean")
    new = spark.createDataFrame([("A", T0, True), ("D", T0, True), ("C", T0, False), ("E", T0 - dt.timedelta(1), True)], "facility_name string, first_seen timestamp, is_active boolean")
    new = new.selectExpr("*", "cast(null as decimal(10,7)) latitude", "cast(null as decimal(10,7)) longitude", "cast(null as int) capacity", "cast(null as timestamp) capacity_changed_at", "cast(null as long) register_id", "cast(null as timestamp) last_seen")
    full = facility.dim_facility(new, old.selectExpr("*", "cast(null as decimal(10,7)) latitude", "cast(null as decimal(10,7)) longitude", "cast(null as int) capacity", "cast(null as timestamp) capacity_changed_at", "cast(null as long) register_id", "cast(null as timestamp) first_seen", "cast(null as timestamp) last_seen"))
    assert {x["facility_name"]: (x["facility_key"], x["is_active"]) for x in full.collect()} == {facility.UNKNOWN: (-1, False), "A": (1, True), "B": (2, False), "E": (3, True), "C": (4, False), "D": (5, True)}
    assert full.schema.simpleString() == FACILITY.simpleString()


def test_register(spark):
    rows = [
        ("1", '{"navn":"P","antallAvgiftsbelagtePlasser":390,"sistEndret":"2024-02-16T00:00:00Z"}', None),
        ("2", '{"antallAvgiftsbelagtePlasser":390.0,"antallLadeplasser":true,"antallAvgiftsfriePlasser":"390","antallForflytningshemmede":-1,"sistEndret":"2024-02-16T00:00:00"}', '{"deaktivertTidspunkt":"2025-01-01T00:00:00+01:00"}'),
        ("x", "null", None), (None, "[1]", None), ("3", None, None),
    ]
    df = spark.createDataFrame([("r", "f", i, T0, *r) for i, r in enumerate(rows)], "source_id string, raw_file string, record_index int, ingested_at timestamp, id string, aktivVersjon string, deaktivert string")
    areas, q = register.parse_areas(df)
    assert areas.schema.simpleString() == AREA.simpleString()
    assert [(x["register_id"], x["paid_spaces"], x["deactivated_at"] is not None) for x in areas.orderBy("register_id").collect()] == [(1, 390, False), (2, None, True), (3, None, False)]
    got = {(x["record_index"], x["field"].split(".")[-1], x["raw_value"], x["reason"]) for x in q.collect()}
    assert {(1, "antallAvgiftsbelagtePlasser", "390.0", "not_a_count"), (1, "antallLadeplasser", "true", "not_a_count"), (1, "antallForflytningshemmede", "-1", "not_a_count"), (1, "sistEndret", "2024-02-16T00:00:00", "invalid_value"), (2, "id", "x", "invalid_value"), (3, "id", None, "missing_value"), (3, "aktivVersjon", "[1]", "invalid_json"), (4, "aktivVersjon", None, "missing_value")} <= got
    assert not any(r[0] == 2 and r[1] == "aktivVersjon" for r in got)


def test_polling():
    assert polling.mode(["a"] * 5) == "slow" and polling.mode(["a"] * 4) == "fast" == polling.mode(["a"] * 4 + [None]) == polling.mode(["a"] * 4 + ["b"])
    assert polling.is_due(None, T0, 5) and polling.is_due(T0, at(2.5), 5) and not polling.is_due(T0, at(2.4), 5)
    of = lambda rows, *skip: polling.fingerprint(json.dumps(rows), skip)
    assert of([{"a": 1, "b": 2}, {"a": 3}]) == of([{"a": 3}, {"b": 2, "a": 1}]) != of([{"a": 3}])
    assert of([{"a": 1, "t": 5}], "t") == of([{"a": 1, "t": 6}], "t")
    # the stored form
    assert of([{"b": "Ø", "a": {"d": 1, "c": None}}]) == "sha256:" + hashlib.sha256(b'{"a": {"c": null, "d": 1}, "b": "\\u00d8"}').hexdigest()
    assert [polling.fingerprint(x) for x in ("x", "{}", "[1]", '[{"a":1},[]]')] == [None] * 4 and polling.fingerprint("[]") == polling.content_hash(b"")


def test_outage_throttle(spark):
    o = spark.createDataFrame([("s", at(m)) for m in (0, 30, 60, 65, 119, 121)] + [("u", at(5)), ("u", None)], "source_id string, observed_at timestamp")
    got = sorted((r["source_id"], r["m"]) for r in polling.throttled(o).select("source_id", ((F.unix_micros("observed_at") - F.unix_micros(F.lit(at(0)))) / 60_000_000).cast("int").alias("m")).collect())
    assert got == [("s", 0), ("s", 60), ("s", 121), ("u", 5)]


def test_gaps(spark):
    s = spark.createDataFrame([("s", "a", at(0), at(5)), ("s", "b", at(5), at(10)), ("s", "c", at(30), None), ("s", "d", at(90), at(95))], "source_id string, raw_file string, ingested_at timestamp, next_due timestamp")
    g = polling.gaps(s, 2.5, now=at(120).replace(tzinfo=None)).select(F.minute("gap_from").alias("a"), F.minute("gap_to").alias("b")).collect()
    assert sorted((x["a"], x["b"]) for x in g if x["b"] is not None) == [(10, 30)] and len(g) == 2
