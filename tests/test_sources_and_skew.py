"""Several sources of one facility, one facility with most rows, endless outages, keys by ranges, and a crash between two writes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_run import T0, derived, put, record, setup, snapshot

from tidegrain.operators import facility, facts, polling
from tidegrain.plans import measures, run
from tidegrain.schemas import STALE_PERIOD

UTC = dt.timezone.utc
KIND = "source_id string, facility string, reading_at timestamp, ingested_at timestamp, last_fetched_at timestamp, reading_date date, reading_minute_of_day int, available_spaces int, status string"


def readings(spark, rows):
    """rows: source, facility, minute, value (None: open)."""
    at = lambda m: dt.datetime(2026, 1, 30, tzinfo=UTC) + dt.timedelta(minutes=m)
    return spark.createDataFrame([(s, f, at(m), at(m), at(m + 3), at(m).date(), 0, v, "open" if v is None else "numeric") for s, f, m, v in rows], KIND)


def availability(spark, r, glitch=facts.Glitch(10, 50)):
    dim = spark.createDataFrame([("A", 1, 400)], "facility_name string, facility_key int, capacity int")
    return facts.availability(r, r, dim, spark.createDataFrame([], STALE_PERIOD), glitch)


def test_seams_of_months_equal_one_window(spark):
    r = random.Random(1)
    rows = [(r.choice("st"), r.choice("AAAB"), m, r.choice([None, 1, 2, 90])) for m in sorted(r.sample(range(0, 60 * 24 * 100, 30), 300))]
    rows += [("t" if s == "s" else "s", f, m, 7) for s, f, m, _ in rows[:40]]  # two sources at one time
    got = {(x["source_id"], x["facility_key"], x["valid_from"]): (x["valid_to"], x["is_source_glitch"]) for x in availability(spark, readings(spark, rows)).collect()}
    want = {}
    for f in "AB":
        own = sorted((m, s, v) for s, g, m, v in rows if g == f)
        for i, (m, s, v) in enumerate(own):
            nxt, prev = own[i + 1] if i + 1 < len(own) else None, own[i - 1] if i else None
            glitch = False
            if nxt and prev:
                p, n = prev[2], nxt[2]
                glitch = (p is None and n is None and v is not None) or (None not in (p, n, v) and abs(p - n) <= 10 and abs(v - p) >= 50 and abs(v - n) >= 50)
            at = lambda m: dt.datetime(2026, 1, 30) + dt.timedelta(minutes=m)
            want[s, 1 if f == "A" else -1, at(m)] = (nxt and at(nxt[0]), glitch)
    assert got == want and len({k[2].month for k in got}) > 2


def test_no_hour_of_two_sources_has_more_than_its_minutes(spark):
    rows = [("s", "A", m, 10) for m in range(0, 300, 5)] + [("t", "A", m, 20) for m in range(0, 300, 7)]
    h = facts.hourly(availability(spark, readings(spark, rows)), spark.createDataFrame([], STALE_PERIOD)).collect()
    assert [x["covered_minutes"] for x in sorted(h, key=lambda x: x["hour_start"])][:4] == [60.0] * 4
    latest = measures.free_spaces_latest(availability(spark, readings(spark, rows + [("t", "A", 295, 33)])), []).first()[0]
    assert latest == 33  # s and t report at one time, fetched at one time: the greater source


def test_activity_is_per_source(spark):
    f = [("s", "A", 1), ("s", "B", 1), ("s", "A", 2), ("t", "C", 3), ("t", "B", 4), ("t", "D", 4)]
    at = lambda n: T0 + dt.timedelta(minutes=n)
    fetches = spark.createDataFrame([(s, x, at(n), f"{s}{n}", 0, None, None) for s, x, n in f], "source_id string, facility string, ingested_at timestamp, raw_file string, record_index int, latitude double, longitude double")
    areas = spark.createDataFrame([(7, at(0), 0, 5, None, at(-9))], "register_id long, ingested_at timestamp, record_index int, paid_spaces int, deactivated_at timestamp, changed_at timestamp")
    got = facility.attributes(fetches, areas, spark.createDataFrame([("A", 7, 2)], "facility string, register_id long, reserved_spaces int")).collect()
    assert {r["facility_name"]: r["is_active"] for r in got} == {"A": True, "B": True, "C": False, "D": True}
    assert {r["facility_name"]: (r["capacity"], r["capacity_changed_at"] is not None) for r in got if r["capacity"]} == {"A": (7, True)}


@pytest.mark.parametrize("seed", [1, 2])
def test_throttle_equals_a_fold(spark, seed):
    r = random.Random(seed)
    rows = [("s", m) for m in r.sample(range(6000), 2500)] + [("t", m) for m in r.sample(range(20_000), 60)] + [("s", 60), ("s", 0), ("u", 5), ("u", 65)]
    df = spark.createDataFrame([(s, T0 + dt.timedelta(minutes=m)) for s, m in rows + rows[:9]] + [("s", None)], "source_id string, observed_at timestamp")
    want = set()
    for s in "stu":
        last = None
        for m in sorted(m for x, m in rows if x == s):
            if last is None or m - last >= 60:
                want.add((s, (T0 + dt.timedelta(minutes=m)).replace(tzinfo=None)))
                last = m
    got = [tuple(x) for x in polling.throttled(df).collect()]
    assert set(got) == want and len(got) == len(want)


def test_names_are_numbered_in_order_without_one_window(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("n"), F.xxhash64("id").cast("string")).alias("facility_name"), F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("first_seen"))
    old = spark.createDataFrame([("x", 40)], "facility_name string, facility_key int")
    keyed = facility.assign_keys(rows, old)
    assert "SinglePartition" not in facility.numbered(rows, [F.col("facility_name")])._jdf.queryExecution().executedPlan().toString()
    got = sorted(keyed.collect(), key=lambda r: r["facility_key"])
    assert [r["facility_key"] for r in got] == list(range(41, 20_041))
    order = [(r["first_seen"] is not None, r["first_seen"] or 0, r["facility_name"]) for r in got]
    assert order == sorted(order)


def test_a_crash_between_quarantine_and_fetches_loses_nothing(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    snapshot(raw, 0)
    bad = record("A", dt.datetime(2026, 9, 28, 14, 5), "7") | {"Latitude": "1e1"}  # a sound reading with one bad field
    put(raw, T0 + dt.timedelta(minutes=5), [bad, record("", dt.datetime(2026, 9, 28, 14, 5), "7")])  # and a row that is none
    c = setup(spark, raw, tmp_path / "a")
    run.run_bronze(c)

    def dies(table, df):
        raise OSError(table)

    with monkeypatch.context() as m:
        m.setattr(c.store, "append", dies)
        with pytest.raises(OSError, match="silver_parking_fetch"):
            run.run_silver(c)
    assert c.store.read("silver_quarantine").count() == 2
    for _ in range(2):
        run.run_silver(c)
    assert c.store.read("silver_parking_fetch").count() == 3
    q = {(r["field"], r["reading_excluded"]) for r in c.store.read("silver_quarantine").collect()}
    assert q == {("Latitude", False), ("Sted", True)}
    run.run_gold(c)
    before = derived(c.store)
    c.store.insert_if_new("silver_quarantine", c.store.read("silver_quarantine").limit(1).withColumn("reason", F.lit("made up")), ["reason"], "parsed feed")
    run.run_silver(c, rebuild=True)
    assert derived(c.store) == before  # a rebuild replaces what the feed had quarantined
