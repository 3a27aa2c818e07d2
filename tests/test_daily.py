"""Loads in any order give what one derivation of everything gives, and only the days that they touch are written."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from tidegrain import schemas
from tidegrain.operators import facts, readings
from tidegrain.plans.daily import Facts
from tidegrain.schemas import READING

UTC = dt.timezone.utc
T0 = dt.datetime(2026, 3, 1, tzinfo=UTC)


def fetched(spark, rows):
    """rows: source, minute of the fetch, minutes that the source is late, values of facilities."""
    out = []
    for s, m, late, values in rows:
        at, shown = T0 + dt.timedelta(minutes=m, seconds=20), T0 + dt.timedelta(minutes=m - late)
        out += [(s, f"{m:06d}.json", i, at, f, shown, shown.date(), shown.hour * 60 + shown.minute, 0, False, None, None, v, "open" if v is None else "numeric") for i, (f, v) in enumerate(values.items())]
    return spark.createDataFrame(out, READING)


def whole(fetches, dim):
    periods = readings.stale_periods(readings.freshness(fetches))
    avail = facts.availability(readings.deduplicate(fetches)[0], fetches, dim, periods, facts.Glitch(10, 50))
    return {"availability": avail, "hourly": facts.hourly(avail, periods)}


def same(store, fetches, dim):
    for name, want in whole(fetches, dim).items():
        got = getattr(store, name)().select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


def files(root, table):
    return {d: set(os.listdir(f"{root}/{table}/{d}")) for d in os.listdir(f"{root}/{table}") if d.startswith("day=")}


def test_loads_in_any_order_equal_one_derivation(spark, tmp_path):
    r = random.Random(3)
    rows = []
    for s in "st":
        for m in sorted(r.sample(range(0, 60 * 24 * 6, 40), 60)):
            stuck = 600 < m < 1900  # the source stands still for most of a day
            rows.append((s, m, (m - 600) if stuck else 0, {f: r.choice([None, 5, 6, 90]) for f in r.sample("ABC", 2)}))
    dim = spark.createDataFrame([("A", 1, 100), ("B", 2, 100), ("C", 3, None)], "facility_name string, facility_key int, capacity int")
    store = Facts(spark, str(tmp_path / "t"), facts.Glitch(10, 50))
    r.shuffle(rows)
    parts = [rows[:50], rows[50:75], rows[75:], rows[70:90]]  # the last one repeats rows
    for i, p in enumerate(parts):
        store.update(fetched(spark, p), dim)
    same(store, fetched(spark, rows), dim)


def test_a_late_reading_writes_its_days_only(spark, tmp_path):
    rows = [("s", 24 * 60 * d + m, 0, {"A": 1 + d}) for d in range(12) for m in (0, 5, 700)]
    dim = spark.createDataFrame([("A", 1, 100)], "facility_name string, facility_key int, capacity int")
    store = Facts(spark, str(tmp_path / "t"))
    store.update(fetched(spark, rows), dim)
    before = {t: files(tmp_path / "t", t) for t in ("reading", "availability", "hourly")}
    late = [("s", 24 * 60 * 5 + 350, 0, {"A": 77})]
    wrote = store.update(fetched(spark, late), dim)
    after = {t: files(tmp_path / "t", t) for t in before}
    moved = {t: sorted(d for d in after[t] if after[t][d] != before[t][d]) for t in before}
    assert moved["reading"] == ["day=2026-03-06"] and set(moved["availability"]) <= {f"day=2026-03-0{n}" for n in (5, 6, 7)}
    assert set(moved["hourly"]) <= {f"day=2026-03-0{n}" for n in (5, 6, 7)} and wrote["reading"] == [dt.date(2026, 3, 6)]
    assert "PartitionFilters: [isnotnull(day" in store.readings([dt.date(2026, 3, 6)])._jdf.queryExecution().executedPlan().toString()
    same(store, fetched(spark, rows + late), dim)
    assert store.readings().where(F.col("available_spaces") == 77).count() == 1


def test_runs_that_keep_facts_by_day_equal_full_runs(spark, tmp_path):
    from test_run import record, setup, snapshot, put
    from test_run import T0 as START

    from tidegrain.plans import run

    raw = tmp_path / "raw"
    a, b = setup(spark, raw, tmp_path / "a"), setup(spark, raw, tmp_path / "b")
    a.days_root = str(tmp_path / "days")
    for load in range(2):
        for i in ((0, 2, 3), (1, 5))[load]:
            snapshot(raw, i)
        if load:  # the register's figure comes late: all days of A get another occupancy
            put(raw, START + dt.timedelta(days=1), [record("A", dt.datetime(2026, 9, 29, 14, 0), "7"), record("B", dt.datetime(2026, 9, 29, 14, 0), "8")])
            for c in (a, b):
                c.store.overwrite("silver_parking_area", spark.createDataFrame([("r", "f", 0, START, 1, "A", 400, 0, 0, 0, START, None)], schemas.AREA))
        for c in (a, b):
            assert run.run(c, print) == 0
    for name in ("availability", "hourly"):
        got, want = run.fact(a, name), b.store.read(f"fact_parking_{name}")
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert {r["occupied_spaces"] is None for r in run.fact(a, "availability").collect()} == {True, False}
