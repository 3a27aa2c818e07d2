import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegrain.functions import sql
from tidegrain.functions.time import with_instants
from tidegrain.operators import polling, readings
from tidegrain.plans import measures, queries, queries_levels, queries_reports, totals
from tidegrain.plans.dated import Dated
from tidegrain.schemas import QUARANTINE

SF = "/root/testdata/sf0.001"

scalars = st.one_of(st.none(), st.booleans(), st.integers(-(2**63), 2**63 - 1), st.text(st.characters(exclude_categories=["Cs"])), st.decimals(-9999, 9999, places=4).map(float).filter(lambda x: x == 0 and str(x) == "0.0" or abs(x) >= 0.0001))
snapshots = st.lists(st.dictionaries(st.text(st.characters(exclude_categories=["Cs"]), max_size=3), scalars, max_size=4), max_size=4)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(snapshots, st.booleans()), min_size=20, max_size=40))
def test_fingerprints_equal_the_stored_form(spark, many):
    payloads = [json.dumps(s, ensure_ascii=a) for s, a in many]
    df = spark.createDataFrame(list(enumerate(payloads)), "i int, p string").select("i", polling.fingerprints(F.col("p"), ("a", "\x00")).alias("f"))
    assert [r.f for r in df.orderBy("i").collect()] == [polling.fingerprint(p, ("a", "\x00")) for p in payloads]


def test_fingerprints_that_have_no_value(spark):
    odd = ["x", "{}", "[1]", '[{"b":[1]}]', '[{"b":{}}]', '[{"b":1e5}]', '[{"b":0.00001}]', '[{"b":12345678901234567890}]', '[{"b":1,"b":2}]', '[{"b":"\\ud800"}]', '[{"b":-0.0}]', None, ""]
    df = spark.createDataFrame([(p,) for p in odd], "p string").select(polling.fingerprints(F.col("p")).alias("f"))
    assert [r.f for r in df.collect()] == [None] * len(odd)
    assert "Python" not in queries.QUERIES["values_fingerprint"](spark, SF)._jdf.queryExecution().toString()


def test_wall_clocks_in_sql_equal_the_columns(spark):
    """Hours that clocks skip and repeat, in zones with shifts of an hour and of half an hour."""
    sql.register(spark)
    days = "explode(sequence(timestamp_ntz'{0} 00:00:00', timestamp_ntz'{0} 05:00:00', interval 10 minutes))"
    for zone, day in (("Europe/Oslo", "2024-03-31"), ("Europe/Oslo", "2024-10-27"), ("Australia/Lord_Howe", "2024-04-07"), ("Asia/Kolkata", "2024-04-07")):
        df = spark.range(1).select(F.expr(days.format(day)).alias("wall")).crossJoin(spark.range(0, 12).selectExpr(f"timestamp'{day} 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int) - 6, 15) as seen"))
        own = with_instants(df, "wall", zone, "seen", "at", "twice").selectExpr("at", f"utc_of(wall, '{zone}', seen) as again")
        assert own.count() == 31 * 12 and own.where("not at <=> again").count() == 0


def test_tallies_count_a_row_once(spark):
    rows = [("s", "f", 0, None, "a", "x", "r", True), ("s", "f", 0, None, "b", "x", "r", True), ("s", "f", 1, None, "a", "x", "r", False), ("t", "f", 0, None, "a", None, "r", True)]
    q = spark.createDataFrame(rows, QUARANTINE)
    assert tuple(readings.tallies(q, []).first()) == (4, 3, 2, 2)
    assert tuple(readings.tallies(q.where("false"), []).first()) == (0, 0, 0, 0) and readings.tallies(q.where("false"), ["source_id"]).count() == 0


def test_totals_are_no_sums_and_nulls_are_no_totals(spark):
    rows = [(1, None, "2024-01-01", 5), (1, "b", "2024-01-02", 7), (2, "b", "2024-01-01", None)]
    a = spark.createDataFrame(rows, "facility_key int, kind string, at string, available_spaces int").selectExpr("*", "cast(at as timestamp) valid_from", "cast(at as timestamp) last_fetched_at", "'s' source_id")
    dim = spark.createDataFrame([(1, 10), (2, 20)], "facility_key int, capacity int")
    r = totals.latest_totals(totals.latest_states(a, ["kind"]), dim, ["kind"], [["kind"], []])
    assert {(x.kind, x.level): (x.free_spaces_latest, x.occupancy_latest, x.readings) for x in r.collect()} == {(None, 0): (5, 0.5, 1), ("b", 0): (7, 0.3, 2), (None, 1): (7, 0.3, 3)}


def test_a_page_reads_the_dates_of_its_slicer_and_a_rerun_writes_one(spark, tmp_path):
    kept = Dated(spark, str(tmp_path))
    hours = queries_reports.star(spark, SF)["fact_parking_hourly"].persist()
    kept.write("fact_parking_hourly", hours)
    files = lambda: {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    before = files()
    kept.write("fact_parking_hourly", hours.where("date_key = 20240110"))
    after = files()
    assert {p.parent.name for p in before.keys() ^ after.keys()} == {"date_key=20240110"} and len(after) == len(before)
    assert kept.read("fact_parking_hourly").exceptAll(hours).isEmpty() and kept.read("fact_parking_hourly").count() == hours.count()
    hours.unpersist()

    dates = queries_reports.calendar.dim_date(spark).where("date between '2024-01-05' and '2024-01-07'").select("date_key", "date")
    page = kept.read("fact_parking_hourly").join(dates, "date_key").groupBy("date").count()
    assert "dynamicpruning" in page._jdf.queryExecution().toString()
    page.collect()
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan and "PartitionFilters" in plan


def test_bucketed_fetches_are_not_dealt_again(spark):
    import re

    df = queries_levels.hourly_from_buckets(spark, SF)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.find("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    keys = set(re.findall(r"hashpartitioning\(([^()]*), \d+\)", re.sub(r"#\d+L?", "", plan)))
    assert not {k for k in keys if "reading_at" in k and "facility" in k}, keys
    assert keys <= {"facility", "facility, _part", "facility_key, hour_start", "source_id, source_reading_at", "user_id"}, keys
    assert re.search(r"Bucketed: true|SelectedBucketsCount", plan) and len(rows) > 0


def test_covered_time_of_many_hours_is_exact(spark):
    """Sums of minutes as fractions differ from the whole microseconds by the order in which rows come."""
    us = "1 + pmod(xxhash64(id), 3599999999)"
    h = spark.range(400_000).selectExpr("cast(id % 2 as int) as day", f"({us}) / 60e6 as covered_minutes", f"({us}) div 3 / 60e6 as stale_minutes", "id")
    want = {r[0]: (r[1], r[2]) for r in spark.range(400_000).selectExpr("cast(id % 2 as int) as day", f"{us} as us").groupBy("day").agg(F.sum("us"), F.sum(F.expr("us div 3"))).collect()}
    got = measures.coverage(h, ["day"]).collect()
    assert {r["day"]: (r["covered_us"], r["stale_us"]) for r in got} == want
    assert {r["day"]: r["stale_share"] for r in got} == {d: s / c for d, (c, s) in want.items()}
    share = totals.hourly_states(h.selectExpr("*", "1 as facility_key", "1D as avg_spaces", "1D as counted_minutes"), ["day"])
    assert {r["day"]: (r["covered"], r["stale"]) for r in share.collect()} == want
