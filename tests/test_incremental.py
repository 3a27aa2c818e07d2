"""What a load doesn't touch isn't written anew, and what a run that died left out is."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tidegrain import scratch
from tidegrain.operators.readings import FeedSpec
from tidegrain.plans import daily, run
from tidegrain.sources.store import TableStore

NOON = dt.datetime(2024, 1, 10, 12, tzinfo=dt.timezone.utc)


def bronze(spark, rows):
    own = [("feed", f"f{i}", i, NOON + dt.timedelta(minutes=i), {"Dato": "10.01.2024", "Klokkeslett": "12:30", "Sted": s, "Latitude": "58.9", "Longitude": "5.7", "Antall_ledige_plasser": n}) for i, s, n in rows]
    return spark.createDataFrame(own, "source_id string, raw_file string, record_index int, ingested_at timestamp, fields map<string,string>")


def test_readings_are_derived_only_from_new_fetches(spark, tmp_path):
    st = TableStore(spark, str(tmp_path))
    c = run.Setup(st, "")
    st.append(c.bronze, bronze(spark, [(0, "A", "5"), (1, "A", "6"), (2, "B", "x")]))
    first = run.run_silver(c)
    assert (first["conflicts"], first["readings"], first["quarantined"], first["excluded"]) == (1, 2, 1, 0)
    n = st.versions("silver_parking_reading")
    again = run.run_silver(c)
    assert st.versions("silver_parking_reading") == n and (again["conflicts"], again["readings"]) == (1, 2)
    # a run that died once the fetches were there
    typed, _ = run.readings.parse_readings(run.bronze.widen(bronze(spark, [(3, "C", "7"), (4, "C", "8")]), FeedSpec().fields))
    st.append("silver_parking_fetch", typed)
    died = run.run_silver(c)
    assert len(st.versions("silver_parking_reading")) == len(n) + 1 and (died["conflicts"], died["readings"]) == (2, 3)
    q = st.read("silver_quarantine").where(F.col("reason") == run.CONFLICT)
    assert sorted((r["raw_file"], r["field"], r["raw_value"]) for r in q.collect()) == [("f1", "Antall_ledige_plasser", "6"), ("f4", "Antall_ledige_plasser", "8")]


def test_days_are_written_once(spark, tmp_path, monkeypatch):
    days, saved = daily.Days(spark, str(tmp_path)), []
    monkeypatch.setattr(scratch, "save", lambda df, name: saved.append(name))
    d = [dt.date(2024, 1, n) for n in (1, 2, 3)]
    schema = spark.createDataFrame([], "v int").schema
    days.swap("t", spark.createDataFrame([(1, d[0]), (2, d[1])], "v int, day date"), d)
    kept = os.listdir(tmp_path / "t/day=2024-01-01")
    days.swap("t", days.read("t", schema).where("v = 2").selectExpr("v + 1 as v", "date'2024-01-03' as day"), d[1:])
    assert sorted(map(tuple, days.read("t", schema).collect())) == [(1, d[0]), (3, d[2])]
    assert os.listdir(tmp_path / "t/day=2024-01-01") == kept and not saved and not os.listdir(tmp_path / "_aside")
