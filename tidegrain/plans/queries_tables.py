"""Registered queries of the table store, raw files, the register, clock changes and incremental runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.functions.time import with_instants
from tidegrain.operators import checks, polling, readings, register
from tidegrain.plans import run
from tidegrain.plans.queries import TEXT, _source_text, ntz, query, store, t
from tidegrain.schemas import READING, SNAPSHOT
from tidegrain.sources import bronze

# --- tables


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS price, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS priority FROM orders")
def append_merges_schemas(spark, d):
    """Three appends, the later ones with a column more each; an empty one adds nothing."""
    o, st = t(spark, d, "orders"), store(spark)
    some = lambda s, *c: o.where(F.col("o_orderstatus") == s).select("o_orderkey", "o_custkey", *c)
    price, priority = F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority")
    st.append("orders", some("F"))
    st.append("orders", some("x", price))
    st.append("orders", o.where("o_orderstatus not in ('F', 'O')").select("o_orderkey", "o_custkey", price))
    st.append("orders", some("O", price, priority))
    return st.read("orders")


@query("SELECT o_orderstatus, count(*) AS n, 2 AS versions, 1 AS folders FROM orders GROUP BY 1")
def compact_and_vacuum(spark, d):
    """An append for each status, compacted; old versions and folders go, all rows stay."""
    o, st = t(spark, d, "orders"), store(spark)
    for s in ("F", "O", "P"):
        st.append("orders", o.where(F.col("o_orderstatus") == s))
    st.compact("orders")
    st.append("orders", o.limit(0))  # adds no version
    st.overwrite("orders", st.read("orders"))
    st.vacuum("orders", 0, force=True, now=st.manifest("orders", st.versions("orders")[-2])["at"] + 0.001)
    m = st.manifest("orders")
    return st.read("orders").groupBy("o_orderstatus").agg(F.count("*").alias("n")).withColumns({"versions": F.lit(len(st.versions("orders"))), "folders": F.lit(len(m["dirs"]))})


@query("SELECT 1 AS version, count(*) AS n FROM nation WHERE n_regionkey < 2 UNION ALL SELECT 2, count(*) FROM nation UNION ALL SELECT 3, count(*) FROM region")
def time_travel(spark, d):
    n, st = t(spark, d, "nation"), store(spark)
    st.append("t", n.where("n_regionkey < 2").select("n_name"))
    st.append("t", n.where("n_regionkey >= 2").select("n_name"))
    st.overwrite("t", t(spark, d, "region").select(F.col("r_name").alias("n_name")))
    each = [st.read("t", v).agg(F.lit(v).alias("version"), F.count("*").alias("n")) for v in st.versions("t")]
    return each[0].union(each[1]).union(each[2])


@query("SELECT o_orderkey, 'a' AS tag FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderstatus <> 'F'")
def replace_tagged(spark, d):
    """Rows under a tag are replaced twice; other rows stay in the files that they are in."""
    o, st = t(spark, d, "orders"), store(spark)
    own = lambda where, tag: o.where(where).select("o_orderkey", F.lit(tag).alias("tag"))
    st.append("q", own("o_orderstatus = 'F'", "a"))
    st.replace_tagged("q", "b", own("true", "old"))
    st.replace_tagged("q", "b", own("o_orderstatus <> 'F'", "new"))
    return st.read("q")


@query("SELECT 'nation' AS table_name, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'missing', 0")
def table_registry(spark, d):
    """The tables that are there, as views; one that isn't there reads as empty."""
    st = store(spark)
    for name in ("region", "nation"):
        st.overwrite(name, t(spark, d, name))
    names = [n for n in st.tables() if st.exists(n)]
    empty = st.read_or_empty("missing", READING).agg(F.lit("missing").alias("table_name"), F.count("*").alias("n"))
    for name in names:
        empty = st.read(name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n")).union(empty)
    return empty


# --- raw files


def raw_files(spark: SparkSession, d: str) -> DataFrame:
    """Orders as raw files, one a day, with a sidecar each but for some; some hold no list, none, or no JSON at all."""
    o = t(spark, d, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy/MM/dd"))
    fields = F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.struct("o_custkey").alias("nested"), F.when(F.col("o_custkey") % 2 == 0, F.lit(True)).alias("flag"))
    per = o.groupBy("day").agg(F.to_json(F.sort_array(F.collect_list(fields))).alias("list"), F.min("o_orderdate").alias("at"))
    k = F.day("at")
    body = F.when(k == 3, F.lit("<html>")).when(k == 4, F.lit('{"a": 1}')).when(k == 5, F.lit("[]")).when(k == 6, F.lit("[1]")).otherwise(F.col("list"))
    raw = per.select(F.concat("day", F.lit("/120000.json")).alias("path"), body.alias("value"))
    side = F.when(k == 2, F.lit("{")).otherwise(F.concat(F.lit('{"ingested_at": "'), F.date_format("at", "yyyy-MM-dd'T'12:00:00"), F.lit('Z", "run_id": "r"}')))
    return raw.union(per.where(k != 1).select(F.concat("day", F.lit("/120000.meta.json")), side))


FILES = "o AS (SELECT *, strftime(o_orderdate, '%Y/%m/%d') || '/120000.json' AS raw_file, day(o_orderdate) AS k FROM orders)"


@query(f"""WITH {FILES} SELECT raw_file, CASE any_value(k) WHEN 1 THEN 'missing_sidecar' WHEN 2 THEN 'unreadable_sidecar' WHEN 5 THEN 'no_records' ELSE 'unreadable_payload' END AS reason,
 CASE any_value(k) WHEN 1 THEN replace(raw_file, '.json', '.meta.json') WHEN 2 THEN 'ingested_at: none' WHEN 5 THEN '0 records' ELSE 'no list of objects' END AS detail FROM o WHERE k <= 6 GROUP BY raw_file""")
def load_issues(spark, d):
    return bronze.classify(raw_files(spark, d), "orders").where("reason is not null").select("raw_file", "reason", "detail")


@query(
    f"""WITH {FILES} SELECT raw_file, CAST(row_number() OVER (PARTITION BY raw_file ORDER BY o_orderkey) - 1 AS INTEGER) AS record_index, date_trunc('day', o_orderdate) + INTERVAL 12 HOUR AS ingested_at, 'r' AS run_id, CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS status,
 '{{"o_custkey":' || o_custkey || '}}' AS nested, CASE WHEN o_custkey % 2 = 0 THEN 'true' END AS flag, CAST(NULL AS VARCHAR) AS absent FROM o WHERE k > 6"""
)
def bronze_rows(spark, d):
    sound = bronze.classify(raw_files(spark, d), "orders").where("reason is null")
    b = bronze.widen(bronze.rows(sound), ["key", "status", "nested", "flag", "absent"])
    return b.select("raw_file", "record_index", ntz("ingested_at").alias("ingested_at"), "run_id", "key", "status", "nested", "flag", "absent")


@query("SELECT strftime(ts, '%Y%m%d') || '-' || event_id || '.json' AS raw_file, event_type AS source_id, ts AS observed_at, CAST(500 + event_id % 5 AS INTEGER) AS http_status FROM events WHERE event_id % 7 <> 0 AND event_id % 9 <> 0")
def outage_records(spark, d):
    """Each event as an outage file; some have no status, some no time."""
    i = F.col("event_id")
    record = F.struct(F.when(i % 7 != 0, F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("observed_at"), F.when(i % 9 != 0, (500 + i % 5).cast("string")).otherwise("none").alias("http_status"), F.lit("https://x").alias("source_url"))
    e = t(spark, d, "events").select("event_type", F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("-"), i.cast("string"), F.lit(".json")).alias("path"), F.to_json(record).alias("value"))
    found, _ = bronze.outages(e, "events")
    return found.join(e.select(F.col("path").alias("raw_file"), "event_type"), "raw_file").select("raw_file", F.col("event_type").alias("source_id"), ntz("observed_at").alias("observed_at"), "http_status")


@query(
    """WITH RECURSIVE o AS (SELECT event_type AS source_id, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS n FROM events),
 kept(source_id, ts, n, mark) AS (SELECT source_id, ts, n, ts FROM o WHERE n = 1 UNION ALL SELECT o.source_id, o.ts, o.n, CASE WHEN o.ts >= kept.mark + INTERVAL 24 HOUR THEN o.ts ELSE kept.mark END FROM kept JOIN o ON o.source_id = kept.source_id AND o.n = kept.n + 1)
 SELECT source_id, ts AS observed_at FROM kept WHERE ts = mark"""
)
def outage_throttle(spark, d):
    """At most one record in 24 hours of each source."""
    e = t(spark, d, "events").select(F.col("event_type").alias("source_id"), F.col("ts").cast("timestamp").alias("observed_at"))
    return polling.throttled(e, 24 * 60).select("source_id", ntz("observed_at").alias("observed_at"))


# --- the register


def areas_text(spark: SparkSession, d: str) -> DataFrame:
    """Parts as register rows in bronze's form, some of them bad."""
    k = F.col("p_partkey")
    count = F.when(k % 5 == 0, F.lit("390.0")).when(k % 7 == 0, F.lit("true")).when(k % 11 == 0, F.lit("-1")).when(k % 13 == 0, F.lit('"12"')).otherwise(F.col("p_size").cast("string"))
    changed = F.when(k % 17 == 0, F.lit("2024-02-16T00:00:00")).otherwise("2024-02-16T01:00:00+01:00")
    version = F.concat(F.lit('{"antallAvgiftsbelagtePlasser":'), count, F.lit(',"navn":"'), F.concat(F.lit("n"), k.cast("string")), F.lit('","sistEndret":"'), changed, F.lit('"}'))
    return t(spark, d, "part").select(
        F.lit("register").alias("source_id"), F.lit("f").alias("raw_file"), k.cast("int").alias("record_index"), F.lit("2024-03-01").cast("timestamp").alias("ingested_at"),
        F.when(k % 19 == 0, F.lit("x")).when(k % 23 == 0, F.lit(None)).otherwise(k.cast("string")).alias("id"),
        F.when(k % 29 == 0, F.lit("[1]")).when(k % 31 == 0, F.lit("null")).when(k % 37 == 0, F.lit(None)).otherwise(version).alias(register.VERSION),
        F.when(k % 3 == 0, F.lit('{"deaktivertTidspunkt":"2024-01-01T00:00:00Z"}')).alias(register.DEACTIVATED),
    )


AREAS = """a AS (SELECT p_partkey AS k, p_size, p_partkey % 29 <> 0 AND p_partkey % 31 <> 0 AND p_partkey % 37 <> 0 AS sound,
 CASE WHEN p_partkey % 5 = 0 THEN '390.0' WHEN p_partkey % 7 = 0 THEN 'true' WHEN p_partkey % 11 = 0 THEN '-1' WHEN p_partkey % 13 = 0 THEN '12' END AS bad FROM part)"""


@query(
    f"""WITH {AREAS} SELECT k AS register_id, CASE WHEN sound THEN 'n' || k END AS name, CASE WHEN sound AND bad IS NULL THEN p_size END AS paid_spaces, CASE WHEN sound AND k % 17 <> 0 THEN TIMESTAMP '2024-02-16 00:00:00' END AS changed_at,
 CASE WHEN k % 3 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' END AS deactivated_at FROM a WHERE k % 19 <> 0 AND k % 23 <> 0"""
)
def register_areas(spark, d):
    areas, _ = register.parse_areas(areas_text(spark, d))
    return areas.select("register_id", "name", "paid_spaces", ntz("changed_at").alias("changed_at"), ntz("deactivated_at").alias("deactivated_at"))


@query(
    f"""WITH {AREAS} SELECT CAST(k AS INTEGER) AS record_index, 'id' AS field, CASE WHEN k % 19 = 0 THEN 'x' END AS raw_value, CASE WHEN k % 19 = 0 THEN 'invalid_value' ELSE 'missing_value' END AS reason FROM a WHERE k % 19 = 0 OR k % 23 = 0
 UNION ALL SELECT k, 'aktivVersjon', CASE WHEN k % 29 = 0 THEN '[1]' END, CASE WHEN k % 29 = 0 THEN 'invalid_json' ELSE 'missing_value' END FROM a WHERE k % 29 = 0 OR (k % 37 = 0 AND k % 31 <> 0)
 UNION ALL SELECT k, 'aktivVersjon.antallAvgiftsbelagtePlasser', bad, 'not_a_count' FROM a WHERE sound AND bad IS NOT NULL
 UNION ALL SELECT k, 'aktivVersjon.sistEndret', '2024-02-16T00:00:00', 'invalid_value' FROM a WHERE sound AND k % 17 = 0"""
)
def register_quarantine(spark, d):
    _, q = register.parse_areas(areas_text(spark, d))
    return q.select("record_index", "field", "raw_value", "reason")


# --- clocks


def changes(spark: SparkSession, d: str) -> DataFrame:
    """Wall clocks of the days of both clock changes of 2024, by a minute of the day from the event's number; each fetched an
    hour before or after the second time at which its clock shows so."""
    i = F.col("event_id")
    day = F.when(i % 2 == 0, F.lit("2024-03-31")).otherwise("2024-10-27").cast("timestamp")
    wall = (day + F.make_dt_interval(F.lit(0), F.lit(0), ((i * 7) % 300).cast("int"))).cast("timestamp_ntz")
    fetched = wall.cast("timestamp") - F.expr("interval 1 hour") + F.when(i % 3 == 0, F.expr("interval -30 minutes")).otherwise(F.expr("interval 0 minutes"))
    return t(spark, d, "events").select("event_id", wall.alias("wall"), fetched.alias("fetched"))


@query(
    """WITH w AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-03-31' ELSE TIMESTAMP '2024-10-27' END + to_minutes(event_id * 7 % 300) AS wall, event_id % 3 = 0 AS early FROM events)
 SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CASE WHEN hour(wall) < 2 THEN wall - INTERVAL 1 HOUR WHEN hour(wall) >= 3 THEN wall - INTERVAL 2 HOUR END
 ELSE CASE WHEN hour(wall) < 2 OR (hour(wall) = 2 AND early) THEN wall - INTERVAL 2 HOUR ELSE wall - INTERVAL 1 HOUR END END AS reading_at, CASE WHEN event_id % 2 = 0 AND hour(wall) = 2 THEN NULL ELSE event_id % 2 = 1 AND hour(wall) = 2 END AS had_two FROM w"""
)
def clock_changes(spark, d):
    """The hour that is skipped has no instant; of two the later one counts unless it is after the fetch."""
    e = with_instants(changes(spark, d), "wall", "Europe/Oslo", "fetched", "reading_at", "had_two")
    return e.select("event_id", ntz("reading_at").alias("reading_at"), "had_two")


@query(
    """WITH w AS (SELECT event_id, TIMESTAMP '2024-03-31' + to_minutes(event_id * 7 % 300) AS wall FROM events WHERE event_id % 2 = 0)
 SELECT CAST(event_id AS INTEGER) AS record_index, 'nonexistent_local_time' AS reason, strftime(wall, '%d.%m.%Y %H:%M') AS raw_value FROM w WHERE hour(wall) = 2"""
)
def clock_change_quarantine(spark, d):
    e = changes(spark, d)
    b = e.select(
        F.lit("s").alias("source_id"), F.lit("f").alias("raw_file"), F.col("event_id").cast("int").alias("record_index"), F.col("fetched").alias("ingested_at"), F.date_format("wall", "dd.MM.yyyy").alias("Dato"), F.date_format("wall", "HH:mm").alias("Klokkeslett"),
        F.lit("A").alias("Sted"), F.lit("58.9").alias("Latitude"), F.lit("5.7").alias("Longitude"), F.lit("1").alias("Antall_ledige_plasser"),
    )
    _, q = readings.parse_readings(b)
    return q.select("record_index", "reason", "raw_value")


# --- incremental runs


@query(
    f"""WITH {TEXT}, k AS (SELECT *, wall - INTERVAL 1 HOUR AS reading_at, CASE WHEN spaces IS NOT NULL THEN 'numeric' WHEN n = 'Open' THEN 'open' ELSE 'unknown' END AS status FROM typed WHERE wall IS NOT NULL AND sted IS NOT NULL)
 SELECT sted AS facility, reading_at, record_index, spaces AS available_spaces, status FROM k QUALIFY row_number() OVER (PARTITION BY sted, reading_at ORDER BY ingested_at, record_index) = 1"""
)
def incremental_silver(spark, d):
    """The run's silver step over raw rows that come in two loads, the earlier fetches last, and once more with nothing new: late
    rows take over, no row comes twice, and the result is that of one load."""
    text, st = _source_text(spark, d), store(spark)
    fields = F.create_map(*[x for f in readings.FeedSpec().fields for x in (F.lit(f), F.col(f))])
    b = text.select(*[F.col(c) for c in ("source_id", "raw_file", "ingested_at", "record_index")], fields.alias("fields"))
    c = run.Setup(st, "", "events")
    late = F.col("ingested_at") < F.lit(dt.datetime(2024, 1, 15)).cast("timestamp")
    for part in (b.where(~late), b.where(late), b.limit(0)):
        st.append("bronze_events", part)
        run.run_silver(c)
    return st.read("silver_parking_reading").select("facility", ntz("reading_at").alias("reading_at"), "record_index", "available_spaces", "status")


@query("SELECT severity, \"check\", count(*) AS n FROM (SELECT CASE WHEN event_id % 2 = 0 THEN 'critical' ELSE 'warning' END AS severity, event_type AS \"check\" FROM events) GROUP BY ALL")
def check_report_order(spark, d):
    """Check results in the order of a report: critical ones first, then by check and subject."""
    r = t(spark, d, "events").select(F.when(F.col("event_id") % 2 == 0, "critical").otherwise("warning").alias("severity"), F.col("event_type").alias("check"), F.lit(None).cast("string").alias("subject"))
    return checks.report_order(r.groupBy("severity", "check", "subject").agg(F.count("*").alias("n"))).select("severity", "check", "n")


@query("SELECT event_type AS source_id, ts + INTERVAL 20 MINUTE AS due FROM (SELECT event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def open_gap(spark, d):
    """The gap that is still open: the last snapshot of a source, long due."""
    e = t(spark, d, "events").select(F.col("event_type").alias("source_id"), F.col("ts").cast("timestamp").alias("ingested_at"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("raw_file"), F.col("ts").cast("timestamp").alias("reading_at"))
    e = e.withColumn("next_due", F.col("ingested_at") + F.expr("interval 20 minutes"))
    return polling.gaps(e, now=dt.datetime(2025, 1, 1)).where("gap_to is null").select("source_id", ntz("gap_from").alias("due"))


@query("SELECT count(*) AS n FROM events WHERE false")
def empty_feed(spark, d):
    """No snapshots: no stale periods."""
    return readings.stale_periods(spark.createDataFrame([], SNAPSHOT)).agg(F.count("*").alias("n"))
