"""Registered queries: each operator on the driver's tables, with the same in DuckDB SQL where it can say it.

The events table stands for a polled feed: user_id is the facility, ts the time of a reading, value its count. Doubles are
compared as rounded numbers, sums over decimals, as the order of additions differs between engines.
"""

from __future__ import annotations


from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.functions.parse import count_of, decimal_of
from tidegrain.functions.time import date_key, local, with_instants
from tidegrain import scratch
from tidegrain.operators import calendar, checks, facility, facts, polling, pricing, readings
from tidegrain.plans import measures
from tidegrain.schemas import AREA, STALE_PERIOD
from tidegrain.sources import bronze
from tidegrain.sources.store import TableStore

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def store(spark: SparkSession) -> TableStore:
    """An empty table store in the shared scratch folder."""
    return TableStore(spark, scratch.new(spark, "store"))


def ntz(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def feed(spark: SparkSession, d: str) -> DataFrame:
    """events as fetched readings: a fetch follows a reading by 0 to 59 seconds, one raw file a day and type."""
    e = t(spark, d, "events")
    at = F.date_trunc("MINUTE", F.col("ts").cast("timestamp"))
    n = F.floor("value").cast("int")
    return e.select(
        F.lit("events").alias("source_id"), F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("-"), "event_type").alias("raw_file"), F.col("event_id").cast("int").alias("record_index"),
        F.col("ts").cast("timestamp").alias("ingested_at"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("facility"), at.alias("reading_at"), F.to_date(at).alias("reading_date"),
        (F.hour(at) * 60 + F.minute(at)).alias("reading_minute_of_day"), F.lit(0).alias("utc_offset_minutes"), F.lit(False).alias("dst_resolved"), F.lit(None).cast("decimal(10,7)").alias("latitude"), F.lit(None).cast("decimal(10,7)").alias("longitude"),
        F.when(F.col("event_id") % 17 != 0, n).alias("available_spaces"), F.when(F.col("event_id") % 17 == 0, "open").otherwise("numeric").alias("status"),
    )


FEED = """feed AS (SELECT 'events' AS source_id, strftime(ts, '%Y%m%d') || '-' || event_type AS raw_file, CAST(event_id AS INTEGER) AS record_index, ts AS ingested_at,
 'u' || CAST(user_id AS VARCHAR) AS facility, date_trunc('minute', ts) AS reading_at,
 CASE WHEN event_id % 17 <> 0 THEN CAST(floor(value) AS INTEGER) END AS available_spaces, CASE WHEN event_id % 17 = 0 THEN 'open' ELSE 'numeric' END AS status FROM events)"""
FIRST = """won AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY facility, reading_at ORDER BY ingested_at, raw_file, record_index) = 1)"""


@query(f"WITH {FEED}, {FIRST} SELECT facility, reading_at, record_index, available_spaces, status FROM won")
def first_wins_dedup(spark, d):
    r, _ = readings.deduplicate(feed(spark, d))
    return r.select("facility", ntz("reading_at").alias("reading_at"), "record_index", "available_spaces", "status")


@query(
    f"""WITH {FEED}, r AS (SELECT *, CASE WHEN status = 'open' THEN 'Open' ELSE CAST(available_spaces AS VARCHAR) END AS raw_value,
 row_number() OVER w AS rn, first_value(CASE WHEN status = 'open' THEN 'Open' ELSE CAST(available_spaces AS VARCHAR) END) OVER w AS won FROM feed
 WINDOW w AS (PARTITION BY facility, reading_at ORDER BY ingested_at, raw_file, record_index))
 SELECT raw_file, record_index, raw_value, 'conflicting_duplicate' AS reason FROM r WHERE rn > 1 AND raw_value IS DISTINCT FROM won"""
)
def conflicting_values(spark, d):
    _, q = readings.deduplicate(feed(spark, d))
    return q.select("raw_file", "record_index", "raw_value", "reason")


def _source_text(spark: SparkSession, d: str) -> DataFrame:
    """events written as a source would: texts, some of them bad."""
    e, i = t(spark, d, "events"), F.col("event_id")
    wall = F.date_format("ts", "dd.MM.yyyy")
    n = F.when(i % 11 == 0, "Fullt").when(i % 13 == 0, "Open").when(i % 19 == 0, F.concat(F.lit("-"), F.floor("value").cast("string"))).when(i % 23 == 0, "").otherwise(F.floor("value").cast("string"))
    return e.select(
        F.lit("events").alias("source_id"), F.lit("f").alias("raw_file"), i.cast("int").alias("record_index"), F.col("ts").cast("timestamp").alias("ingested_at"),
        F.when(i % 29 == 0, "31.02.2024").otherwise(wall).alias("Dato"), F.when(i % 31 == 0, "").otherwise(F.date_format("ts", "HH:mm")).alias("Klokkeslett"),
        F.when(i % 37 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("Sted"), F.when(i % 41 == 0, "1e1").otherwise(F.lit("58.97218849")).alias("Latitude"), F.lit("5.73").alias("Longitude"), n.alias("Antall_ledige_plasser"),
    )


TEXT = """src AS (SELECT CAST(event_id AS INTEGER) AS record_index, ts AS ingested_at,
 CASE WHEN event_id % 29 = 0 THEN '31.02.2024' ELSE strftime(ts, '%d.%m.%Y') END AS dato, CASE WHEN event_id % 31 = 0 THEN '' ELSE strftime(ts, '%H:%M') END AS klokke,
 CASE WHEN event_id % 37 <> 0 THEN 'u' || CAST(user_id AS VARCHAR) END AS sted, CASE WHEN event_id % 41 = 0 THEN '1e1' ELSE '58.97218849' END AS lat,
 CASE WHEN event_id % 11 = 0 THEN 'Fullt' WHEN event_id % 13 = 0 THEN 'Open' WHEN event_id % 19 = 0 THEN '-' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) WHEN event_id % 23 = 0 THEN '' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS n FROM events),
 typed AS (SELECT *, try_strptime(dato || ' ' || klokke, '%d.%m.%Y %H:%M') AS wall, CASE WHEN n = 'Fullt' THEN 0 WHEN regexp_full_match(n, '[0-9]+') THEN TRY_CAST(n AS INTEGER) END AS spaces FROM src)"""


@query(
    f"""WITH {TEXT} SELECT record_index, sted AS facility, wall - INTERVAL 1 HOUR AS reading_at, CAST(wall AS DATE) AS reading_date, CAST(hour(wall) * 60 + minute(wall) AS SMALLINT) AS reading_minute_of_day,
 CAST(60 AS SMALLINT) AS utc_offset_minutes, CASE WHEN regexp_full_match(lat, '[+-]?[0-9]+([.][0-9]+)?') THEN CAST(lat AS DECIMAL(10,7)) END AS latitude, spaces AS available_spaces,
 CASE WHEN spaces IS NOT NULL THEN 'numeric' WHEN n = 'Open' THEN 'open' ELSE 'unknown' END AS status FROM typed WHERE wall IS NOT NULL AND sted IS NOT NULL"""
)
def typed_parse_readings(spark, d):
    r, _ = readings.parse_readings(_source_text(spark, d))
    return r.select("record_index", "facility", ntz("reading_at").alias("reading_at"), "reading_date", "reading_minute_of_day", "utc_offset_minutes", "latitude", "available_spaces", "status")


@query(
    f"""WITH {TEXT} SELECT record_index, 'Dato Klokkeslett' AS field, dato || ' ' || klokke AS raw_value, CASE WHEN klokke = '' THEN 'missing_value' ELSE 'invalid_date_time' END AS reason FROM typed WHERE wall IS NULL
 UNION ALL SELECT record_index, 'Sted', sted, 'missing_value' FROM typed WHERE sted IS NULL
 UNION ALL SELECT record_index, 'Latitude', lat, 'not_a_decimal' FROM typed WHERE lat = '1e1'
 UNION ALL SELECT record_index, 'Antall_ledige_plasser', n, CASE WHEN n = '' THEN 'missing_value' ELSE 'not_a_count' END FROM typed WHERE spaces IS NULL AND n <> 'Open'"""
)
def parse_quarantine(spark, d):
    _, q = readings.parse_readings(_source_text(spark, d))
    return q.select("record_index", "field", "raw_value", "reason")


@query("SELECT event_id, CAST(strftime(ts + INTERVAL 1 HOUR, '%Y%m%d') AS INTEGER) AS date_key, CAST(hour(ts + INTERVAL 1 HOUR) AS INTEGER) AS hour, CAST(isodow(ts + INTERVAL 1 HOUR) AS INTEGER) AS weekday_number, ts AS back FROM events")
def local_time_parts(spark, d):
    e = t(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp")).withColumn("wall", local(F.col("at"), "Europe/Oslo"))
    e = with_instants(e, "wall", "Europe/Oslo", "at", "back", "twice")
    return e.select("event_id", date_key(F.col("wall")).alias("date_key"), F.hour("wall").alias("hour"), (F.weekday("wall") + 1).alias("weekday_number"), ntz("back").alias("back"))


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot per event type and hour, fetched at the hour's last event; a type's source stands still for the odd six hours."""
    e = t(spark, d, "events").withColumn("h", F.date_trunc("HOUR", F.col("ts").cast("timestamp")))
    six = F.date_trunc("DAY", "h") + F.make_dt_interval(F.lit(0), (F.hour("h") / 6).cast("int") * 6)
    shown = F.when((F.hour("h") / 6).cast("int") % 2 == 1, six).otherwise(F.max("ts").cast("timestamp"))
    per = e.groupBy("event_type", "h").agg(F.max("ts").cast("timestamp").alias("ingested_at"), shown.alias("reading_at"))
    return per.select(F.col("event_type").alias("source_id"), F.date_format("h", "yyyyMMddHH").alias("raw_file"), "ingested_at", "reading_at")


SNAP = """snap AS (SELECT event_type AS source_id, strftime(date_trunc('hour', ts), '%Y%m%d%H') AS raw_file, max(ts) AS ingested_at,
 CASE WHEN (hour(date_trunc('hour', ts)) // 6) % 2 = 1 THEN date_trunc('day', date_trunc('hour', ts)) + to_hours(CAST((hour(date_trunc('hour', ts)) // 6) * 6 AS BIGINT)) ELSE max(ts) END AS reading_at
 FROM events GROUP BY event_type, date_trunc('hour', ts)), fresh AS (SELECT *, round((epoch_us(ingested_at) - epoch_us(reading_at)) // 1000000 / 60.0, 6) AS age_minutes,
 (epoch_us(ingested_at) - epoch_us(reading_at)) // 1000000 / 60.0 > 15 AS is_stale FROM snap)"""


@query(f"WITH {SNAP} SELECT source_id, raw_file, ingested_at, reading_at AS source_reading_at, age_minutes, is_stale FROM fresh")
def snapshot_freshness(spark, d):
    f = readings.freshness(snapshots(spark, d))
    return f.select("source_id", "raw_file", ntz("ingested_at").alias("ingested_at"), ntz("source_reading_at").alias("source_reading_at"), F.round("age_minutes", 6).alias("age_minutes"), "is_stale")


STALE = f"""{SNAP}, marked AS (SELECT *, CASE WHEN is_stale AND (NOT coalesce(lag(is_stale) OVER w, false) OR lag(reading_at) OVER w IS DISTINCT FROM reading_at) THEN 1 ELSE 0 END AS starts FROM fresh WINDOW w AS (PARTITION BY source_id ORDER BY ingested_at, raw_file)),
 island AS (SELECT *, sum(starts) OVER (PARTITION BY source_id ORDER BY ingested_at, raw_file ROWS UNBOUNDED PRECEDING) AS i, max(ingested_at) OVER (PARTITION BY source_id) AS newest FROM marked),
 period AS (SELECT source_id, min(reading_at) AS source_reading_at, min(reading_at) + INTERVAL 15 MINUTE AS stale_from, min(ingested_at) AS first_stale_fetch_at, max(ingested_at) AS last_stale_fetch_at, CAST(count(*) AS INTEGER) AS fetch_count, bool_or(ingested_at = newest) AS ongoing FROM island WHERE is_stale GROUP BY source_id, i)"""


@query(f"WITH {STALE} SELECT * FROM period")
def stale_periods(spark, d):
    p = readings.stale_periods(readings.freshness(snapshots(spark, d)))
    times = ["source_reading_at", "stale_from", "first_stale_fetch_at", "last_stale_fetch_at"]
    return p.withColumns({c: ntz(c) for c in times})


@query(f"WITH {STALE} SELECT source_id, stale_from, CASE WHEN NOT ongoing THEN last_stale_fetch_at END AS stale_until, CAST(strftime(stale_from + INTERVAL 1 HOUR, '%Y%m%d') AS INTEGER) AS date_key, round((epoch_us(last_stale_fetch_at) - epoch_us(stale_from)) / 60e6, 6) AS duration_minutes FROM period")
def stale_period_fact(spark, d):
    f = facts.stale_fact(readings.stale_periods(readings.freshness(snapshots(spark, d))))
    return f.select("source_id", ntz("stale_from").alias("stale_from"), ntz("stale_until").alias("stale_until"), "date_key", F.round("duration_minutes", 6).alias("duration_minutes"))


def dim(spark: SparkSession, d: str) -> DataFrame:
    """Facilities of the feed: keys by user, capacities 100 to 149, none for every seventh."""
    u = t(spark, d, "events").select("user_id").distinct()
    return u.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("facility_name"), (F.col("user_id") + 1).cast("int").alias("facility_key"), F.when(F.col("user_id") % 7 != 0, F.lit(100) + F.col("user_id") % 50).cast("int").alias("capacity"))


def fact(spark: SparkSession, d: str, glitch: facts.Glitch | None = facts.Glitch(30, 5)) -> DataFrame:
    fetches = feed(spark, d)
    first, _ = readings.deduplicate(fetches)
    return facts.availability(first, fetches, dim(spark, d), no_periods(spark), glitch)


def no_periods(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STALE_PERIOD)


AVAIL = f"""{FEED}, {FIRST}, last AS (SELECT facility, reading_at, max(ingested_at) AS last_fetched_at FROM feed GROUP BY ALL),
 av AS (SELECT CAST(substr(won.facility, 2) AS INTEGER) + 1 AS facility_key, won.reading_at AS valid_from, lead(won.reading_at) OVER w AS valid_to, last_fetched_at, available_spaces, status,
 CASE WHEN CAST(substr(won.facility, 2) AS INTEGER) % 7 <> 0 THEN 100 + CAST(substr(won.facility, 2) AS INTEGER) % 50 END AS capacity,
 coalesce(abs(lag(available_spaces) OVER w - lead(available_spaces) OVER w) <= 30 AND abs(available_spaces - lag(available_spaces) OVER w) >= 5 AND abs(available_spaces - lead(available_spaces) OVER w) >= 5, false)
 OR coalesce(lag(status) OVER w = 'open' AND lead(status) OVER w = 'open' AND status = 'numeric', false) AS glitch
 FROM won JOIN last ON won.facility = last.facility AND won.reading_at = last.reading_at WINDOW w AS (PARTITION BY won.facility ORDER BY won.reading_at))"""


@query(f"WITH {AVAIL} SELECT facility_key, valid_from, valid_to, last_fetched_at, available_spaces, capacity - available_spaces AS occupied_spaces, round((epoch_us(valid_to) - epoch_us(valid_from)) // 1000000 / 60.0, 6) AS duration_minutes, CAST(hour(valid_from) * 100 + minute(valid_from) AS SMALLINT) AS time_key FROM av")
def validity_intervals(spark, d):
    a = fact(spark, d)
    return a.select("facility_key", *[ntz(c).alias(c) for c in ("valid_from", "valid_to", "last_fetched_at")], "available_spaces", "occupied_spaces", F.round("duration_minutes", 6).alias("duration_minutes"), "time_key")


@query(f"WITH {AVAIL} SELECT facility_key, valid_from FROM av WHERE glitch")
def glitch_flags(spark, d):
    return fact(spark, d).where("is_source_glitch").select("facility_key", ntz("valid_from").alias("valid_from"))


HOURLY = f"""{AVAIL}, seg AS (SELECT *, CASE WHEN valid_to IS NULL THEN last_fetched_at ELSE least(valid_to, last_fetched_at + INTERVAL 20 MINUTE) END AS upto FROM av),
 cut AS (SELECT *, unnest(generate_series(date_trunc('hour', valid_from), date_trunc('hour', upto - INTERVAL 1 MICROSECOND), INTERVAL 1 HOUR)) AS hour_start FROM seg WHERE upto > valid_from),
 part AS (SELECT *, (epoch_us(least(upto, hour_start + INTERVAL 1 HOUR)) - epoch_us(greatest(valid_from, hour_start))) AS us, available_spaces IS NOT NULL AND NOT glitch AS counted FROM cut),
 hourly AS (SELECT facility_key, hour_start, CAST(sum(available_spaces * us) FILTER (WHERE counted) AS DOUBLE) / sum(us) FILTER (WHERE counted) AS avg_spaces, min(available_spaces) FILTER (WHERE counted) AS min_spaces, max(available_spaces) FILTER (WHERE counted) AS max_spaces,
 CAST(count(*) AS INTEGER) AS observation_count, sum(us) / 60e6 AS covered_minutes, coalesce(sum(us) FILTER (WHERE counted), 0) / 60e6 AS counted_minutes FROM part GROUP BY ALL)"""


def hours(spark: SparkSession, d: str) -> DataFrame:
    return facts.hourly(fact(spark, d), no_periods(spark), 20)


@query(f"WITH {HOURLY} SELECT facility_key, hour_start, CAST(strftime(hour_start + INTERVAL 1 HOUR, '%Y%m%d') AS INTEGER) AS date_key, round(avg_spaces, 6) AS avg_spaces, min_spaces, max_spaces, observation_count, CAST(round(covered_minutes * 60e6) AS BIGINT) AS covered_us, CAST(round(counted_minutes * 60e6) AS BIGINT) AS counted_us FROM hourly")
def hourly_time_weighted(spark, d):
    h = hours(spark, d)
    return h.select("facility_key", ntz("hour_start").alias("hour_start"), "date_key", F.round("avg_spaces", 6).alias("avg_spaces"), "min_spaces", "max_spaces", "observation_count", F.round(F.col("covered_minutes") * 60e6).cast("long").alias("covered_us"), F.round(F.col("counted_minutes") * 60e6).cast("long").alias("counted_us"))


@query(f"WITH {AVAIL}, l AS (SELECT facility_key, arg_max(coalesce(available_spaces, -1), valid_from) AS v FROM av GROUP BY 1) SELECT CAST(sum(CASE WHEN v >= 0 THEN v END) AS BIGINT) AS free_spaces_latest FROM l")
def latest_semi_additive(spark, d):
    return measures.free_spaces_latest(fact(spark, d), [])


@query(f"WITH {HOURLY}, per AS (SELECT facility_key, hour(hour_start) AS h, sum(avg_spaces * counted_minutes) / sum(CASE WHEN avg_spaces IS NOT NULL THEN counted_minutes END) AS v FROM hourly GROUP BY ALL) SELECT CAST(h AS INTEGER) AS hour_utc, round(sum(v), 4) AS free_spaces_avg FROM per GROUP BY h")
def weighted_avg_measure(spark, d):
    h = hours(spark, d).withColumn("hour_utc", F.hour("hour_start"))
    return measures.free_spaces_avg(h, ["hour_utc"]).select("hour_utc", F.round("free_spaces_avg", 4).alias("free_spaces_avg"))


@query(
    f"""WITH {HOURLY}, per AS (SELECT facility_key, CAST(isodow(hour_start + INTERVAL 1 HOUR) AS INTEGER) AS weekday_number, CAST(hour(hour_start + INTERVAL 1 HOUR) AS INTEGER) AS hour, sum(avg_spaces * counted_minutes) / sum(CASE WHEN avg_spaces IS NOT NULL THEN counted_minutes END) AS v FROM hourly GROUP BY ALL),
 c AS (SELECT *, 100 + (facility_key - 1) % 50 AS capacity FROM per WHERE v IS NOT NULL AND (facility_key - 1) % 7 <> 0) SELECT weekday_number, hour, round(sum(capacity - v) / sum(capacity), 6) AS occupancy FROM c GROUP BY ALL"""
)
def weekday_hour_matrix(spark, d):
    h = hours(spark, d)
    wall = local(F.col("hour_start"), "Europe/Oslo")
    h = h.withColumns({"weekday_number": F.weekday(wall) + 1, "hour": F.hour(wall)})
    return measures.occupancy(h, dim(spark, d), ["weekday_number", "hour"], fresh_only=True).select("weekday_number", "hour", F.round("occupancy_fresh", 6).alias("occupancy"))


@query(f"WITH {HOURLY} SELECT CAST(hour_start AS DATE) AS day, round(sum(covered_minutes), 4) AS covered_minutes FROM hourly GROUP BY 1")
def covered_minutes_by_date(spark, d):
    return measures.coverage(hours(spark, d).withColumn("day", F.to_date("hour_start")), ["day"]).select("day", F.round("covered_minutes", 4).alias("covered_minutes"))


@query(f"WITH {AVAIL} SELECT facility_key, epoch_us(date_trunc('minute', max(last_fetched_at))) // 60000000 - epoch_us(date_trunc('minute', max(valid_from))) // 60000000 AS data_age_minutes, count(*) AS readings FROM av GROUP BY 1")
def data_age_and_readings(spark, d):
    a = fact(spark, d)
    return measures.data_age_minutes(a, ["facility_key"]).join(measures.readings(a, ["facility_key"]), "facility_key")


@query(f"WITH {STALE}, f AS (SELECT source_id, (epoch_us(last_stale_fetch_at) - epoch_us(stale_from)) / 60e6 AS m FROM period) SELECT source_id, count(*) AS incidents, round(sum(m) / 1440, 6) AS stale_days, round(max(m) / 1440, 6) AS longest_days FROM f GROUP BY ROLLUP (source_id)")
def measure_totals(spark, d):
    f = facts.stale_fact(readings.stale_periods(readings.freshness(snapshots(spark, d))))
    r = measures.incidents(f, ["source_id"], totals=True)
    return r.select("source_id", "incidents", F.round("stale_days", 6).alias("stale_days"), F.round("longest_days", 6).alias("longest_days"))


@query("SELECT user_id, arg_max(value, struct_pack(t := ts, i := event_id)) FILTER (WHERE event_type = 'click' OR event_type IS NOT NULL) AS latest_value, min(ts) AS first_seen, max(ts) AS last_seen, bool_or(ts::DATE = (SELECT max(ts)::DATE FROM events)) AS is_active FROM events GROUP BY 1")
def entity_attributes(spark, d):
    e = t(spark, d, "events").select(F.lit("events").alias("source_id"), F.col("user_id").alias("facility"), F.col("ts").alias("ingested_at"), F.date_format("ts", "yyyy-MM-dd").alias("raw_file"), F.col("event_id").alias("record_index"), F.col("value").alias("latitude"), F.col("value").alias("longitude"))
    areas = spark.createDataFrame([], AREA)
    mapping = spark.createDataFrame([], "facility long, register_id long, reserved_spaces int")
    return facility.attributes(e, areas, mapping).select(F.col("facility_name").alias("user_id"), F.col("latitude").alias("latest_value"), "first_seen", "last_seen", "is_active")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate < TIMESTAMP '1996-01-01')")
def incremental_new_rows(spark, d):
    handled = t(spark, d, "lineitem").where("l_shipdate < timestamp_ntz'1996-01-01'").select(F.col("l_orderkey").alias("o_orderkey"))
    return bronze.unhandled(t(spark, d, "orders"), handled, ["o_orderkey"]).select("o_orderkey", "o_custkey")


def _old_new(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = t(spark, d, "customer").select(F.col("c_name").alias("facility_name"), F.col("c_custkey"), F.col("c_acctbal").alias("capacity"), F.lit(True).alias("is_active"))
    old = c.where("c_custkey % 3 <> 0").withColumn("facility_key", (F.col("c_custkey") * 2 + 1).cast("int")).select("facility_key", "facility_name", "capacity", "is_active")
    new = c.where("c_custkey % 5 <> 0").withColumn("capacity", F.col("capacity") + 1).withColumn("first_seen", F.col("c_custkey") % 10)
    return old, new


KEYS = """old AS (SELECT CAST(c_custkey * 2 + 1 AS INTEGER) AS facility_key, c_name AS facility_name, c_acctbal AS capacity FROM customer WHERE c_custkey % 3 <> 0),
 new AS (SELECT c_name AS facility_name, c_acctbal + 1 AS capacity, c_custkey % 10 AS first_seen FROM customer WHERE c_custkey % 5 <> 0),
 keyed AS (SELECT new.*, coalesce(old.facility_key, CAST((SELECT max(facility_key) FROM old) + row_number() OVER (PARTITION BY old.facility_key IS NULL ORDER BY first_seen, new.facility_name) AS INTEGER)) AS facility_key FROM new LEFT JOIN old USING (facility_name))"""


@query(f"WITH {KEYS} SELECT facility_name, facility_key FROM keyed")
def assign_surrogate_keys(spark, d):
    old, new = _old_new(spark, d)
    return facility.assign_keys(new, old).select("facility_name", "facility_key")


@query(f"WITH {KEYS} SELECT coalesce(old.facility_key, keyed.facility_key) AS facility_key, coalesce(old.facility_name, keyed.facility_name) AS facility_name, CASE WHEN keyed.facility_name IS NULL THEN old.capacity ELSE keyed.capacity END AS capacity, keyed.facility_name IS NOT NULL AS is_active FROM old FULL JOIN keyed ON old.facility_name = keyed.facility_name")
def merge_type1(spark, d):
    old, new = _old_new(spark, d)
    return facility.merge_type1(old, facility.assign_keys(new, old).select("facility_key", "facility_name", "capacity", "is_active"))


@query("SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name FROM nation WHERE n_regionkey <> 1 UNION ALL SELECT CAST(n_nationkey + 100 AS INTEGER), upper(n_name) FROM nation WHERE n_regionkey = 1")
def replace_where(spark, d):
    n, st = t(spark, d, "nation"), store(spark)
    new = n.where("n_regionkey = 1").select((F.col("n_nationkey") + 100).cast("int").alias("n_nationkey"), F.upper("n_name").alias("n_name"))
    st.overwrite("nation", n)
    st.replace_where("nation", F.col("n_regionkey") == 1, new)
    return st.read("nation").select("n_nationkey", "n_name")


@query("SELECT o_orderkey, o_orderstatus, o_custkey + CASE WHEN o_orderdate < TIMESTAMP '1995-01-01' THEN 0 ELSE 1000000 END AS customer FROM orders")
def insert_if_new(spark, d):
    """Orders of before 1995 are there; all orders come, each twice and with another customer, and only the others go in."""
    o, st = t(spark, d, "orders"), store(spark)
    st.append("orders", o.where("o_orderdate < timestamp_ntz'1995-01-01'").select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("customer")))
    come = o.select("o_orderkey", "o_orderstatus", (F.col("o_custkey") + 1_000_000).alias("customer"))
    for _ in range(2):
        st.insert_if_new("orders", come.union(come), ["o_orderkey", "o_orderstatus"])
    return st.read("orders")


EASTER = """y AS (SELECT CAST(y AS BIGINT) AS y FROM range(2020, 2036) r(y)), g AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM y),
 h AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM g), l AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM h),
 easter AS (SELECT y, make_date(y, (h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114) // 31, (h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114) % 31 + 1) AS e FROM l),
 hol AS (SELECT make_date(y, m, dd) AS date, n AS name, 0 AS rank FROM easter, (VALUES (1, 1, 'Første nyttårsdag'), (5, 1, 'Offentlig høytidsdag'), (5, 17, 'Grunnlovsdag'), (12, 25, 'Første juledag'), (12, 26, 'Andre juledag')) f(m, dd, n)
 UNION ALL SELECT e + o, n, 1 FROM easter, (VALUES (-7, 'Palmesøndag'), (-3, 'Skjærtorsdag'), (-2, 'Langfredag'), (0, 'Første påskedag'), (1, 'Andre påskedag'), (39, 'Kristi himmelfartsdag'), (49, 'Første pinsedag'), (50, 'Andre pinsedag')) v(o, n)),
 named AS (SELECT date, string_agg(name, ', ' ORDER BY rank) AS holiday_name FROM hol GROUP BY 1)"""


@query(
    f"""WITH {EASTER}, days AS (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2035-12-31', INTERVAL 1 DAY)) AS DATE) AS date)
 SELECT CAST(strftime(days.date, '%Y%m%d') AS INTEGER) AS date_key, days.date, CAST(year(days.date) AS SMALLINT) AS year, CAST(quarter(days.date) AS TINYINT) AS quarter, CAST(month(days.date) AS TINYINT) AS month, monthname(days.date) AS month_name, CAST(day(days.date) AS TINYINT) AS day,
 CAST(isoyear(days.date) AS SMALLINT) AS iso_year, CAST(week(days.date) AS TINYINT) AS iso_week, CAST(isodow(days.date) AS TINYINT) AS weekday_number, dayname(days.date) AS weekday, isodow(days.date) > 5 AS is_weekend, holiday_name IS NOT NULL AS is_public_holiday, holiday_name FROM days LEFT JOIN named ON days.date = named.date"""
)
def dim_date(spark, d):
    return calendar.dim_date(spark)


@query(
    """SELECT CAST(m // 60 * 100 + m % 60 AS SMALLINT) AS time_key, CAST(m AS SMALLINT) AS minute_of_day, CAST(m // 60 AS TINYINT) AS hour, CAST(m % 60 AS TINYINT) AS minute, printf('%02d:%02d', m // 60, m % 60 // 15 * 15) AS quarter_hour, printf('%02d:%02d', m // 60, m % 60) AS time_label,
 CASE WHEN m < 360 THEN 'night' WHEN m < 600 THEN 'morning' WHEN m < 840 THEN 'midday' WHEN m < 1080 THEN 'afternoon' ELSE 'evening' END AS day_part FROM range(1440) r(m)"""
)
def dim_time(spark, d):
    return calendar.dim_time(spark)


def prices(spark: SparkSession, d: str) -> DataFrame:
    week = [{"from": "07:00", "to": "24:00", "price": 20}, {"from": "00:00", "to": "07:00", "price": 10}, {"weekdays": ["fri", "sat"], "from": "11:00", "to": "21:00", "price": 30}]
    return pricing.suggested_prices(hours(spark, d), dim(spark, d), tariff_of_all(spark, d, week), pricing.Rules(min_covered_minutes=5))


def tariff_of_all(spark: SparkSession, d: str, week: list[dict]) -> DataFrame:
    """The week's tariff for every user but each eleventh."""
    grid = pricing.tariffs(spark, [{"facility": "any", "periods": week}]).drop("facility")
    return dim(spark, d).where("(facility_key - 1) % 11 <> 0").select(F.col("facility_name").alias("facility")).crossJoin(F.broadcast(grid))  # 168 rows


@query(
    f"""WITH {HOURLY}, w AS (SELECT h.*, hour_start + INTERVAL 1 HOUR AS wall, max(max_spaces) OVER (PARTITION BY facility_key) AS seen, facility_key - 1 AS u FROM hourly h),
 j AS (SELECT *, CAST(hour(wall) AS TINYINT) AS hour, isodow(wall) AS wd, coalesce(CASE WHEN u % 7 <> 0 THEN 100 + u % 50 END, seen) AS capacity,
 CASE WHEN u % 11 <> 0 THEN CASE WHEN isodow(wall) IN (5, 6) AND hour(wall) BETWEEN 11 AND 20 THEN 60.0 WHEN hour(wall) >= 7 THEN 40.0 ELSE 20.0 END END AS base, CASE WHEN isodow(wall) <= 5 AND hour(wall) IN (7, 8) THEN 'morning' WHEN isodow(wall) <= 5 AND hour(wall) IN (15, 16) THEN 'afternoon' END AS rush FROM w),
 o AS (SELECT *, CASE WHEN capacity <> 0 THEN 1 - avg_spaces / capacity END AS occ FROM j), b AS (SELECT *, CASE WHEN occ < 0.5 THEN 'low' WHEN occ < 0.85 THEN 'normal' ELSE 'high' END AS band, (CASE WHEN occ < 0.5 THEN 0.8::DOUBLE WHEN occ < 0.85 THEN 1.0::DOUBLE ELSE 1.25::DOUBLE END) * CASE WHEN rush IS NULL THEN 1.0::DOUBLE ELSE 1.1::DOUBLE END AS mult,
 CASE WHEN avg_spaces IS NULL OR capacity IS NULL OR occ IS NULL OR covered_minutes < 5 THEN 'no_data' WHEN base IS NULL THEN 'no_tariff' ELSE 'priced' END AS status FROM o)
 SELECT facility_key, hour_start, hour, round(occ, 6) AS occupancy, capacity, band, round(mult, 6) AS multiplier, status, CASE WHEN status = 'priced' THEN round_even(greatest(least(base * mult, base * 1.5), base * 0.5), 0) END AS suggested_price, CASE WHEN status = 'priced' THEN 'occupancy:' || band || CASE WHEN rush IS NULL THEN '' ELSE ' rush:' || rush END ELSE status END AS applied_rule FROM b"""
)
def tiered_price(spark, d):
    p = prices(spark, d)
    return p.select("facility_key", ntz("hour_start").alias("hour_start"), "hour", F.round("occupancy", 6).alias("occupancy"), "capacity", "band", F.round("multiplier", 6).alias("multiplier"), "status", "suggested_price", "applied_rule")


@query(f"WITH {HOURLY}, grid AS (SELECT f.facility_key, h.hour_start FROM (SELECT DISTINCT facility_key FROM hourly) f, (SELECT unnest(generate_series((SELECT min(hour_start) FROM hourly), (SELECT max(hour_start) FROM hourly), INTERVAL 1 HOUR)) AS hour_start) h) SELECT grid.facility_key, grid.hour_start, CAST(round(coalesce(covered_minutes, 0) * 60e6) AS BIGINT) AS covered_us FROM grid LEFT JOIN hourly USING (facility_key, hour_start)")
def coverage_grid(spark, d):
    h = hours(spark, d)
    span = h.agg(F.min("hour_start").alias("first"), F.max("hour_start").alias("last"))
    grid = checks.coverage_grid(h, h.select("facility_key").distinct(), span)
    return grid.select("facility_key", ntz("hour_start").alias("hour_start"), F.round(F.col("covered_minutes") * 60e6).cast("long").alias("covered_us"))


@query("SELECT event_type, ts AS gap_from, nxt AS gap_to FROM (SELECT event_type, ts + INTERVAL 5 MINUTE AS ts, lead(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS nxt FROM events) WHERE nxt > ts + INTERVAL 150 SECOND")
def collection_gaps(spark, d):
    e = t(spark, d, "events").select(F.col("event_type").alias("source_id"), F.col("ts").cast("timestamp").alias("ingested_at"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("raw_file"), (F.col("ts") + F.expr("interval 5 minutes")).cast("timestamp").alias("next_due"))
    return polling.gaps(e).select(F.col("source_id").alias("event_type"), ntz("gap_from").alias("gap_from"), ntz("gap_to").alias("gap_to"))


@query("SELECT event_id, CASE WHEN c = 3 AND a = b THEN 'slow' ELSE 'fast' END AS polling_mode FROM (SELECT event_id, count(CAST(floor(value) AS BIGINT) // 40) OVER w AS c, min(CAST(floor(value) AS BIGINT) // 40) OVER w AS a, max(CAST(floor(value) AS BIGINT) // 40) OVER w AS b FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 2 PRECEDING))")
def polling_mode_replay(spark, d):
    e = t(spark, d, "events").select("event_id", F.col("event_type").alias("source_id"), F.col("ts").cast("timestamp").alias("ingested_at"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("raw_file"), F.expr("cast(floor(value) as bigint) div 40").alias("fingerprint"))
    return polling.replay(e, unchanged=3).select("event_id", "polling_mode")


@query(f"""WITH r AS (SELECT event_type, date_trunc('hour', ts) AS h, '{{"id": ' || CAST(event_id AS VARCHAR) || ', "type": "' || event_type || '"}}' AS line FROM events)
 SELECT event_type, h, 'sha256:' || sha256(string_agg(line, chr(10) ORDER BY line)) AS fingerprint FROM r GROUP BY ALL""")
def values_fingerprint(spark, d):
    """A payload for each event type and hour, as a feed would send it, with a field that doesn't count."""
    e = t(spark, d, "events").withColumn("h", F.date_trunc("HOUR", "ts"))
    payload = F.to_json(F.collect_list(F.struct(F.col("event_type").alias("type"), F.col("event_id").alias("id"), F.col("value").alias("Klokkeslett"))))
    return e.groupBy("event_type", "h").agg(payload.alias("payload")).select("event_type", ntz("h").alias("h"), polling.fingerprints(F.col("payload"), ("Klokkeslett",)).alias("fingerprint"))


@query("SELECT CASE WHEN o_totalprice > 100000 THEN 'over' ELSE 'within' END AS result, o_orderstatus AS subject, count(*) AS n FROM orders GROUP BY ALL")
def quality_free_exceeds_capacity(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderstatus").alias("facility"), F.ceil("o_totalprice").cast("int").alias("available_spaces"), F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"))
    names = o.select(F.col("facility").alias("facility_name")).distinct()
    r = checks.per_facility(o, names.withColumn("capacity", F.lit(100_000)), names.withColumnRenamed("facility_name", "facility")).where("check = 'free_exceeds_capacity'")
    return r.groupBy(F.when(F.col("passed"), "within").otherwise("over").alias("result"), "subject").agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n, (epoch_us(max(ts)) - epoch_us(min(ts))) // 60000000 AS span_minutes FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR GROUP BY 1")
def quality_last_day_counts(spark, d):
    e = t(spark, d, "events")
    r = checks.recent(e, "ts", e.agg(F.max("ts").alias("until")))
    return r.groupBy("event_type").agg(F.count("*").alias("n"), F.expr("(unix_micros(cast(max(ts) as timestamp)) - unix_micros(cast(min(ts) as timestamp))) div 60000000").alias("span_minutes"))


@query("SELECT CAST(count(*) FILTER (WHERE regexp_full_match(n, '-[0-9]+')) AS BIGINT) AS negative, CAST(count(*) FILTER (WHERE NOT regexp_full_match(n, '-?[0-9]+')) AS BIGINT) AS other FROM (SELECT CASE WHEN event_id % 19 = 0 THEN '-' || CAST(event_id AS VARCHAR) WHEN event_id % 23 = 0 THEN 'x' ELSE CAST(event_id AS VARCHAR) END AS n FROM events)")
def quality_negative_counts(spark, d):
    i = F.col("event_id")
    n = F.when(i % 19 == 0, F.concat(F.lit("-"), i.cast("string"))).when(i % 23 == 0, "x").otherwise(i.cast("string"))
    q = t(spark, d, "events").select(n.alias("raw_value"), F.lit("f").alias("raw_file"), F.lit("n").alias("field")).where(count_of(F.col("raw_value")).isNull())
    r = checks.quarantined(q, spark.range(1).select(F.lit("f").alias("newest")), "n")
    of = lambda name: F.max(F.when(F.col("check") == name, F.col("detail").cast("bigint")))
    return r.agg(of("negative_available_spaces").alias("negative"), of("quarantined_values").alias("other"))


@query("SELECT p_partkey, CASE WHEN regexp_full_match(s, '[0-9]+') THEN TRY_CAST(s AS INTEGER) END AS as_count, CASE WHEN regexp_full_match(s, '[+-]?[0-9]+([.][0-9]+)?') THEN TRY_CAST(s AS DECIMAL(10,7)) END AS as_decimal FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN ' 12' WHEN 1 THEN '12.5' WHEN 2 THEN '99999999999' WHEN 3 THEN '-3' WHEN 4 THEN CAST(p_size AS VARCHAR) END AS s FROM part)")
def guarded_casts(spark, d):
    k = F.col("p_partkey") % 6
    s = F.when(k == 0, " 12").when(k == 1, "12.5").when(k == 2, "99999999999").when(k == 3, "-3").when(k == 4, F.col("p_size").cast("string"))
    return t(spark, d, "part").select("p_partkey", s.alias("s")).select("p_partkey", count_of(F.col("s")).alias("as_count"), decimal_of(F.col("s")).alias("as_decimal"))


