"""Registered queries of a feed that stands still at times: facts with stale data, prices, measures, report pages and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.functions.time import local
from tidegrain import scratch
from tidegrain.operators import calendar, checks, facility, facts, pricing, readings
from tidegrain.plans import daily, measures
from tidegrain.plans.queries import EASTER, FEED, FIRST, SNAP, STALE, TEXT, _source_text, dim, feed, ntz, query, snapshots, t, tariff_of_all
from tidegrain.plans.reports import Report
from tidegrain.streaming import islands

# --- facts with stale data


def stalled(spark: SparkSession, d: str) -> DataFrame:
    """events as fetches of one source for each type, which shows the time of six hours ago at most in every second quarter of a day."""
    at = F.col("ts").cast("timestamp")
    quarter = (F.hour(at) / 6).cast("int")
    shown = F.when(quarter % 2 == 1, F.date_trunc("DAY", at) + F.make_dt_interval(F.lit(0), quarter * 6)).otherwise(F.date_trunc("MINUTE", at))
    own = t(spark, d, "events").select(F.col("event_id").cast("int").alias("record_index"), F.col("event_type").alias("_type"), shown.alias("_shown"), F.date_format(at, "yyyyMMddHH").alias("_file"))
    f = feed(spark, d).join(own, "record_index")
    return f.withColumns({"source_id": F.col("_type"), "raw_file": F.col("_file"), "reading_at": F.col("_shown"), "reading_date": F.to_date("_shown"), "reading_minute_of_day": F.hour("_shown") * 60 + F.minute("_shown")}).drop("_type", "_shown", "_file")


def star(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The star schema of the stalled feed, without check results."""
    fetches = stalled(spark, d)
    first, _ = readings.deduplicate(fetches)
    periods = readings.stale_periods(readings.freshness(fetches))
    facilities = dim(spark, d)
    avail = facts.availability(first, fetches, facilities, periods, facts.Glitch(30, 5))
    return {
        "dim_date": calendar.dim_date(spark), "dim_parking_facility": facilities, "fact_parking_availability": avail,
        "fact_parking_hourly": facts.hourly(avail, periods, 20), "fact_source_stale_period": facts.stale_fact(periods), "quality_check_results": results(spark, d),
    }


SFEED = """sfeed AS (SELECT event_type AS source_id, strftime(ts, '%Y%m%d%H') AS raw_file, CAST(event_id AS INTEGER) AS record_index, ts AS ingested_at, 'u' || CAST(user_id AS VARCHAR) AS facility,
 CASE WHEN (hour(ts) // 6) % 2 = 1 THEN date_trunc('day', ts) + to_hours(CAST(hour(ts) // 6 * 6 AS BIGINT)) ELSE date_trunc('minute', ts) END AS reading_at,
 CASE WHEN event_id % 17 <> 0 THEN CAST(floor(value) AS INTEGER) END AS available_spaces, CASE WHEN event_id % 17 = 0 THEN 'open' ELSE 'numeric' END AS status FROM events),
 ssnap AS (SELECT source_id, raw_file, ingested_at, max(reading_at) AS reading_at FROM sfeed GROUP BY ALL),
 sfresh AS (SELECT *, (epoch_us(ingested_at) - epoch_us(reading_at)) // 1000000 / 60.0 > 15 AS is_stale FROM ssnap),
 smarked AS (SELECT *, CASE WHEN is_stale AND (NOT coalesce(lag(is_stale) OVER w, false) OR lag(reading_at) OVER w IS DISTINCT FROM reading_at) THEN 1 ELSE 0 END AS starts FROM sfresh WINDOW w AS (PARTITION BY source_id ORDER BY ingested_at, raw_file)),
 sisland AS (SELECT *, sum(starts) OVER (PARTITION BY source_id ORDER BY ingested_at, raw_file ROWS UNBOUNDED PRECEDING) AS i, max(ingested_at) OVER (PARTITION BY source_id) AS newest FROM smarked),
 speriod AS (SELECT source_id, min(reading_at) AS source_reading_at, min(reading_at) + INTERVAL 15 MINUTE AS stale_from, max(ingested_at) AS last_stale, CAST(count(*) AS INTEGER) AS fetch_count, bool_or(ingested_at = newest) AS ongoing FROM sisland WHERE is_stale GROUP BY source_id, i),
 sstale AS (SELECT source_id, source_reading_at, stale_from, CASE WHEN NOT ongoing THEN last_stale END AS stale_until, ongoing, fetch_count, (epoch_us(last_stale) - epoch_us(stale_from)) / 60e6 AS m, CAST(stale_from + INTERVAL 1 HOUR AS DATE) AS day FROM speriod)"""
SAVAIL = f"""{SFEED}, swon AS (SELECT * FROM sfeed QUALIFY row_number() OVER (PARTITION BY source_id, facility, reading_at ORDER BY ingested_at, raw_file, record_index) = 1),
 slast AS (SELECT source_id, facility, reading_at, max(ingested_at) AS last_fetched_at FROM sfeed GROUP BY ALL),
 sav AS (SELECT w.source_id, CAST(substr(w.facility, 2) AS INTEGER) AS u, w.reading_at AS valid_from, lead(w.reading_at) OVER o AS valid_to, last_fetched_at, available_spaces, status,
 CASE WHEN CAST(substr(w.facility, 2) AS INTEGER) % 7 <> 0 THEN 100 + CAST(substr(w.facility, 2) AS INTEGER) % 50 END AS capacity, CAST(w.reading_at AS DATE) AS day,
 coalesce(abs(lag(available_spaces) OVER o - lead(available_spaces) OVER o) <= 30 AND abs(available_spaces - lag(available_spaces) OVER o) >= 5 AND abs(available_spaces - lead(available_spaces) OVER o) >= 5, false)
 OR coalesce(lag(status) OVER o = 'open' AND lead(status) OVER o = 'open' AND status = 'numeric', false) AS glitch,
 EXISTS (SELECT 1 FROM speriod p WHERE p.source_id = w.source_id AND p.source_reading_at = w.reading_at) AS is_stale
 FROM swon w JOIN slast USING (source_id, facility, reading_at) WINDOW o AS (PARTITION BY w.facility ORDER BY w.reading_at, last_fetched_at, w.source_id))"""
SHOUR = f"""{SAVAIL}, span AS (SELECT source_id, source_reading_at, min(stale_from) AS s0, max(last_stale) AS s1 FROM speriod GROUP BY ALL),
 sseg AS (SELECT sav.*, s0, s1, CASE WHEN valid_to IS NULL THEN last_fetched_at ELSE least(valid_to, last_fetched_at + INTERVAL 20 MINUTE) END AS upto FROM sav LEFT JOIN span ON span.source_id = sav.source_id AND source_reading_at = valid_from),
 scut AS (SELECT *, unnest(generate_series(date_trunc('hour', valid_from), date_trunc('hour', upto - INTERVAL 1 MICROSECOND), INTERVAL 1 HOUR)) AS hour_start FROM sseg WHERE upto > valid_from),
 sedge AS (SELECT *, greatest(valid_from, hour_start) AS a, least(upto, hour_start + INTERVAL 1 HOUR) AS b, available_spaces IS NOT NULL AND NOT glitch AS counted FROM scut),
 spart AS (SELECT *, epoch_us(b) - epoch_us(a) AS us, CASE WHEN s0 IS NULL THEN 0 ELSE greatest(0, epoch_us(least(b, s1)) - epoch_us(greatest(a, s0))) END AS stale_us FROM sedge),
 sh AS (SELECT u, hour_start, CAST(sum(available_spaces * us) FILTER (WHERE counted) AS DOUBLE) / sum(us) FILTER (WHERE counted) AS avg_spaces, min(available_spaces) FILTER (WHERE counted) AS min_spaces, max(available_spaces) FILTER (WHERE counted) AS max_spaces,
 CAST(sum(us) AS BIGINT) AS covered, CAST(coalesce(sum(us) FILTER (WHERE counted), 0) AS BIGINT) AS counted, CAST(sum(stale_us) AS BIGINT) AS stale, hour_start + INTERVAL 1 HOUR AS wall, CAST(hour_start + INTERVAL 1 HOUR AS DATE) AS day FROM spart GROUP BY u, hour_start)"""
#: Time-weighted averages per facility in a grouping, and their occupancy; by: columns of sh; only: a condition on its rows.
PER = "(SELECT {by}, u, sum(avg_spaces * counted) / sum(CASE WHEN avg_spaces IS NOT NULL THEN counted END) AS v, CASE WHEN u % 7 <> 0 THEN 100 + u % 50 END AS capacity FROM sh {only} GROUP BY ALL)"
FRESH = "WHERE stale <= 0.5 * covered"


def minutes_to_us(c: str):
    return F.round(F.col(c) * 60e6).cast("long")


@query(f"WITH {SAVAIL} SELECT source_id, u + 1 AS facility_key, valid_from, valid_to, last_fetched_at, available_spaces, is_stale, glitch AS is_source_glitch FROM sav")
def availability_with_stale_periods(spark, d):
    a = star(spark, d)["fact_parking_availability"]
    return a.select("source_id", "facility_key", *[ntz(c).alias(c) for c in ("valid_from", "valid_to", "last_fetched_at")], "available_spaces", "is_stale", "is_source_glitch")


@query(f"WITH {SHOUR} SELECT u + 1 AS facility_key, hour_start, round(avg_spaces, 6) AS avg_spaces, covered, counted, stale FROM sh")
def hourly_with_stale_periods(spark, d):
    h = star(spark, d)["fact_parking_hourly"]
    return h.select("facility_key", ntz("hour_start").alias("hour_start"), F.round("avg_spaces", 6).alias("avg_spaces"), minutes_to_us("covered_minutes").alias("covered"), minutes_to_us("counted_minutes").alias("counted"), minutes_to_us("stale_minutes").alias("stale"))


@query(f"WITH {SHOUR} SELECT u + 1 AS facility_key, hour_start, round(avg_spaces, 6) AS avg_spaces, covered, counted, stale FROM sh")
def hourly_by_affected_keys(spark, d):
    """The same hours from facts kept by day: a seventh of the hourly files comes in a second load, and only what it touches is derived anew."""
    fetches, store = stalled(spark, d), daily.Facts(spark, scratch.new(spark, "days"), facts.Glitch(30, 5))
    late = F.pmod(F.xxhash64("source_id", "raw_file"), F.lit(7)) == 0
    for part in (fetches.where(~late), fetches.where(late)):
        store.update(part, dim(spark, d))
    h = store.hourly()
    return h.select("facility_key", ntz("hour_start").alias("hour_start"), F.round("avg_spaces", 6).alias("avg_spaces"), minutes_to_us("covered_minutes").alias("covered"), minutes_to_us("counted_minutes").alias("counted"), minutes_to_us("stale_minutes").alias("stale"))


@query(f"WITH {STALE} SELECT * FROM period")
def stale_periods_stream(spark, d):
    """Stale periods from a stream of snapshot files in which snapshots come up to eight days late."""
    files, out, home = (scratch.new(spark, n) for n in ("snapshots", "periods", "checkpoint"))
    s = readings.freshness(snapshots(spark, d))
    block = F.floor(F.dayofmonth("ingested_at") / 4) + F.pmod(F.xxhash64("source_id", "raw_file"), F.lit(2))
    for n in range(1, 10):  # files in the order of their arrival
        s.where(block == n - 1).coalesce(1).write.parquet(f"{files}/{n:02d}")
    tick = s.groupBy("source_id").agg((F.max("ingested_at") + F.expr("interval 1000 days")).alias("ingested_at"))
    for n, days in ((10, 0), (11, 1)):  # the first moves the watermark past all snapshots and itself is passed by the second
        own = tick.select("source_id", F.lit(None).cast("string").alias("raw_file"), (F.col("ingested_at") - F.expr(f"interval {900 * (1 - days)} days")).alias("ingested_at"), F.lit(None).cast("timestamp").alias("source_reading_at"), F.lit(None).cast("double").alias("age_minutes"), F.lit(None).cast("boolean").alias("is_stale"))
        own.coalesce(1).write.parquet(f"{files}/{n:02d}")
    for last in (6, 11):  # the stream stops and goes on from its checkpoint
        new = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 3).parquet(f"{files}/{{{','.join(f'{n:02d}' for n in range(1, last + 1))}}}")
        islands.run_available(spark, new, out, home, "9 days")
    p = islands.read(spark, out)
    return p.withColumns({c: ntz(c) for c in ("source_reading_at", "stale_from", "first_stale_fetch_at", "last_stale_fetch_at")})


@query(
    f"""WITH {SHOUR}, w AS (SELECT *, max(max_spaces) OVER (PARTITION BY u) AS seen FROM sh), j AS (SELECT *, coalesce(CASE WHEN u % 7 <> 0 THEN 100 + u % 50 END, seen) AS capacity FROM w)
 SELECT u + 1 AS facility_key, hour_start, CASE WHEN avg_spaces IS NULL OR capacity IS NULL OR capacity = 0 OR covered < 60000000 THEN 'no_data' WHEN stale > 0.5 * covered THEN 'stale' WHEN u % 11 = 0 THEN 'no_tariff' ELSE 'priced' END AS status FROM j"""
)
def price_status_with_stale_periods(spark, d):
    p = priced(spark, d, pricing.Rules(min_covered_minutes=1))
    return p.select("facility_key", ntz("hour_start").alias("hour_start"), "status")


def priced(spark: SparkSession, d: str, rules: pricing.Rules) -> DataFrame:
    flat = [{"from": "00:00", "to": "24:00", "price": 20}]
    return pricing.suggested_prices(star(spark, d)["fact_parking_hourly"], dim(spark, d), tariff_of_all(spark, d, flat), rules)


@query(
    f"""WITH {SHOUR}, w AS (SELECT *, max(max_spaces) OVER (PARTITION BY u) AS seen FROM sh), j AS (SELECT *, 1 - avg_spaces / nullif(coalesce(CASE WHEN u % 7 <> 0 THEN 100 + u % 50 END, seen), 0) AS occ FROM w),
 p AS (SELECT u, hour_start, occ, 40.0::DOUBLE * CASE WHEN occ < 0.5 THEN 0.8::DOUBLE WHEN occ < 0.85 THEN 1.0::DOUBLE ELSE 1.25::DOUBLE END AS raw, CASE WHEN occ < 0.5 THEN 'low' WHEN occ < 0.85 THEN 'normal' ELSE 'high' END AS band FROM j
 WHERE avg_spaces IS NOT NULL AND occ IS NOT NULL AND covered >= 60000000 AND stale <= 0.5 * covered AND u % 11 <> 0),
 l AS (SELECT *, CASE WHEN u % 5 = 1 THEN 35.0 ELSE 20.0 END AS lo, CASE WHEN u % 5 = 2 THEN 45.0 ELSE 60.0 END AS hi FROM p)
 SELECT u + 1 AS facility_key, hour_start, round_even(greatest(least(raw, hi), lo), 0) AS suggested_price, 'occupancy:' || band || CASE WHEN raw > hi THEN ' (capped at the maximum)' WHEN raw < lo THEN ' (raised to the minimum)' ELSE '' END AS applied_rule FROM l"""
)
def price_limits(spark, d):
    """Limits of their own for two of every five facilities."""
    names = [r["facility_name"] for r in dim(spark, d).select("facility_name").collect()]  # a dimension: the rules are a small file
    limits = {n: (35, None) if int(n[1:]) % 5 == 1 else (None, 45) for n in names if int(n[1:]) % 5 in (1, 2)}
    p = priced(spark, d, pricing.Rules(min_covered_minutes=1, rush=(), limits=limits)).where("status = 'priced'")
    return p.select("facility_key", ntz("hour_start").alias("hour_start"), "suggested_price", "applied_rule")


# --- measures


@query("SELECT CAST(user_id % 50 AS BIGINT) AS shape, CAST(sum(CASE WHEN user_id % 7 <> 0 THEN 100 + user_id % 50 END) AS BIGINT) AS capacity FROM (SELECT DISTINCT user_id FROM events) GROUP BY 1")
def measure_capacity(spark, d):
    return measures.capacity(dim(spark, d).withColumn("shape", ((F.col("facility_key") - 1) % 50).cast("long")), ["shape"])


LATEST = "last AS (SELECT u, arg_max(coalesce(available_spaces, -1), valid_from) AS v, any_value(capacity) AS capacity FROM (SELECT * FROM av2) GROUP BY u)"
AV2 = f"""{FEED}, {FIRST}, last2 AS (SELECT facility, reading_at, max(ingested_at) AS last_fetched_at FROM feed GROUP BY ALL),
 av2 AS (SELECT CAST(substr(facility, 2) AS INTEGER) AS u, reading_at AS valid_from, lead(reading_at) OVER (PARTITION BY facility ORDER BY reading_at) AS valid_to, last_fetched_at, available_spaces, CASE WHEN CAST(substr(facility, 2) AS INTEGER) % 7 <> 0 THEN 100 + CAST(substr(facility, 2) AS INTEGER) % 50 END AS capacity FROM won JOIN last2 USING (facility, reading_at))"""


def plain(spark: SparkSession, d: str) -> DataFrame:
    from tidegrain.plans.queries import fact

    return fact(spark, d)


@query(f"WITH {AV2}, {LATEST} SELECT u % 3 AS part, round(sum(capacity - v) / sum(capacity), 6) AS occupancy_latest FROM last WHERE v >= 0 AND capacity IS NOT NULL GROUP BY 1")
def measure_occupancy_latest(spark, d):
    return measures.occupancy_latest(plain(spark, d).withColumn("part", (F.col("facility_key") - 1) % 3), dim(spark, d), ["part"]).select("part", F.round("occupancy_latest", 6).alias("occupancy_latest"))


@query(f"WITH {SAVAIL} SELECT source_id, CASE WHEN coalesce(bool_or(valid_to IS NULL AND is_stale), false) THEN 'Stale' ELSE 'Fresh' END AS source_status FROM sav GROUP BY 1")
def measure_source_status(spark, d):
    return measures.source_status(star(spark, d)["fact_parking_availability"], ["source_id"])


@query("SELECT 'Contains open data under the Norwegian licence for Open Government data (NLOD)' AS attribution")
def measure_attribution(spark, d):
    return measures.attribution(spark)


@query(f"WITH {SHOUR} SELECT u + 1 AS facility_key, min(min_spaces) AS free_spaces_min, max(max_spaces) AS free_spaces_max FROM sh GROUP BY 1")
def measure_extremes(spark, d):
    return measures.extremes(star(spark, d)["fact_parking_hourly"], ["facility_key"])


@query(f"WITH {SHOUR}, per AS {PER.format(by='day', only='')} SELECT day, round(sum(capacity - v) / sum(capacity), 6) AS occupancy FROM per WHERE v IS NOT NULL AND capacity IS NOT NULL GROUP BY 1")
def measure_occupancy(spark, d):
    h = star(spark, d)["fact_parking_hourly"].withColumn("day", F.to_date(local(F.col("hour_start"), "Europe/Oslo")))
    return measures.occupancy(h, dim(spark, d), ["day"]).select("day", F.round("occupancy", 6).alias("occupancy"))


@query(f"WITH {SHOUR} SELECT day, CAST(sum(covered) AS BIGINT) AS covered, CAST(sum(stale) AS BIGINT) AS stale, round(CAST(sum(stale) AS DOUBLE) / nullif(sum(covered), 0), 6) AS stale_share FROM sh GROUP BY 1")
def measure_coverage(spark, d):
    h = star(spark, d)["fact_parking_hourly"].withColumn("day", F.to_date(local(F.col("hour_start"), "Europe/Oslo")))
    return measures.coverage(h, ["day"]).select("day", F.col("covered_us").alias("covered"), F.col("stale_us").alias("stale"), F.round("stale_share", 6).alias("stale_share"))


@query(f"WITH {SFEED} SELECT source_id, ongoing, count(*) AS incidents, round(sum(m) / 1440, 6) AS stale_days, round(max(m) / 1440, 6) AS longest_days FROM sstale GROUP BY ALL")
def measure_incidents(spark, d):
    r = measures.incidents(star(spark, d)["fact_source_stale_period"], ["source_id", "ongoing"])
    return r.select("source_id", "ongoing", "incidents", F.round("stale_days", 6).alias("stale_days"), F.round("longest_days", 6).alias("longest_days"))


@query(
    f"""WITH {SFEED} SELECT stale_from, count(*) AS incidents, round(sum(m) / 1440, 6) AS stale_days, CASE WHEN grouping(stale_from) = 0 THEN CASE WHEN bool_or(ongoing) THEN 'ongoing' ELSE strftime(max(stale_until), '%Y-%m-%d %H:%M') END END AS ended, grouping(stale_from) = 1 AS is_total FROM sstale GROUP BY ROLLUP (stale_from)"""
)
def measure_incidents_with_total(spark, d):
    r = measures.incidents_with_total(star(spark, d)["fact_source_stale_period"])
    return r.select(ntz("stale_from").alias("stale_from"), "incidents", F.round("stale_days", 6).alias("stale_days"), "ended", "is_total")


# --- check results and report pages


def results(spark: SparkSession, d: str) -> DataFrame:
    """Results of a run a day: a check for each user, as its events say."""
    e = t(spark, d, "events")
    return e.select(
        F.concat(F.lit("check_"), "event_type").alias("check"), F.when(F.col("user_id") % 2 == 0, "critical").otherwise("warning").alias("severity"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("subject"),
        (F.col("value") < 50).alias("passed"), F.col("event_id").cast("string").alias("detail"), F.date_trunc("DAY", F.col("ts").cast("timestamp")).alias("checked_at"),
    )


RESULTS = "results AS (SELECT 'check_' || event_type AS \"check\", CASE WHEN user_id % 2 = 0 THEN 'critical' ELSE 'warning' END AS severity, 'u' || CAST(user_id AS VARCHAR) AS subject, value < 50 AS passed, CAST(event_id AS VARCHAR) AS detail, date_trunc('day', ts) AS checked_at FROM events)"


@query(f"WITH {RESULTS} SELECT severity, count(*) AS failed_checks FROM results WHERE checked_at = (SELECT max(checked_at) FROM results) AND NOT passed GROUP BY 1")
def measure_failed_checks(spark, d):
    return measures.failed_checks(results(spark, d), ["severity"])


@query(f"WITH {SHOUR}, per AS {PER.format(by='day, hour(wall) AS hour', only='')} SELECT day AS date, CAST(hour AS TINYINT) AS hour, 'u' || u AS facility_name, round(v, 6) AS free_spaces_avg FROM per")
def report_free_spaces_line(spark, d):
    r = Report(star(spark, d)).free_spaces_line()
    return r.select("date", "hour", "facility_name", F.round("free_spaces_avg", 6).alias("free_spaces_avg"))


@query(f"WITH {SAVAIL}, l AS (SELECT * FROM sav QUALIFY row_number() OVER (PARTITION BY u ORDER BY valid_from DESC, last_fetched_at DESC, source_id DESC) = 1) SELECT CAST(sum(available_spaces) AS BIGINT) AS free_spaces_latest FROM l")
def report_latest_card(spark, d):
    return Report(star(spark, d)).latest_card()


@query(f"WITH {SHOUR}, per AS {PER.format(by='isodow(wall) AS weekday_number, dayname(wall) AS weekday, hour(wall) AS hour', only=FRESH)} SELECT CAST(weekday_number AS TINYINT) AS weekday_number, weekday, CAST(hour AS TINYINT) AS hour, round(sum(capacity - v) / sum(capacity), 6) AS occupancy_fresh FROM per WHERE v IS NOT NULL AND capacity IS NOT NULL GROUP BY ALL")
def report_occupancy_matrix(spark, d):
    return Report(star(spark, d)).occupancy_matrix().select("weekday_number", "weekday", "hour", F.round("occupancy_fresh", 6).alias("occupancy_fresh"))


@query(
    f"""WITH {AV2}, {LATEST}, age AS (SELECT u, epoch_us(date_trunc('minute', max(last_fetched_at))) // 60000000 - epoch_us(date_trunc('minute', max(valid_from))) // 60000000 AS data_age_minutes FROM av2 GROUP BY 1)
 SELECT 'u' || u AS facility_name, CAST(capacity AS BIGINT) AS capacity, CAST(CASE WHEN v >= 0 THEN v END AS BIGINT) AS free_spaces_latest, round(CASE WHEN v >= 0 THEN (capacity - v) / capacity END, 6) AS occupancy_latest, data_age_minutes FROM last JOIN age USING (u)"""
)
def report_facility_table(spark, d):
    r = Report(star(spark, d) | {"fact_parking_availability": plain(spark, d)}).facility_table()
    return r.select("facility_name", "capacity", "free_spaces_latest", F.round("occupancy_latest", 6).alias("occupancy_latest"), "data_age_minutes")


@query(f"WITH {SHOUR}, per AS {PER.format(by='day', only=FRESH)}, o AS (SELECT day, sum(capacity - v) / sum(capacity) AS f FROM per WHERE v IS NOT NULL AND capacity IS NOT NULL GROUP BY 1), c AS (SELECT day, CAST(sum(stale) AS DOUBLE) / sum(covered) AS s FROM sh GROUP BY 1) SELECT day AS date, round(s, 6) AS stale_share, round(f, 6) AS occupancy_fresh FROM c LEFT JOIN o USING (day)")
def report_stale_timeline(spark, d):
    return Report(star(spark, d)).stale_timeline().select("date", F.round("stale_share", 6).alias("stale_share"), F.round("occupancy_fresh", 6).alias("occupancy_fresh"))


@query(f"WITH {SHOUR} SELECT day AS date, CAST(sum(covered) AS BIGINT) AS covered FROM sh GROUP BY 1")
def report_covered_minutes(spark, d):
    return Report(star(spark, d)).covered_minutes().select("date", F.col("covered_us").alias("covered"))


@query(f"WITH {SFEED} SELECT stale_from, CASE WHEN ongoing THEN 'ongoing' ELSE strftime(stale_until, '%Y-%m-%d %H:%M') END AS ended, round(m / 1440, 6) AS stale_days, fetch_count FROM sstale")
def report_stale_periods(spark, d):
    return Report(star(spark, d)).stale_periods().select(ntz("stale_from").alias("stale_from"), "ended", F.round("stale_days", 6).alias("stale_days"), "fetch_count")


@query(f"WITH {RESULTS} SELECT severity, \"check\", subject, detail, count(*) AS failed_checks FROM results WHERE checked_at = (SELECT max(checked_at) FROM results) AND NOT passed GROUP BY ALL")
def report_failed_checks(spark, d):
    return Report(star(spark, d)).failed_checks()


@query(f"WITH {SAVAIL} SELECT CASE WHEN coalesce(bool_or(valid_to IS NULL AND is_stale), false) THEN 'Stale' ELSE 'Fresh' END AS source_status, epoch_us(date_trunc('minute', max(last_fetched_at))) // 60000000 - epoch_us(date_trunc('minute', max(valid_from))) // 60000000 AS data_age_minutes FROM sav")
def report_status_cards(spark, d):
    return Report(star(spark, d)).status_cards()


@query(f"WITH {EASTER}, {SHOUR} SELECT day AS date, CAST(sum(covered) AS BIGINT) AS covered FROM sh WHERE u % 2 = 0 AND day BETWEEN DATE '2024-01-01' AND DATE '2024-01-20' AND day NOT IN (SELECT date FROM named) GROUP BY 1")
def report_slicers(spark, d):
    r = Report(star(spark, d), dates=F.col("date").between("2024-01-01", "2024-01-20") & ~F.col("is_public_holiday"), facilities=(F.col("facility_key") - 1) % 2 == 0)
    return r.covered_minutes().select("date", F.col("covered_us").alias("covered"))


# --- the checks, each over the whole feed


def check_row(check: str, severity: str, passed: str, detail: str, tail: str) -> str:
    return f"SELECT '{check}' AS \"check\", '{severity}' AS severity, CAST(NULL AS VARCHAR) AS subject, {passed} AS passed, {detail} AS detail {tail}"


def drifted(spark: SparkSession, d: str) -> DataFrame:
    """The feed's text with a field that the last hour lacks, and one that is new."""
    text, own = _source_text(spark, d), t(spark, d, "events").select(F.col("event_id").cast("int").alias("record_index"), F.date_format("ts", "yyyyMMddHH").alias("hour"))
    last = own.agg(F.max("hour").alias("last"))
    b = text.drop("raw_file").join(own, "record_index").join(F.broadcast(last)).withColumnRenamed("hour", "raw_file")
    return b.withColumns({"Longitude": F.when(F.col("raw_file") != F.col("last"), F.col("Longitude")), "Ny": F.when(F.col("record_index") % 2 == 0, "x"), "Tom": F.lit(None).cast("string")}).drop("last")


@query(
    f"WITH {TEXT}, h AS (SELECT src.*, strftime(ts, '%Y%m%d%H') AS f FROM src JOIN events ON event_id = record_index), s AS (SELECT * FROM h WHERE f = (SELECT max(f) FROM h)), "
    "c AS (SELECT list_filter([CASE WHEN count(dato) = 0 THEN 'Dato' END, CASE WHEN count(klokke) = 0 THEN 'Klokkeslett' END, CASE WHEN count(sted) = 0 THEN 'Sted' END, CASE WHEN count(lat) = 0 THEN 'Latitude' END, 'Longitude', CASE WHEN count(n) = 0 THEN 'Antall_ledige_plasser' END], lambda x: x IS NOT NULL) AS lost, count(CASE WHEN record_index % 2 = 0 THEN 1 END) > 0 AS ny FROM s) "
    + check_row("schema_drift", "critical", "false", "'missing: ' || array_to_string(lost, ', ') || '; new: ' || CASE WHEN ny THEN 'Ny' ELSE '' END", "FROM c")
)
def check_schema_drift(spark, d):
    b = drifted(spark, d)
    newest = checks.newest_file(b, b.select("raw_file"))
    snapshot = b.join(F.broadcast(newest), F.col("raw_file") == F.col("newest")).drop("newest")
    return checks.schema_drift(snapshot, readings.FeedSpec().fields, readings.LINEAGE)


def issues(spark: SparkSession, d: str) -> DataFrame:
    return feed(spark, d).where("record_index % 10 = 0").select("source_id", "raw_file", F.lit("unreadable_payload").alias("reason"))


def newest_of(spark: SparkSession, d: str) -> DataFrame:
    return checks.newest_file(feed(spark, d), issues(spark, d))


@query(f"WITH {FEED}, s AS (SELECT count(*) AS n, count(CASE WHEN record_index % 10 = 0 THEN 1 END) AS bad FROM feed WHERE raw_file = (SELECT max(raw_file) FROM feed)) " + check_row("empty_snapshot", "critical", "bad = 0 AND n > 0", "n || ' records, ' || bad || ' load issues'", "FROM s"))
def check_empty_snapshot(spark, d):
    return checks.empty_snapshot(feed(spark, d), issues(spark, d), newest_of(spark, d))


def last_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The newest snapshot, with coordinates that lie in the area, beside it, or nowhere."""
    i = F.col("record_index")
    f = feed(spark, d).withColumns({"latitude": F.when(i % 17 != 0, F.lit(58.8) + (i % 25) / 100).cast("decimal(10,7)"), "longitude": F.when(i % 19 != 0, F.lit(5.5) + (i % 40) / 100).cast("decimal(10,7)")})
    return f.join(F.broadcast(newest_of(spark, d)), F.col("raw_file") == F.col("newest")).drop("newest")


def mapped(spark: SparkSession, d: str) -> DataFrame:
    return dim(spark, d).where("facility_key % 4 <> 0").select(F.col("facility_name").alias("facility"))


LAST = f"{FEED}, snap AS (SELECT *, CAST(substr(facility, 2) AS INTEGER) AS u FROM feed WHERE raw_file = (SELECT max(raw_file) FROM feed)), users AS (SELECT DISTINCT user_id AS u, 'u' || user_id AS f FROM events)"


@query(f"WITH {LAST}, k AS (SELECT list(f) FILTER (WHERE (u + 1) % 4 <> 0) AS known, list(f) FILTER (WHERE u IN (SELECT u FROM snap)) AS seen FROM users) " + check_row("facility_count", "critical", "len(seen) = len(known)", "'absent: ' || array_to_string(list_sort(list_filter(known, lambda x: NOT list_contains(seen, x))), ', ') || '; extra: ' || array_to_string(list_sort(list_filter(seen, lambda x: NOT list_contains(known, x))), ', ')", "FROM k"))
def check_facility_count(spark, d):
    return checks.facility_count(last_snapshot(spark, d), mapped(spark, d))


def of_facility(spark: SparkSession, d: str, check: str) -> DataFrame:
    return checks.per_facility(last_snapshot(spark, d), dim(spark, d), mapped(spark, d)).where(F.col("check") == check)


@query(f"WITH {LAST} SELECT 'free_exceeds_capacity' AS \"check\", 'critical' AS severity, facility AS subject, available_spaces <= 100 + u % 50 AS passed, available_spaces || ' of ' || (100 + u % 50) AS detail FROM snap WHERE available_spaces IS NOT NULL AND u % 7 <> 0")
def check_free_exceeds_capacity(spark, d):
    return of_facility(spark, d, "free_exceeds_capacity")


@query(f"WITH {LAST} SELECT 'unmapped_facility' AS \"check\", 'warning' AS severity, facility AS subject, (u + 1) % 4 <> 0 AS passed, CAST(NULL AS VARCHAR) AS detail FROM snap")
def check_unmapped_facility(spark, d):
    return of_facility(spark, d, "unmapped_facility")


@query(f"WITH {LAST}, c AS (SELECT *, CASE WHEN record_index % 17 <> 0 THEN CAST(58.8 + (record_index % 25) / 100 AS DECIMAL(10,7)) END AS lat, CASE WHEN record_index % 19 <> 0 THEN CAST(5.5 + (record_index % 40) / 100 AS DECIMAL(10,7)) END AS lon FROM snap) SELECT 'coordinates_outside_area' AS \"check\", 'warning' AS severity, facility AS subject, coalesce(lat BETWEEN 58.85 AND 59.05 AND lon BETWEEN 5.55 AND 5.85, false) AS passed, concat_ws(', ', CAST(lat AS VARCHAR), CAST(lon AS VARCHAR)) AS detail FROM c")
def check_coordinates_outside_area(spark, d):
    return of_facility(spark, d, "coordinates_outside_area")


BAD = f"""{TEXT}, bad AS (SELECT 'd' AS field, NULL AS v FROM typed WHERE wall IS NULL UNION ALL SELECT 's', NULL FROM typed WHERE sted IS NULL UNION ALL SELECT 'l', NULL FROM typed WHERE lat = '1e1' UNION ALL SELECT 'n', n FROM typed WHERE spaces IS NULL AND n <> 'Open'),
 q AS (SELECT count(*) FILTER (WHERE field = 'n' AND regexp_full_match(v, '-[0-9]+')) AS neg, count(*) AS total FROM bad)"""


def quarantine_results(spark: SparkSession, d: str, check: str) -> DataFrame:
    _, q = readings.parse_readings(_source_text(spark, d))
    newest = checks.newest_file(_source_text(spark, d), q)
    return checks.quarantined(q, newest, readings.FeedSpec().count).where(F.col("check") == check)


@query(f"WITH {BAD} " + check_row("negative_available_spaces", "warning", "neg = 0", "CAST(neg AS VARCHAR)", "FROM q"))
def check_negative_available_spaces(spark, d):
    return quarantine_results(spark, d, "negative_available_spaces")


@query(f"WITH {BAD} " + check_row("quarantined_values", "warning", "total - neg = 0", "CAST(total - neg AS VARCHAR)", "FROM q"))
def check_quarantined_values(spark, d):
    return quarantine_results(spark, d, "quarantined_values")


@query("WITH now AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 3 <> 0), lost AS (SELECT list_sort(list(s_name)) AS l FROM supplier WHERE s_suppkey % 7 <> 0 AND s_suppkey NOT IN (SELECT k FROM now)) " + check_row("register_missing_areas", "warning", "len(l) = 0", "array_to_string(l, ', ')", "FROM lost"))
def check_register_missing_areas(spark, d):
    """Parts stand for areas, a third of them of an older register; suppliers for facilities, each seventh without a register id."""
    p, s = t(spark, d, "part"), t(spark, d, "supplier")
    at = F.when(F.col("p_partkey") % 3 == 0, F.lit("2024-01-01")).otherwise("2024-01-02").cast("timestamp")
    areas = p.select(F.col("p_partkey").alias("register_id"), at.alias("ingested_at"))
    return checks.register_missing_areas(areas, s.select(F.col("s_name").alias("facility"), F.when(F.col("s_suppkey") % 7 != 0, F.col("s_suppkey")).alias("register_id")))


@query(f"WITH {SNAP}, l AS (SELECT bool_or(is_stale) AS s, max(age_minutes) AS a FROM fresh WHERE raw_file = (SELECT max(raw_file) FROM fresh)) " + check_row("source_stale", "warning", "NOT s", "CAST(round(a, 1) AS VARCHAR) || ' minutes old'", "FROM l"))
def check_source_stale(spark, d):
    s = readings.freshness(snapshots(spark, d))
    return checks.source_stale(s, s.agg(F.max("raw_file").alias("newest")))


def until_of(spark: SparkSession, d: str) -> DataFrame:
    return feed(spark, d).agg(F.max("ingested_at").alias("until"))


LISTED = "array_to_string(coalesce(list(s || ': ' || n ORDER BY s, n), []), ', ')"


@query(
    f"WITH {SHOUR}, last_hour AS (SELECT date_trunc('hour', max(ts)) AS x FROM events), g AS (SELECT u, hs FROM (SELECT DISTINCT user_id AS u FROM events), (SELECT unnest(generate_series(x - INTERVAL 24 HOUR, x - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hs FROM last_hour)), "
    "low AS (SELECT 'u' || g.u AS s, count(*) AS n FROM g LEFT JOIN sh ON sh.u = g.u AND sh.hour_start = g.hs WHERE coalesce(covered, 0) < 1800000000 AND g.u % 3 <> 0 GROUP BY 1) " + check_row("low_coverage", "warning", "count(*) = 0", LISTED, "FROM low")
)
def check_low_coverage(spark, d):
    """A third of the facilities isn't active."""
    f = dim(spark, d).withColumn("is_active", (F.col("facility_key") - 1) % 3 != 0)
    return checks.low_coverage(star(spark, d)["fact_parking_hourly"], f, until_of(spark, d))


@query(f"WITH {SAVAIL}, g AS (SELECT 'u' || u AS s, count(*) AS n FROM sav WHERE glitch AND valid_from > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR GROUP BY 1) " + check_row("source_glitches", "warning", "count(*) = 0", LISTED, "FROM g"))
def check_source_glitches(spark, d):
    return checks.source_glitches(star(spark, d)["fact_parking_availability"], dim(spark, d), until_of(spark, d))


@query("WITH r AS (SELECT event_type AS s, count(*) AS n FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR GROUP BY 1) " + check_row("collect_failures", "warning", "count(*) = 0", LISTED, "FROM r"))
def check_collect_failures(spark, d):
    """Each event as a failed run whose step is its type."""
    return checks.collect_failures(t(spark, d, "events").select(F.col("event_type").alias("failed_step"), F.col("ts").cast("timestamp").alias("started_at")), until_of(spark, d))


@query("WITH o AS (SELECT event_type AS s, count(*) || ' over ' || ((epoch_us(max(ts)) - epoch_us(min(ts))) // 60000000) || ' minutes' AS n FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR GROUP BY 1) " + check_row("source_outages", "warning", "count(*) = 0", LISTED, "FROM o"))
def check_source_outages(spark, d):
    """Each event as an outage record of a source by its type."""
    return checks.source_outages(t(spark, d, "events").select(F.col("event_type").alias("source_id"), F.col("ts").cast("timestamp").alias("observed_at")), until_of(spark, d))


# --- facilities


@query(
    """WITH now AS (SELECT p_partkey AS id, CASE WHEN p_size % 5 <> 0 THEN p_size END AS paid FROM part WHERE p_partkey % 3 <> 0)
 SELECT s_name AS facility_name, CAST(s_suppkey AS BIGINT) AS register_id, CAST(paid + CASE WHEN s_suppkey % 2 = 0 THEN 10 ELSE 0 END AS INTEGER) AS capacity FROM supplier LEFT JOIN now ON id = s_suppkey"""
)
def facility_capacity(spark, d):
    """Suppliers as facilities, parts as register areas: a third of an older register, a fifth deactivated."""
    p, s = t(spark, d, "part"), t(spark, d, "supplier")
    at = F.when(F.col("p_partkey") % 3 == 0, F.lit("2024-01-01")).otherwise("2024-01-02").cast("timestamp")
    areas = p.select(F.col("p_partkey").alias("register_id"), at.alias("ingested_at"), F.lit(0).alias("record_index"), F.col("p_size").alias("paid_spaces"), F.when(F.col("p_size") % 5 == 0, at).alias("deactivated_at"))
    mapping = s.select(F.col("s_name").alias("facility"), F.col("s_suppkey").alias("register_id"), F.when(F.col("s_suppkey") % 2 == 0, F.lit(10)).alias("reserved_spaces"))
    areas = areas.withColumn("changed_at", F.lit(None).cast("timestamp"))
    fetches = s.select(F.lit("s").alias("source_id"), F.col("s_name").alias("facility"), F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"), F.lit("2024-01-02").cast("timestamp").alias("ingested_at"), F.lit("f").alias("raw_file"), F.lit(0).alias("record_index"))
    return facility.attributes(fetches, areas, mapping).select("facility_name", "register_id", "capacity")


@query("SELECT CAST(row_number() OVER (ORDER BY c_custkey % 10, c_name) AS INTEGER) AS facility_key, c_name AS facility_name, true AS is_active FROM customer UNION ALL SELECT -1, '(unknown)', false")
def dim_facility_first_run(spark, d):
    from tidegrain.schemas import FACILITY

    seen = F.timestamp_seconds(F.lit(1704067200) + F.col("c_custkey") % 10)
    attrs = t(spark, d, "customer").select(F.col("c_name").alias("facility_name"), seen.alias("first_seen"), seen.alias("last_seen"), F.lit(None).cast("decimal(10,7)").alias("latitude"), F.lit(None).cast("decimal(10,7)").alias("longitude"), F.lit(None).cast("int").alias("capacity"), F.lit(None).cast("timestamp").alias("capacity_changed_at"), F.lit(None).cast("long").alias("register_id"), F.lit(True).alias("is_active"))
    return facility.dim_facility(attrs, spark.createDataFrame([], FACILITY)).select("facility_key", "facility_name", "is_active")
