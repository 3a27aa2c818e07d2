"""Registered queries of totals by level, facts by date, counts of a step, and rules written in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidegrain import scratch
from tidegrain.functions import sql
from tidegrain.functions.time import local
from tidegrain.operators import facts, readings
from tidegrain.plans import totals
from tidegrain.plans.dated import Dated
from tidegrain.plans.queries import EASTER, TEXT, _source_text, dim, ntz, query, t
from tidegrain.plans.queries_reports import SAVAIL, SHOUR, minutes_to_us, stalled, star
from tidegrain.plans.reports import Report
from tidegrain.sources import buckets

CAPACITY = "CASE WHEN u % 7 <> 0 THEN 100 + u % 50 END AS capacity"


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(
    f"""WITH {SHOUR}, m AS (SELECT u, CAST(isodow(wall) AS INTEGER) AS weekday_number, CAST(hour(wall) AS INTEGER) AS hour, avg_spaces, counted, covered, stale, stale <= 0.5 * covered AS fresh FROM sh),
 per AS (SELECT weekday_number, hour, u, grouping(weekday_number, hour) AS level, {CAPACITY}, sum(avg_spaces * counted) / sum(CASE WHEN avg_spaces IS NOT NULL THEN counted END) AS v,
 sum(avg_spaces * counted) FILTER (WHERE fresh) / sum(CASE WHEN avg_spaces IS NOT NULL THEN counted END) FILTER (WHERE fresh) AS f, sum(covered) AS covered, sum(stale) AS stale
 FROM m GROUP BY GROUPING SETS ((weekday_number, hour, u), (weekday_number, u), (hour, u), (u)))
 SELECT weekday_number, hour, CAST(level AS INTEGER) AS level, round(sum(v), 6) AS free_spaces_avg, round(sum(capacity - v) / sum(CASE WHEN v IS NOT NULL THEN capacity END), 6) AS occupancy,
 round(sum(capacity - f) / sum(CASE WHEN f IS NOT NULL THEN capacity END), 6) AS occupancy_fresh, round(CAST(sum(stale) AS DOUBLE) / sum(covered), 6) AS stale_share FROM per GROUP BY weekday_number, hour, level"""
)
def totals_of_hours(spark, d):
    """The weekday and hour matrix with its row, column and grand totals."""
    by, wall = ["weekday_number", "hour"], local(F.col("hour_start"), "Europe/Oslo")
    h = star(spark, d)["fact_parking_hourly"].withColumns({"weekday_number": F.weekday(wall) + 1, "hour": F.hour(wall)})
    r = totals.hourly_totals(totals.hourly_states(h, by), dim(spark, d), by, [by, by[:1], by[1:], []])
    return rounded(r, "free_spaces_avg", "occupancy", "occupancy_fresh", "stale_share")


@query(
    f"""WITH {SAVAIL}, per AS (SELECT source_id, day, u, grouping(source_id, day) AS level, {CAPACITY}, count(*) AS readings, max(struct_pack(a := valid_from, b := last_fetched_at, c := source_id, v := coalesce(available_spaces, -1))).v AS w
 FROM sav GROUP BY GROUPING SETS ((source_id, day, u), (source_id, u), (day, u), (u))), val AS (SELECT * REPLACE (CASE WHEN w >= 0 THEN w END AS w) FROM per)
 SELECT source_id, day, CAST(level AS INTEGER) AS level, CAST(sum(w) AS BIGINT) AS free_spaces_latest, round(sum(capacity - w) / sum(CASE WHEN w IS NOT NULL THEN capacity END), 6) AS occupancy_latest, CAST(sum(readings) AS BIGINT) AS readings FROM val GROUP BY source_id, day, level"""
)
def totals_of_latest(spark, d):
    """Latest free spaces by source and day with totals of either and of all: the total is no sum of the days."""
    by = ["source_id", "day"]
    a = star(spark, d)["fact_parking_availability"].withColumn("day", F.to_date("valid_from"))
    return rounded(totals.latest_totals(totals.latest_states(a, by), dim(spark, d), by, [by, by[:1], by[1:], []]), "occupancy_latest")


@query(f"WITH {EASTER}, {SHOUR} SELECT day AS date, CAST(sum(covered) AS BIGINT) AS covered FROM sh WHERE u % 2 = 0 AND day BETWEEN DATE '2024-01-01' AND DATE '2024-01-20' AND day NOT IN (SELECT date FROM named) GROUP BY 1")
def slicers_over_dates(spark, d):
    """The sliced page over hours that are kept by date; a week is written again before the page is read."""
    s, kept = star(spark, d), Dated(spark, scratch.new(spark, "dated"))
    hours = scratch.save(s["fact_parking_hourly"], "hourly")
    kept.write("fact_parking_hourly", hours)
    kept.write("fact_parking_hourly", hours.where(F.col("date_key").between(20240108, 20240114)))
    scratch.done(hours)
    s["fact_parking_hourly"] = kept.read("fact_parking_hourly")
    r = Report(s, dates=F.col("date").between("2024-01-01", "2024-01-20") & ~F.col("is_public_holiday"), facilities=(F.col("facility_key") - 1) % 2 == 0)
    return r.covered_minutes().select("date", F.col("covered_us").alias("covered"))


BAD = f"""{TEXT}, bad AS (SELECT record_index, true AS x FROM typed WHERE wall IS NULL UNION ALL SELECT record_index, true FROM typed WHERE sted IS NULL
 UNION ALL SELECT record_index, wall IS NULL OR sted IS NULL FROM typed WHERE lat = '1e1' UNION ALL SELECT record_index, wall IS NULL OR sted IS NULL FROM typed WHERE spaces IS NULL AND n <> 'Open')"""


@query(
    f"""WITH {BAD}, f AS (SELECT bad.*, strftime(ts, '%Y%m%d%H') AS raw_file, event_type AS source_id FROM bad JOIN events ON event_id = record_index)
 SELECT source_id, count(*) AS quarantined, count(DISTINCT (raw_file, record_index)) AS rows_quarantined, count(DISTINCT (raw_file, record_index)) FILTER (WHERE x) AS excluded, count(DISTINCT raw_file) AS files_quarantined FROM f GROUP BY 1"""
)
def step_counts(spark, d):
    """What the parse of a feed for each event type, a file an hour, puts aside."""
    own = t(spark, d, "events").select(F.col("event_id").cast("int").alias("record_index"), F.date_format("ts", "yyyyMMddHH").alias("raw_file"), F.col("event_type").alias("source_id"))
    _, q = readings.parse_readings(_source_text(spark, d).drop("raw_file", "source_id").join(own, "record_index"))
    return readings.tallies(q, ["source_id"])


@query(
    f"""WITH {TEXT} SELECT record_index, wall - INTERVAL 1 HOUR AS reading_at, CAST(strftime(wall, '%Y%m%d') AS INTEGER) AS date_key, CASE WHEN regexp_full_match(lat, '[+-]?[0-9]+([.][0-9]+)?') THEN CAST(lat AS DECIMAL(10,7)) END AS latitude,
 CASE WHEN regexp_full_match(n, '[0-9]+') THEN TRY_CAST(n AS INTEGER) END AS available_spaces, round((epoch_us(ingested_at) - epoch_us(wall - INTERVAL 1 HOUR)) / 60e6, 6) AS age_minutes, ingested_at AS sent_at FROM typed WHERE wall IS NOT NULL"""
)
def rules_in_sql(spark, d):
    """The feed's text typed by a query that is written in SQL."""
    sql.register(spark)
    src = _source_text(spark, d).withColumn("sent", F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    return spark.sql(
        """WITH typed AS (SELECT *, TO_TIMESTAMP_NTZ(CAST(TRY_TO_TIMESTAMP(CONCAT(Dato, ' ', Klokkeslett), 'dd.MM.yyyy HH:mm') AS STRING)) AS wall FROM {src}),
        timed AS (SELECT *, utc_of(wall, 'Europe/Oslo', ingested_at) AS at FROM typed WHERE wall IS NOT NULL)
        SELECT record_index, CAST(at AS TIMESTAMP_NTZ) AS reading_at, date_key_of(CAST(wall AS DATE)) AS date_key, decimal_of(Latitude) AS latitude, count_of(Antall_ledige_plasser) AS available_spaces,
        ROUND(exact_minutes(ingested_at, at), 6) AS age_minutes, CAST(instant_of(sent) AS TIMESTAMP_NTZ) AS sent_at FROM timed""",
        src=src,
    )


@query(
    """WITH o AS (SELECT user_id, ts AS a, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events), s AS (SELECT *, CASE WHEN b IS NULL THEN a + INTERVAL 5 MINUTE ELSE least(b, a + INTERVAL 25 MINUTE) END AS upto FROM o),
 c AS (SELECT *, unnest(generate_series(date_trunc('hour', a), date_trunc('hour', upto - INTERVAL 1 MICROSECOND), INTERVAL 1 HOUR)) AS hour_start FROM s WHERE upto > a)
 SELECT user_id, hour_start, CAST(sum(epoch_us(least(upto, hour_start + INTERVAL 1 HOUR)) - epoch_us(greatest(a, hour_start))) AS BIGINT) AS covered_us FROM c GROUP BY ALL"""
)
def intervals_in_sql(spark, d):
    """Hours that the events of a user cover, each until the next one and 25 minutes at most, in SQL."""
    sql.register(spark)
    return spark.sql(
        """WITH o AS (SELECT user_id, event_id, CAST(ts AS TIMESTAMP) AS a FROM {events}),
        s AS (SELECT user_id, a, covered_to(LEAD(a) OVER (PARTITION BY user_id ORDER BY a, event_id), a + INTERVAL '5' MINUTE, INTERVAL '20' MINUTE) AS upto FROM o),
        h AS (SELECT *, hours_of(a, upto) AS hours FROM s),
        c AS (SELECT user_id, a, upto, hour_start FROM h LATERAL VIEW EXPLODE(hours) AS hour_start)
        SELECT user_id, CAST(hour_start AS TIMESTAMP_NTZ) AS hour_start, SUM(micros_within_hour(a, upto, hour_start)) AS covered_us FROM c GROUP BY user_id, hour_start""",
        events=t(spark, d, "events"),
    )


@query(f"WITH {SHOUR} SELECT u + 1 AS facility_key, hour_start, round(avg_spaces, 6) AS avg_spaces, covered, counted, stale FROM sh")
def hourly_from_buckets(spark, d):
    """The hours of the feed from fetches that are bucketed by facility and month."""
    fetches = buckets.write(stalled(spark, d), f"fetch_{uuid.uuid4().hex}", scratch.new(spark, "buckets"))
    first, _ = readings.deduplicate(fetches)
    periods = scratch.save(readings.stale_periods(readings.freshness(fetches)), "periods")
    h = facts.hourly(facts.availability(first, fetches, dim(spark, d), periods, facts.Glitch(30, 5)), periods, 20)
    return h.select("facility_key", ntz("hour_start").alias("hour_start"), F.round("avg_spaces", 6).alias("avg_spaces"), minutes_to_us("covered_minutes").alias("covered"), minutes_to_us("counted_minutes").alias("counted"), minutes_to_us("stale_minutes").alias("stale"))
