"""Data-quality checks: each a small DataFrame of results, unioned by run_checks().

Facility and snapshot checks look at the newest snapshot; time checks at the last 24 hours before the newest fetch, not
before now, so that a rerun gives the same results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrain.schemas import CHECK, conform

SCHEMA = "check string, severity string, subject string, passed boolean, detail string"
CRITICAL, WARNING = "critical", "warning"


@dataclass(frozen=True)
class Box:
    """The area in which coordinates are plausible (fixed values of the served city)."""

    south: float = 58.85
    north: float = 59.05
    west: float = 5.55
    east: float = 5.85


def one(df: DataFrame, check: str, severity: str, passed: Column, detail: Column) -> DataFrame:
    """A single result from a one-row frame."""
    return df.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.lit(None).cast("string").alias("subject"), F.coalesce(passed, F.lit(False)).alias("passed"), detail.cast("string").alias("detail"))


def newest_file(bronze: DataFrame, issues: DataFrame) -> DataFrame:
    return bronze.select("raw_file").union(issues.select("raw_file")).agg(F.max("raw_file").alias("newest"))


def schema_drift(snapshot: DataFrame, expected: list[str], lineage: list[str]) -> DataFrame:
    """An expected field without a value, or a new field with one."""
    own = [c for c in snapshot.columns if c not in lineage]
    counts = snapshot.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in own], F.lit(1).alias("_"))
    lost = F.filter(F.array(*[F.when(F.coalesce(F.col(f"`{c}`"), F.lit(0)) == 0, c) if c in own else F.lit(c) for c in expected]), lambda x: x.isNotNull())
    new = F.filter(F.array(*[F.when(F.col(f"`{c}`") > 0, c) for c in own if c not in expected] or [F.lit(None).cast("string")]), lambda x: x.isNotNull())
    return one(counts, "schema_drift", CRITICAL, (F.size(lost) == 0) & (F.size(new) == 0), F.concat(F.lit("missing: "), F.array_join(lost, ", "), F.lit("; new: "), F.array_join(new, ", ")))


def empty_snapshot(fetches: DataFrame, issues: DataFrame, newest: DataFrame) -> DataFrame:
    of = lambda df, name: df.join(F.broadcast(newest), F.col("raw_file") == F.col("newest")).agg(F.count("*").alias(name))
    both = of(fetches, "n").join(of(issues, "bad"))
    return one(both, "empty_snapshot", CRITICAL, (F.col("bad") == 0) & (F.col("n") > 0), F.format_string("%d records, %d load issues", "n", "bad"))


def facility_count(latest: DataFrame, mapping: DataFrame) -> DataFrame:
    """As many facilities as are mapped; the detail lists both differences."""
    seen = latest.agg(F.collect_set("facility").alias("seen")).join(mapping.agg(F.collect_set("facility").alias("known")))
    detail = F.concat(F.lit("absent: "), F.array_join(F.array_sort(F.array_except("known", "seen")), ", "), F.lit("; extra: "), F.array_join(F.array_sort(F.array_except("seen", "known")), ", "))
    return one(seen, "facility_count", CRITICAL, F.size("seen") == F.size("known"), detail)


def per_facility(latest: DataFrame, facilities: DataFrame, mapping: DataFrame, box: Box = Box()) -> DataFrame:
    """free_exceeds_capacity, unmapped_facility and coordinates_outside_area for each facility of the snapshot, in one pass."""
    j = latest.join(facilities.select(F.col("facility_name").alias("facility"), "capacity"), "facility", "left").join(mapping.select("facility", F.lit(True).alias("_mapped")).distinct(), "facility", "left")
    inside = F.col("latitude").between(box.south, box.north) & F.col("longitude").between(box.west, box.east)
    result = lambda name, severity, ok, detail: F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"), F.col("facility").alias("subject"), ok.alias("passed"), detail.cast("string").alias("detail"))
    both = F.col("available_spaces").isNotNull() & F.col("capacity").isNotNull()
    rows = F.array(
        F.when(both, result("free_exceeds_capacity", CRITICAL, F.col("available_spaces") <= F.col("capacity"), F.concat_ws(" of ", F.col("available_spaces").cast("string"), F.col("capacity").cast("string")))),
        result("unmapped_facility", WARNING, F.coalesce("_mapped", F.lit(False)), F.lit(None)),
        result("coordinates_outside_area", WARNING, F.coalesce(inside, F.lit(False)), F.concat_ws(", ", F.col("latitude").cast("string"), F.col("longitude").cast("string"))),
    )
    return j.select(F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("r")).select("r.*")


def quarantined(quarantine: DataFrame, newest: DataFrame, count_field: str) -> DataFrame:
    """Negative counts, and all other quarantined values, of the newest snapshot."""
    q = quarantine.join(F.broadcast(newest), F.col("raw_file") == F.col("newest"))
    negative = (F.col("field") == count_field) & F.coalesce(F.col("raw_value").rlike(r"^-[0-9]+\z"), F.lit(False))
    n = q.agg(F.count_if(negative).alias("neg"), F.count_if(~negative).alias("rest"))
    return one(n, "negative_available_spaces", WARNING, F.col("neg") == 0, F.col("neg")).union(one(n, "quarantined_values", WARNING, F.col("rest") == 0, F.col("rest")))


def register_missing_areas(areas: DataFrame, mapping: DataFrame) -> DataFrame:
    last = areas.agg(F.max("ingested_at").alias("_last"))
    now = areas.join(F.broadcast(last), F.col("ingested_at") == F.col("_last"))
    lost = mapping.where("register_id is not null").join(now.select("register_id"), "register_id", "left_anti").agg(F.array_sort(F.collect_set("facility")).alias("lost"))
    return one(lost.join(now.agg(F.count("*").alias("n"))), "register_missing_areas", WARNING, (F.size("lost") == 0) & (F.col("n") > 0), F.array_join("lost", ", "))


def source_stale(snapshots: DataFrame, newest: DataFrame) -> DataFrame:
    s = snapshots.join(F.broadcast(newest), F.col("raw_file") == F.col("newest")).agg(F.bool_or("is_stale").alias("stale"), F.max("age_minutes").alias("age"))
    return one(s, "source_stale", WARNING, ~F.coalesce("stale", F.lit(False)), F.concat(F.round("age", 1).cast("string"), F.lit(" minutes old")))


def coverage_grid(hourly: DataFrame, facilities: DataFrame, span: DataFrame) -> DataFrame:
    """covered_minutes of every facility in every hour of a span, a row of (first, last); 0 where hourly has none."""
    each = F.explode(F.sequence("first", "last", F.expr("interval 1 hour")))
    grid = facilities.join(F.broadcast(span)).select(*facilities.columns, each.alias("hour_start"))  # each facility with its hours; the span is one row
    g = grid.join(hourly.select("facility_key", "hour_start", "covered_minutes"), ["facility_key", "hour_start"], "left")
    return g.withColumn("covered_minutes", F.coalesce("covered_minutes", F.lit(0.0)))


def low_coverage(hourly: DataFrame, facilities: DataFrame, until: DataFrame, least: float = 30) -> DataFrame:
    """Active facilities with an hour of under ``least`` covered minutes among the last 24 full hours; a missing hour has 0."""
    now = F.date_trunc("HOUR", "until")
    day = until.select((now - F.expr("interval 24 hours")).alias("first"), (now - F.expr("interval 1 hour")).alias("last"))
    g = coverage_grid(hourly, facilities.where("is_active and facility_key <> -1").select("facility_key", "facility_name"), day)
    low = g.where(F.col("covered_minutes") < least).groupBy("facility_name").agg(F.count("*").alias("n"))
    return counted(low, "facility_name", "low_coverage")


def counted(rows: DataFrame, subject: str, check: str) -> DataFrame:
    """A passed result if rows is empty, else one that lists subjects with their n."""
    each = rows.agg(F.array_sort(F.collect_list(F.struct(F.col(subject).cast("string").alias("s"), "n"))).alias("l"))
    return one(each, check, WARNING, F.size("l") == 0, F.array_join(F.transform("l", lambda x: F.concat_ws(": ", x["s"], x["n"].cast("string"))), ", "))


def recent(df: DataFrame, at: str, until: DataFrame) -> DataFrame:
    return df.join(F.broadcast(until), F.col(at) > F.col("until") - F.expr("interval 24 hours"))


def source_glitches(avail: DataFrame, facilities: DataFrame, until: DataFrame) -> DataFrame:
    g = recent(avail.where("is_source_glitch"), "valid_from", until).groupBy("facility_key").agg(F.count("*").alias("n"))
    return counted(g.join(facilities.select("facility_key", "facility_name"), "facility_key", "left"), "facility_name", "source_glitches")


def collect_failures(runs: DataFrame, until: DataFrame) -> DataFrame:
    return counted(recent(runs, "started_at", until).groupBy("failed_step").agg(F.count("*").alias("n")), "failed_step", "collect_failures")


def source_outages(outages: DataFrame, until: DataFrame) -> DataFrame:
    o = recent(outages, "observed_at", until).groupBy("source_id").agg(F.concat(F.count("*").cast("string"), F.lit(" over "), ((F.unix_micros(F.max("observed_at")) - F.unix_micros(F.min("observed_at"))) / 60_000_000).cast("long").cast("string"), F.lit(" minutes")).alias("n"))
    return counted(o, "source_id", "source_outages")


def run_checks(t: dict[str, DataFrame], expected: list[str], lineage: list[str], count_field: str, box: Box = Box(), shared: bool = True) -> DataFrame:
    """All results. t: bronze, issues, fetches, quarantine, snapshots, areas, mapping, facilities, availability, hourly, runs, outages.

    Facility checks give no rows when the newest snapshot has no fetches. Without ``shared``, checks of tables that aren't one
    feed's (the register, coverage, failed runs) are left to another feed's call. snapshot is the newest raw file that was checked.
    """
    newest = newest_file(t["bronze"], t["issues"])
    until = t["fetches"].agg(F.max("ingested_at").alias("until"))
    latest = t["fetches"].join(F.broadcast(newest), F.col("raw_file") == F.col("newest")).drop("newest")
    snapshot = t["bronze"].join(F.broadcast(newest), F.col("raw_file") == F.col("newest")).drop("newest")
    n = latest.limit(1).count()
    parts = [
        schema_drift(snapshot, expected, lineage), empty_snapshot(t["fetches"], t["issues"], newest), quarantined(t["quarantine"], newest, count_field),
        source_stale(t["snapshots"], newest), source_glitches(t["availability"], t["facilities"], until), source_outages(t["outages"], until),
    ]
    if shared:
        parts += [register_missing_areas(t["areas"], t["mapping"]), low_coverage(t["hourly"], t["facilities"], until), collect_failures(t["runs"], until)]
    if n:
        parts += [facility_count(latest, t["mapping"]), per_facility(latest, t["facilities"], t["mapping"], box)]
    all_ = reduce(DataFrame.unionByName, parts).join(F.broadcast(newest.withColumnRenamed("newest", "snapshot")))
    return conform(all_.withColumn("checked_at", F.current_timestamp()), CHECK)


def report_order(results: DataFrame) -> DataFrame:
    return results.orderBy(F.col("severity") != CRITICAL, "check", F.coalesce("subject", F.lit("")))


