"""Readings of a polled feed: typed parse with quarantine, first-wins deduplication, freshness and stale periods.

Everything is keyed by source as well as entity, so several feeds can share the tables. Windows are per entity, except
for freshness, whose window is per source over snapshots (one row per fetch).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrain.functions.parse import count_of, decimal_of, missing
from tidegrain.functions.time import MICROS_A_MINUTE, minutes, whole_second_minutes, with_instants
from tidegrain.schemas import FIRST, QUARANTINE, READING, SNAPSHOT, STALE_PERIOD, conform


@dataclass(frozen=True)
class FeedSpec:
    """How a feed names and writes its fields. The defaults are the source's own field names and tokens (fixed values)."""

    entity: str = "Sted"
    date: str = "Dato"
    clock: str = "Klokkeslett"
    latitude: str = "Latitude"
    longitude: str = "Longitude"
    count: str = "Antall_ledige_plasser"
    format: str = "dd.MM.yyyy HH:mm"
    zone: str = "Europe/Oslo"
    tokens: dict = field(default_factory=lambda: {"Fullt": "0", "Open": "open"})

    @property
    def fields(self) -> list[str]:
        return [self.date, self.clock, self.entity, self.latitude, self.longitude, self.count]


LINEAGE = ["source_id", "raw_file", "record_index", "ingested_at"]
#: Writes a frame that two results come from and reads it back; without one, each result is a plan of its own.
Keep = Callable[[DataFrame], DataFrame]


def parse_readings(bronze: DataFrame, spec: FeedSpec = FeedSpec(), keep: Keep | None = None) -> tuple[DataFrame, DataFrame]:
    """Typed readings, and a quarantine row for each bad value, in one pass over bronze each, or one in all with keep.

    A row without a usable time or entity is no reading (reading_excluded), but all of its bad values are quarantined. A field that bronze
    lacks is null everywhere.
    """
    raw = {n: (F.col(f"`{n}`") if n in bronze.columns else F.lit(None).cast("string")) for n in spec.fields}
    wall_text = F.concat(raw[spec.date], F.lit(" "), raw[spec.clock])
    zero = [t for t, v in spec.tokens.items() if v == "0"]
    open_ = [t for t, v in spec.tokens.items() if v == "open"]
    count = raw[spec.count]
    typed = bronze.select(
        *LINEAGE,
        *[c.alias(f"_{i}") for i, c in enumerate(raw.values())],
        F.try_to_timestamp(wall_text, F.lit(spec.format)).alias("_wall"),
        raw[spec.entity].alias("facility"),
        decimal_of(raw[spec.latitude]).alias("latitude"),
        decimal_of(raw[spec.longitude]).alias("longitude"),
        F.when(count.isin(zero), F.lit(0)).otherwise(count_of(count)).alias("available_spaces"),
        F.coalesce(count.isin(open_), F.lit(False)).alias("_open"),
    )
    typed = with_instants(typed, "_wall", spec.zone, "ingested_at", "reading_at", "dst_resolved")
    typed = typed.withColumn("status", F.when(F.col("available_spaces").isNotNull(), "numeric").when(F.col("_open"), "open").otherwise("unknown"))
    typed = keep(typed) if keep else typed
    sound = F.col("reading_at").isNotNull() & ~missing(F.col("facility"))
    # explode drops the rows that aren't sound: as a filter the condition would be pushed below the projections, which repeats
    # their zone lookups some forty times a row
    readings = typed.select("*", F.explode(F.when(sound, F.array(F.lit(0)))).alias("_one")).withColumns(
        {
            "reading_date": F.to_date("_wall"),
            "reading_minute_of_day": F.hour("_wall") * 60 + F.minute("_wall"),
            "utc_offset_minutes": ((F.unix_micros("_wall") - F.unix_micros("reading_at")) / MICROS_A_MINUTE).cast("int"),
        }
    )
    d, k, e, la, lo, n = (F.col(f"_{i}") for i in range(6))
    bad = lambda name, value, reason: F.struct(F.lit(name).alias("field"), value.alias("raw_value"), reason.alias("reason"))
    number = lambda c, typed_: F.when(missing(c), "missing_value").when(typed_.isNull(), "not_a_decimal")
    rules = F.array(
        bad(f"{spec.date} {spec.clock}", F.concat_ws(" ", d, k), F.when(missing(d) | missing(k), "missing_value").when(F.col("_wall").isNull(), "invalid_date_time").when(F.col("reading_at").isNull(), "nonexistent_local_time")),
        bad(spec.entity, e, F.when(missing(e), "missing_value")),
        bad(spec.latitude, la, number(la, F.col("latitude"))),
        bad(spec.longitude, lo, number(lo, F.col("longitude"))),
        bad(spec.count, n, F.when(missing(n), "missing_value").when(F.col("available_spaces").isNull() & ~F.col("_open"), "not_a_count")),
    )
    quarantine = typed.select(*LINEAGE, (~sound).alias("reading_excluded"), F.explode(F.filter(rules, lambda x: x["reason"].isNotNull())).alias("q")).select(*LINEAGE, "reading_excluded", "q.*")
    return conform(readings, READING), conform(quarantine, QUARANTINE)


#: The columns in which two records of one reading can conflict.
COMPARED = ["latitude", "longitude", "available_spaces", "status"]


def compared_values(spec: FeedSpec, of: str = "") -> Column:
    """The values in which two records of one reading can conflict, as text; of: a struct that holds them."""
    c = lambda n: F.col(f"{of}.{n}" if of else n)
    shown = F.when(c("status") == "open", next((t for t, v in spec.tokens.items() if v == "open"), "open")).otherwise(c("available_spaces").cast("string"))
    pair = lambda n, v: F.struct(F.lit(n).alias("field"), v.alias("raw_value"))
    return F.array(pair(spec.latitude, c("latitude").cast("string")), pair(spec.longitude, c("longitude").cast("string")), pair(spec.count, shown))


def by_entity(fetches: DataFrame) -> DataFrame:
    """fetches dealt by facility and month (_part): one shuffle that serves the windows of deduplicate() and availability(), and
    that a facility with most of the rows doesn't bring to one task."""
    return fetches.withColumn("_part", F.date_trunc("MONTH", "reading_at")).repartition("facility", "_part")


def deduplicate(fetches: DataFrame, spec: FeedSpec = FeedSpec(), keep: Keep | None = None) -> tuple[DataFrame, DataFrame]:
    """The first fetched record of each (source, facility, reading_at), with the time of the last fetch of that reading, and a
    conflict row for each value in which a later one differs.

    One window gives all: the rank, the last fetch, and the winner's values beside every loser, so there is no self-join.
    """
    part = [c for c in fetches.columns if c == "_part"]  # the month goes along, see by_entity()
    order = Window.partitionBy("source_id", "facility", "reading_at", *part).orderBy(F.col("ingested_at").asc_nulls_first(), F.col("raw_file").asc_nulls_first(), F.col("record_index").asc_nulls_first())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = fetches.withColumns({"_rank": F.row_number().over(order), "last_fetched_at": F.max("ingested_at").over(whole)})
    # the winner's plain values go beside a loser, and become text there only: most rows have no other of their reading
    beside = lambda df: df.withColumn("_winner", F.first(F.struct(*COMPARED)).over(order)).withColumn("_winner", F.when(F.col("_rank") > 1, F.col("_winner")))
    ranked = keep(beside(ranked)) if keep else ranked
    readings = ranked.where("_rank = 1")
    seen = (ranked if keep else beside(ranked)).where("_rank > 1").withColumns({"_own": compared_values(spec), "_won": compared_values(spec, "_winner")})
    differ = F.filter(F.zip_with("_own", "_won", lambda a, b: F.when(~a["raw_value"].eqNullSafe(b["raw_value"]), a)), lambda x: x.isNotNull())
    conflicts = seen.select(*LINEAGE, F.explode(differ).alias("q")).select(*LINEAGE, "q.*", F.lit("conflicting_duplicate").alias("reason"), F.lit(False).alias("reading_excluded"))
    return readings.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FIRST], *part), conform(conflicts, QUARANTINE)


def freshness(fetches: DataFrame, stale_after_minutes: float = 15) -> DataFrame:
    """One row per fetched snapshot: its newest source time, its age when fetched, and whether that is over the limit."""
    per = fetches.groupBy("source_id", "raw_file", "ingested_at").agg(F.max("reading_at").alias("source_reading_at"))
    age = whole_second_minutes(F.col("ingested_at"), F.col("source_reading_at"))
    return conform(per.withColumn("age_minutes", age).withColumn("is_stale", age > F.lit(float(stale_after_minutes))), SNAPSHOT)


def stale_periods(snapshots: DataFrame, stale_after_minutes: float = 15) -> DataFrame:
    """Runs of stale snapshots that show one source time (gaps and islands)."""
    w = Window.partitionBy("source_id").orderBy("ingested_at", "raw_file")
    before_stale, before_at = F.lag("is_stale", 1, False).over(w), F.lag("source_reading_at").over(w)
    starts = F.col("is_stale") & (~before_stale | ~F.col("source_reading_at").eqNullSafe(before_at))
    run = snapshots.withColumn("_starts", F.coalesce(starts, F.lit(False)).cast("int"))
    run = run.withColumns({"_island": F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, 0)), "_last": F.max("ingested_at").over(Window.partitionBy("source_id"))})
    per = run.where("is_stale").groupBy("source_id", "_island").agg(
        F.min("source_reading_at").alias("source_reading_at"),
        F.min("ingested_at").alias("first_stale_fetch_at"),
        F.max("ingested_at").alias("last_stale_fetch_at"),
        F.count("*").alias("fetch_count"),
        F.bool_or(F.col("ingested_at") == F.col("_last")).alias("ongoing"),
    )
    return conform(per.withColumn("stale_from", F.col("source_reading_at") + minutes(stale_after_minutes)), STALE_PERIOD)


def tallies(quarantine: DataFrame, by: list[str]) -> DataFrame:
    """How much is quarantined: values, rows with a bad value, rows that are no reading at all (excluded), and raw files with either.

    Rows are counted once however many of their values are bad. The distinct counts are one pass: Spark expands each row once for each.
    """
    row = F.struct("source_id", "raw_file", "record_index")
    return quarantine.groupBy(*by).agg(
        F.count("*").alias("quarantined"), F.count_distinct(row).alias("rows_quarantined"), F.count_distinct(F.when(F.col("reading_excluded"), row)).alias("excluded"), F.count_distinct("source_id", "raw_file").alias("files_quarantined")
    )
