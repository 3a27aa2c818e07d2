"""The availability fact (validity intervals, glitches), the time-weighted hourly fact and the stale-period fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrain.functions.time import MICROS_A_MINUTE, date_key, exact_minutes, local, minutes, whole_second_minutes
from tidegrain.schemas import AVAILABILITY, HOURLY, STALE_FACT, conform


@dataclass(frozen=True)
class Glitch:
    """A value that jumps by min_jump or more and back to within max_neighbour_difference of where it was."""

    max_neighbour_difference: int = 10
    min_jump: int = 50


#: The order of a facility's readings, whichever sources they come from; the last one holds.
ORDER = ["reading_at", "last_fetched_at", "source_id"]


def neighbours(readings: DataFrame, bucket: str = "MONTH", seams: DataFrame | None = None) -> DataFrame:
    """readings with the readings of the facility before and after each (_prev, _next: structs of ORDER, available_spaces, status).

    Windows are by facility and month (another ``bucket``, or the column _part), so that one facility's rows go to many tasks; the
    first and last reading of each month, one row for a facility and month, are put in a row of their own and close the seams.
    Seams that are known (facility, _part, _before, _after) may be given.
    """
    row = F.struct(*ORDER, "available_spaces", "status")
    r = readings if "_part" in readings.columns else readings.withColumn("_part", F.date_trunc(bucket, "reading_at"))
    if seams is None:
        ends = r.groupBy("facility", "_part").agg(F.min(row).alias("_first"), F.max(row).alias("_last"))
        months = Window.partitionBy("facility").orderBy("_part")
        seams = ends.select("facility", "_part", F.lag("_last").over(months).alias("_before"), F.lead("_first").over(months).alias("_after"))
    by = Window.partitionBy("facility", "_part").orderBy(*ORDER)
    r = r.withColumns({"_prev": F.lag(row).over(by), "_next": F.lead(row).over(by)}).join(seams, ["facility", "_part"], "left")
    return r.withColumns({"_prev": F.coalesce("_prev", "_before"), "_next": F.coalesce("_next", "_after")}).drop("_part", "_before", "_after")


def glitch_flag(g: Glitch | None) -> Column:
    """Whether a single reading stands out from both of its neighbours (_prev and _next); null comparisons count as no."""
    if g is None:
        return F.lit(False)
    now, prev, nxt = F.col("available_spaces"), F.col("_prev.available_spaces"), F.col("_next.available_spaces")
    jump = (F.abs(prev - nxt) <= g.max_neighbour_difference) & (F.abs(now - prev) >= g.min_jump) & (F.abs(now - nxt) >= g.min_jump)
    closed = (F.col("_prev.status") == "open") & (F.col("_next.status") == "open") & (F.col("status") == "numeric")
    return F.coalesce(jump, F.lit(False)) | F.coalesce(closed, F.lit(False))


def availability(readings: DataFrame, fetches: DataFrame, facilities: DataFrame, periods: DataFrame, glitch: Glitch | None = Glitch(), also: tuple[str, ...] = ()) -> DataFrame:
    """Readings as validity intervals, with facility key, first and last fetch, staleness and glitch flag.

    A reading holds until the facility's next one, from whichever source, so the intervals of a facility never overlap.
    Columns of ``also`` are carried along, and neighbours that are known (_prev, _next) are taken. Facilities are the small side; an unknown one gets key -1. The last fetch comes with the readings of deduplicate(), or
    from fetches where readings lack it. The stale flag is an existence test on distinct source
    times, so periods never multiply readings.
    """
    stale = periods.select("source_id", F.col("source_reading_at").alias("reading_at")).distinct().withColumn("_stale", F.lit(True))
    dim = facilities.select(F.col("facility_name").alias("facility"), "facility_key", "capacity")
    if "last_fetched_at" not in readings.columns:
        last = fetches.groupBy("source_id", "facility", "reading_at").agg(F.max("ingested_at").alias("last_fetched_at"))
        readings = readings.join(last, ["source_id", "facility", "reading_at"], "left")
    r = readings if "_next" in readings.columns else neighbours(readings)
    r = r.withColumns({"valid_to": F.col("_next.reading_at"), "is_source_glitch": glitch_flag(glitch), "first_ingested_at": F.col("ingested_at")})
    r = r.join(stale, ["source_id", "reading_at"], "left").join(dim, "facility", "left")
    m = F.col("reading_minute_of_day").cast("int")
    r = r.withColumns(
        {
            "facility_key": F.coalesce("facility_key", F.lit(-1)),
            "valid_from": F.col("reading_at"),
            "date_key": date_key(F.col("reading_date")),
            "time_key": F.floor(m / 60) * 100 + m % 60,
            "occupied_spaces": F.col("capacity") - F.col("available_spaces"),
            "duration_minutes": whole_second_minutes(F.col("valid_to"), F.col("reading_at")),
            "is_stale": F.coalesce("_stale", F.lit(False)),
        }
    )
    return r.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in AVAILABILITY], *also)


def covered_to(max_gap_minutes: float) -> Column:
    """How far an interval is evidence: max_gap_minutes past its last fetch at most, and to the last fetch if it is open."""
    return F.when(F.col("valid_to").isNull(), F.col("last_fetched_at")).otherwise(F.least("valid_to", F.col("last_fetched_at") + minutes(max_gap_minutes)))


def hourly(avail: DataFrame, periods: DataFrame, max_gap_minutes: float = 20, zone: str = "Europe/Oslo", also: tuple[str, ...] = ()) -> DataFrame:
    """Intervals cut at UTC hours and averaged by time: one row per facility (and columns ``also``) and hour that evidence covers.

    Hours are generated from each interval, never joined by range. Stale minutes come from one row per source time: the earliest
    start and the latest stale fetch of its periods, so a source time with two periods doesn't double an hour.
    """
    span = periods.groupBy("source_id", F.col("source_reading_at").alias("valid_from")).agg(F.min("stale_from").alias("_s0"), F.max("last_stale_fetch_at").alias("_s1"))
    a = avail.join(span, ["source_id", "valid_from"], "left").withColumn("_to", covered_to(max_gap_minutes)).where(F.col("_to") > F.col("valid_from"))
    hours = F.sequence(F.date_trunc("HOUR", "valid_from"), F.date_trunc("HOUR", F.col("_to") - F.expr("interval 1 microsecond")), F.expr("interval 1 hour"))
    a = a.withColumn("hour_start", F.explode(hours))
    a = a.withColumns({"_a": F.greatest("valid_from", "hour_start"), "_b": F.least("_to", F.col("hour_start") + F.expr("interval 1 hour"))})
    # microseconds are summed as integers, so that sums don't depend on their order
    micros = lambda x, y: F.unix_micros(x) - F.unix_micros(y)
    zero, minute = F.lit(0).cast("long"), F.lit(float(MICROS_A_MINUTE))
    overlap = F.when(F.col("_s0").isNotNull(), F.greatest(zero, micros(F.least("_b", "_s1"), F.greatest("_a", "_s0")))).otherwise(zero)
    a = a.withColumns({"_us": micros(F.col("_b"), F.col("_a")), "_stale": overlap, "_counted": F.col("available_spaces").isNotNull() & ~F.col("is_source_glitch")})
    own = lambda c: F.when(F.col("_counted"), c)
    h = a.groupBy("facility_key", *also, "hour_start").agg(
        F.try_divide(F.sum(own(F.col("available_spaces") * F.col("_us"))), F.sum(own(F.col("_us")))).alias("avg_spaces"),
        F.min(own(F.col("available_spaces"))).alias("min_spaces"),
        F.max(own(F.col("available_spaces"))).alias("max_spaces"),
        F.count("*").alias("observation_count"),
        (F.sum("_us") / minute).alias("covered_minutes"),
        (F.coalesce(F.sum(own(F.col("_us"))), zero) / minute).alias("counted_minutes"),
        (F.sum("_stale") / minute).alias("stale_minutes"),
    )
    wall = local(F.col("hour_start"), zone)
    h = h.withColumns({"date_key": date_key(wall), "hour": F.hour(wall)})
    return h.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in HOURLY], *also)


def stale_fact(periods: DataFrame, zone: str = "Europe/Oslo") -> DataFrame:
    """Stale periods as a fact: no end while a period goes on, exact minutes, keyed by the local date of its start."""
    until = F.when(~F.col("ongoing"), F.col("last_stale_fetch_at"))
    p = periods.withColumns({"stale_until": until, "date_key": date_key(local(F.col("stale_from"), zone)), "duration_minutes": exact_minutes(F.col("last_stale_fetch_at"), F.col("stale_from"))})
    return conform(p, STALE_FACT)
