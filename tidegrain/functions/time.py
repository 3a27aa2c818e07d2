"""Expressions on instants: local wall clocks to UTC, durations, keys. All assume a UTC session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_A_MINUTE = 60_000_000


def as_utc(c: Column) -> Column:
    """An instant of a wall clock column (timestamp_ntz) that is in UTC."""
    return c.cast("timestamp")


def with_instants(df: DataFrame, wall: str, zone: str, not_after: str, at: str, twice: str) -> DataFrame:
    """df with the instant ``at`` of a wall clock column, null where clocks in zone skip it, and whether it had two.

    Of two the later one counts unless it is after ``not_after``. The zone's offset is read two days before and after,
    so that shifts of any size resolve, not only of one hour. Each step is a column of its own, which Catalyst keeps
    apart as they are used more than once: as one expression the zone lookups would be repeated some thirty times a row.
    """
    utc, day = F.col("_utc"), 2 * 24 * 60 * MICROS_A_MINUTE
    df = df.withColumn("_utc", F.unix_micros(F.col(wall).cast("timestamp")))
    shown = lambda us: F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(us), zone))
    df = df.withColumns({"_us0": utc - (shown(utc - day) - (utc - day)), "_us1": utc - (shown(utc + day) - (utc + day))})
    df = df.withColumns({"_ok0": F.when(shown(F.col("_us0")) == utc, F.col("_us0")), "_ok1": F.when(F.col("_us1") == F.col("_us0"), F.lit(None)).when(shown(F.col("_us1")) == utc, F.col("_us1"))})
    df = df.withColumns({"_first": F.timestamp_micros(F.least("_ok0", "_ok1")), "_last": F.timestamp_micros(F.greatest("_ok0", "_ok1"))})
    df = df.withColumns({at: F.when(F.col("_last") <= F.col(not_after), F.col("_last")).otherwise(F.col("_first")), twice: F.col("_first") != F.col("_last")})
    return df.drop("_utc", "_us0", "_us1", "_ok0", "_ok1", "_first", "_last")


def local(at: Column, zone: str) -> Column:
    return F.from_utc_timestamp(at, zone)


def micros_of(c: Column) -> Column:
    """Minutes as whole microseconds, whose sums are exact whatever their order."""
    return F.round(c * MICROS_A_MINUTE).cast("long")


def whole_second_minutes(a: Column, b: Column) -> Column:
    """Minutes from b to a, with the difference cut to whole seconds."""
    return F.expr("0D") + ((F.unix_micros(a) - F.unix_micros(b)) / 1_000_000).cast("long") / 60


def exact_minutes(a: Column, b: Column) -> Column:
    return (F.unix_micros(a) - F.unix_micros(b)) / F.lit(float(MICROS_A_MINUTE))


def date_key(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.day(d)).cast("int")


def minutes(c: float | Column) -> Column:
    """An interval of c minutes."""
    c = F.lit(float(c)) if not isinstance(c, Column) else c
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (c * 60).cast("decimal(18,6)"))
