"""Report measures over the star schema: measure(facts, by=[...]) for any grouping of a fact joined to its dimensions.

Semi-additive measures take the latest or the time-weighted value per facility first and add over facilities then. Of readings
of one time the one fetched last is the latest, then that of the greatest source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.functions.time import MICROS_A_MINUTE, micros_of

FRESH_SHARE = 0.5
ATTRIBUTION = "Contains open data under the Norwegian licence for Open Government data (NLOD)"


def free_spaces_latest(avail: DataFrame, by: list[str]) -> DataFrame:
    per = avail.groupBy(*by, "facility_key").agg(F.max_by("available_spaces", F.struct("valid_from", "last_fetched_at", "source_id")).alias("v"))
    return per.groupBy(*by).agg(F.sum("v").cast("long").alias("free_spaces_latest"))


def capacity(dim: DataFrame, by: list[str]) -> DataFrame:
    per = dim.groupBy(*by, "facility_key").agg(F.max("capacity").alias("v"))
    return per.groupBy(*by).agg(F.sum("v").cast("long").alias("capacity"))


def occupancy_latest(avail: DataFrame, dim: DataFrame, by: list[str]) -> DataFrame:
    """(capacity - free) / capacity over facilities that have both."""
    per = avail.groupBy(*by, "facility_key").agg(F.max_by("available_spaces", F.struct("valid_from", "last_fetched_at", "source_id")).alias("v")).join(dim.select("facility_key", "capacity"), "facility_key")
    return per.where("v is not null and capacity is not null").groupBy(*by).agg(F.try_divide(F.sum(F.col("capacity") - F.col("v")), F.sum("capacity")).alias("occupancy_latest"))


def readings(avail: DataFrame, by: list[str]) -> DataFrame:
    return avail.groupBy(*by).agg(F.count("*").alias("readings"))


def data_age_minutes(avail: DataFrame, by: list[str]) -> DataFrame:
    """Minute boundaries between the newest source time and the newest fetch, each taken on its own."""
    minute = lambda c: F.floor(F.unix_micros(F.max(c)) / 60_000_000)
    return avail.groupBy(*by).agg((minute("last_fetched_at") - minute("valid_from")).cast("long").alias("data_age_minutes"))


def source_status(avail: DataFrame, by: list[str]) -> DataFrame:
    stale = F.coalesce(F.bool_or(F.col("valid_to").isNull() & F.col("is_stale")), F.lit(False))
    return avail.groupBy(*by).agg(F.when(stale, "Stale").otherwise("Fresh").alias("source_status"))


def free_spaces_avg(hourly: DataFrame, by: list[str]) -> DataFrame:
    per = _averages(hourly, by)
    return per.groupBy(*by).agg(F.sum("v").alias("free_spaces_avg"))


def _averages(hourly: DataFrame, by: list[str]) -> DataFrame:
    known = F.col("avg_spaces").isNotNull()
    v = F.try_divide(F.sum(F.when(known, F.col("avg_spaces") * F.col("counted_minutes"))), F.sum(F.when(known, F.col("counted_minutes"))))
    return hourly.groupBy(*by, "facility_key").agg(v.alias("v"))


def extremes(hourly: DataFrame, by: list[str]) -> DataFrame:
    return hourly.groupBy(*by).agg(F.min("min_spaces").alias("free_spaces_min"), F.max("max_spaces").alias("free_spaces_max"))


def occupancy(hourly: DataFrame, dim: DataFrame, by: list[str], fresh_only: bool = False) -> DataFrame:
    """Time-weighted occupancy; fresh_only leaves out hours that are stale for more than half of their covered time."""
    h = hourly.where(F.col("stale_minutes") <= FRESH_SHARE * F.col("covered_minutes")) if fresh_only else hourly
    per = _averages(h, by).join(dim.select("facility_key", "capacity"), "facility_key").where("v is not null and capacity is not null")
    return per.groupBy(*by).agg(F.try_divide(F.sum(F.col("capacity") - F.col("v")), F.sum("capacity")).alias("occupancy_fresh" if fresh_only else "occupancy"))


def coverage(hourly: DataFrame, by: list[str]) -> DataFrame:
    """Covered and stale time: exact as microseconds, which minutes, being fractions, are to some fifteen digits only."""
    us = hourly.groupBy(*by).agg(*[F.sum(micros_of(F.col(f"{c}_minutes"))).alias(f"{c}_us") for c in ("covered", "stale")])
    own = [(F.col(f"{c}_us") / MICROS_A_MINUTE).alias(f"{c}_minutes") for c in ("covered", "stale")]
    return us.select(*by, *own, F.try_divide("stale_us", "covered_us").alias("stale_share"), "covered_us", "stale_us")


def incidents(stale: DataFrame, by: list[str], totals: bool = False) -> DataFrame:
    """Number and days of stale periods; totals adds a row over all, and subtotals of the leading columns."""
    return (stale.rollup(*by) if totals else stale.groupBy(*by)).agg(F.count("*").alias("incidents"), (F.sum("duration_minutes") / 1440).alias("stale_days"), (F.max("duration_minutes") / 1440).alias("longest_days"))


def incidents_with_total(stale: DataFrame) -> DataFrame:
    """Incidents by start with a total row; the end is text on rows and blank on the total."""
    r = stale.rollup("stale_from").agg(F.count("*").alias("incidents"), (F.sum("duration_minutes") / 1440).alias("stale_days"), F.max("stale_until").alias("u"), F.bool_or("ongoing").alias("o"), F.grouping("stale_from").alias("total"))
    ended = F.when(F.col("total") == 0, F.when(F.col("o"), "ongoing").otherwise(F.date_format("u", "yyyy-MM-dd HH:mm")))
    return r.select("stale_from", "incidents", "stale_days", ended.alias("ended"), (F.col("total") == 1).alias("is_total"))


def failed_checks(results: DataFrame, by: list[str]) -> DataFrame:
    """Failed results of the newest run of all, whatever the grouping."""
    last = results.agg(F.max("checked_at").alias("last"))
    return results.join(F.broadcast(last), F.col("checked_at") == F.col("last")).where("not passed").groupBy(*by).agg(F.count("*").alias("failed_checks"))


def attribution(spark) -> DataFrame:
    return spark.range(1).select(F.lit(ATTRIBUTION).alias("attribution"))
