"""Measures that don't add, with their subtotals and totals.

A latest value or a time-weighted average of a group isn't the sum of its parts: each level of the grouping takes the value per
facility first and adds over facilities then. So facts are brought down once to states that can be merged, a row for each
facility and finest group; the states are expanded over the grouping sets, merged per facility and level, and finished there.
The facts are read once, and what is expanded grows with facilities and groups, not with readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrain.functions.time import micros_of
from tidegrain.plans.measures import FRESH_SHARE

#: How two states of one facility become one.
MERGE = {"latest": F.max, "readings": F.sum, "weighted": F.sum, "counted": F.sum, "weighted_fresh": F.sum, "counted_fresh": F.sum, "covered": F.sum, "stale": F.sum}


def latest_states(avail: DataFrame, by: list[str]) -> DataFrame:
    """States of the availability fact: the latest reading, and how many there are."""
    latest = F.max(F.struct("valid_from", "last_fetched_at", "source_id", "available_spaces"))
    return avail.groupBy(*by, "facility_key").agg(latest.alias("latest"), F.count("*").alias("readings"))


def hourly_states(hourly: DataFrame, by: list[str]) -> DataFrame:
    """States of the hourly fact: sums for the averages, over all hours and over those that aren't stale for most of their time."""
    known = F.col("avg_spaces").isNotNull()
    fresh = known & (F.col("stale_minutes") <= FRESH_SHARE * F.col("covered_minutes"))
    total = F.col("avg_spaces") * F.col("counted_minutes")
    return hourly.groupBy(*by, "facility_key").agg(
        F.sum(F.when(known, total)).alias("weighted"), F.sum(F.when(known, F.col("counted_minutes"))).alias("counted"),
        F.sum(F.when(fresh, total)).alias("weighted_fresh"), F.sum(F.when(fresh, F.col("counted_minutes"))).alias("counted_fresh"),
        F.sum(micros_of(F.col("covered_minutes"))).alias("covered"), F.sum(micros_of(F.col("stale_minutes"))).alias("stale"),
    )


def merged(states: DataFrame, by: list[str], sets: list[list[str]]) -> DataFrame:
    """The states of each facility on each of the grouping sets. ``level`` has a bit for each column of ``by``, the first the
    highest, set where the column is rolled up; so a null of the data isn't taken for a total."""
    own = [MERGE[c](c).alias(c) for c in states.columns if c in MERGE]
    out = states.groupingSets([[*s, "facility_key"] for s in sets], *by, "facility_key").agg(*own, F.grouping_id().alias("_id"))
    return out.withColumn("level", F.shiftright("_id", 1).cast("int")).drop("_id")  # the lowest bit is the facility's, always kept


def _occupied(v: Column, name: str) -> Column:
    both = v.isNotNull() & F.col("capacity").isNotNull()
    return F.try_divide(F.sum(F.when(both, F.col("capacity") - v)), F.sum(F.when(both, F.col("capacity")))).alias(name)


def latest_totals(states: DataFrame, dim: DataFrame, by: list[str], sets: list[list[str]]) -> DataFrame:
    """Free spaces and occupancy at the latest reading, and the number of readings, on each level."""
    per = merged(states, by, sets).join(dim.select("facility_key", "capacity"), "facility_key", "left")
    v = F.col("latest.available_spaces")
    return per.groupBy(*by, "level").agg(F.sum(v).cast("long").alias("free_spaces_latest"), _occupied(v, "occupancy_latest"), F.sum("readings").alias("readings"))


def hourly_totals(states: DataFrame, dim: DataFrame, by: list[str], sets: list[list[str]]) -> DataFrame:
    """Average free spaces, occupancy (of all hours and of fresh ones) and share of stale time on each level."""
    per = merged(states, by, sets).join(dim.select("facility_key", "capacity"), "facility_key", "left")
    all_, fresh = F.try_divide("weighted", "counted"), F.try_divide("weighted_fresh", "counted_fresh")
    return per.groupBy(*by, "level").agg(
        F.sum(all_).alias("free_spaces_avg"), _occupied(all_, "occupancy"), _occupied(fresh, "occupancy_fresh"), F.try_divide(F.sum("stale"), F.sum("covered")).alias("stale_share")
    )
