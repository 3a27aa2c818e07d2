"""The facility dimension: latest attributes, stable surrogate keys, type-1 merge."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrain import scratch
from tidegrain.schemas import FACILITY, conform

UNKNOWN = "(unknown)"


def attributes(fetches: DataFrame, areas: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row per facility name: its latest known coordinates, first and last sight, whether the newest snapshot of a source
    has it, and its capacity (paid spaces of the newest register, none once deactivated, plus reserved ones) with the time of its change.

    mapping: facility, register_id, reserved_spaces. Of areas with one id in the newest register the last record counts.
    """
    order = F.struct("ingested_at", "raw_file", "record_index")
    known = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct(order.alias("at"), F.col(c).alias("v"))))
    last = F.max(F.struct("ingested_at", "raw_file"))
    per = fetches.groupBy("source_id", F.col("facility").alias("facility_name")).agg(known("latitude").alias("latitude"), known("longitude").alias("longitude"), F.min("ingested_at").alias("first_seen"), last.alias("last"))
    newest = per.groupBy("source_id").agg(F.max("last").alias("newest"))  # a row per source, from a row per source and facility
    per = per.join(newest, per["source_id"].eqNullSafe(newest["source_id"])).groupBy("facility_name").agg(
        F.max("latitude")["v"].alias("latitude"), F.max("longitude")["v"].alias("longitude"), F.min("first_seen").alias("first_seen"), F.max("last.ingested_at").alias("last_seen"), F.bool_or(F.col("last.raw_file") == F.col("newest.raw_file")).alias("is_active")
    )
    last = areas.agg(F.max("ingested_at").alias("_last"))
    now = areas.join(F.broadcast(last), F.col("ingested_at") == F.col("_last")).groupBy("register_id").agg(F.max_by(F.struct(F.when(F.col("deactivated_at").isNull(), F.col("paid_spaces")).alias("paid"), "changed_at"), "record_index").alias("own"))
    m = mapping.select(F.col("facility").alias("facility_name"), "register_id", "reserved_spaces").join(now, "register_id", "left")
    m = m.select("facility_name", "register_id", (F.col("own.paid") + F.coalesce("reserved_spaces", F.lit(0))).alias("capacity"), F.col("own.changed_at").alias("capacity_changed_at"))
    return per.join(m, "facility_name", "left")


def numbered(rows: DataFrame, order: list) -> DataFrame:
    """rows with number, 1 and on in their order. They are dealt by ranges and written, as ranges come from a sample and must
    stay; the driver sees the number of rows of each range only."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = scratch.save(rows.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = {r["_range"]: r["count"] for r in dealt.groupBy("_range").count().collect()}
    before = list(accumulate((sizes.get(i, 0) for i in range(max(sizes, default=0) + 1)), initial=0))
    start = F.element_at(F.lit(before), F.col("_range") + 1)
    return dealt.withColumn("number", start + F.row_number().over(Window.partitionBy("_range").orderBy(*order))).drop("_range")


def assign_keys(attrs: DataFrame, existing: DataFrame, name: str = "facility_name", key: str = "facility_key", order: str = "first_seen") -> DataFrame:
    """attrs with a key each: known names keep theirs, new ones are numbered on in order of first sight and name.

    New names are numbered in range partitions, each from the number of names in those before it, so there may be as many as
    a first load of everything brings. Keys are ints: a dimension holds 2^31 - 1 names at most.
    """
    known = existing.select(name, key)
    top = known.agg(F.greatest(F.coalesce(F.max(key), F.lit(0)), F.lit(0)).alias("_top"))
    new = numbered(attrs.join(known, name, "left_anti").select(name, order), [F.col(order).asc_nulls_first(), F.col(name)])
    new = new.join(F.broadcast(top)).select(name, (F.col("_top") + F.col("number")).cast("int").alias(key))
    return attrs.join(known.withColumn(key, F.col(key).cast("int")).union(new), name)


def merge_type1(target: DataFrame, source: DataFrame, on: str = "facility_name", key: str = "facility_key") -> DataFrame:
    """target after the upsert: matched rows take source's attributes, new ones come in, and rows that source lacks turn
    inactive (not the unknown member). The key of a matched row stays."""
    t, s = target.alias("t"), source.alias("s")
    both = t.join(s, F.col(f"t.{on}") == F.col(f"s.{on}"), "full_outer")
    there, here = F.col(f"s.{on}").isNotNull(), F.col(f"t.{on}").isNotNull()
    cols = []
    for c in target.columns:
        if c in (on, key):
            v = F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        elif c == "is_active":
            v = F.when(there, F.col(f"s.{c}")).when(F.col(f"t.{key}") != -1, F.lit(False)).otherwise(F.col(f"t.{c}"))
        else:
            v = F.when(there, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in source.columns else F.col(f"t.{c}")
        cols.append(v.alias(c))
    return both.where(there | here).select(*cols)


def dim_facility(attrs: DataFrame, existing: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The whole step: keys, merge, and the unknown member -1. keep writes the attributes, which are read more than once, and
    reads them back, so that the fetches behind them are aggregated once."""
    spark, attrs = attrs.sparkSession, keep(attrs)
    unknown = spark.createDataFrame([(-1, UNKNOWN, False)], "facility_key int, facility_name string, is_active boolean")
    base = conform(existing, FACILITY)
    new = conform(assign_keys(attrs, base.where("facility_key <> -1")), FACILITY).unionByName(unknown, allowMissingColumns=True)
    return conform(merge_type1(base, conform(new, FACILITY)), FACILITY)
