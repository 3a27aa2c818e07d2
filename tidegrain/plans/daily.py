"""Facts kept by day and brought up to date by the keys that a load touches.

All tables are Parquet, partitioned by UTC day (of a reading, an hour or a snapshot), and only the days of a load and its neighbours
are read and written, each day's folder in one move. A load touches facilities on days. Their readings are derived anew
from the fetches of those days; intervals also on the day with readings before and after, as these end or begin anew; and
intervals whose source time a stale period gained or lost. Hours are derived anew on all days that a changed interval covered
or covers, from the intervals of the day and the last one before it: a facility's intervals don't overlap, so no other reaches into it.

ends, one row for a facility and day with its first and last reading, tells which day is before and after another without a look
at the readings. Loads may come in any order and repeat: update() of the same rows changes nothing, so a run that died is done again
with the same rows. Every facility has to be in the dimension; one whose key or capacity has changed since the load before is derived
anew on all of its days. The driver sees the days of a load.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrain import scratch
from tidegrain.operators import facts, readings
from tidegrain.schemas import AVAILABILITY, FIRST, HOURLY, READING, SNAPSHOT

ROW = ["source_id", "raw_file", "record_index"]
KEY = ["facility", "day"]


class Days:
    """Tables of one folder that all machines share, each partitioned by day."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _path(self, tail: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{tail}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def has(self, table: str) -> bool:
        return self._fs().exists(self._path(table))

    def read(self, table: str, schema, days: list[dt.date] | None = None) -> DataFrame:
        """The table, or its partitions of some days, which are all that is listed and opened."""
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != "day")
        if not self.has(table):
            return self.spark.createDataFrame([], f"{ddl}, day date")
        df = self.spark.read.schema(f"{ddl}, day date").parquet(f"{self.root}/{table}")
        return df if days is None else df.where(F.col("day").isin(days))

    def swap(self, table: str, df: DataFrame, days: list[dt.date]) -> None:
        """Puts df in the place of all rows of these days. What it reads may be the table itself: it is written aside, once, and its
        days are moved into their places."""
        fs, aside = self._fs(), f"_aside/{table}-{uuid.uuid4().hex}"
        df.repartition("day").write.partitionBy("day").parquet(f"{self.root}/{aside}")
        fs.mkdirs(self._path(table))
        have = {n for f in fs.listStatus(self._path(aside)) if (n := f.getPath().getName()).startswith("day=")}
        for day in sorted(have | {f"day={d}" for d in days}):  # days that have lost all rows go as well
            to, old = self._path(f"{table}/{day}"), self._path(f"{aside}/_old-{day}")
            if fs.exists(to) and not fs.rename(to, old) or day in have and not fs.rename(self._path(f"{aside}/{day}"), to):
                raise OSError(f"{table}/{day} couldn't be put in place from {aside}")
        fs.delete(self._path(aside), True)

    def add(self, table: str, df: DataFrame) -> None:
        df.repartition("day").write.mode("append").partitionBy("day").parquet(f"{self.root}/{table}")


def days_of(df: DataFrame, column: str = "day") -> list[dt.date]:
    return sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)


def with_day(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("day", F.to_date(column))


class Facts:
    def __init__(self, spark: SparkSession, root: str, glitch: facts.Glitch | None = facts.Glitch(), stale_after: float = 15, max_gap: float = 20, zone: str = "Europe/Oslo"):
        self.days, self.glitch, self.stale_after, self.max_gap, self.zone = Days(spark, root), glitch, stale_after, max_gap, zone
        self.spark = spark

    # tables

    def fetches(self, days=None) -> DataFrame:
        return self.days.read("fetch", READING, days)

    def readings(self, days=None) -> DataFrame:
        return self.days.read("reading", FIRST, days)

    def availability(self, days=None) -> DataFrame:
        return self.days.read("availability", [*AVAILABILITY, FIRST["facility"]], days)

    def hourly(self, days=None) -> DataFrame:
        return self.days.read("hourly", [*HOURLY, FIRST["facility"]], days)

    def snapshots(self, days=None) -> DataFrame:
        return self.days.read("snapshot", SNAPSHOT, days)

    def ends(self, days=None) -> DataFrame:
        one = self.spark.createDataFrame([], FIRST).select("facility", F.struct(*facts.ORDER, "available_spaces", "status").alias("_first"))
        return self.days.read("ends", one.withColumn("_last", F.col("_first")).schema, days)

    # one load

    def update(self, new: DataFrame, dim: DataFrame) -> dict[str, list[dt.date]]:
        """Takes in fetches (typed rows) and returns the days of each table that were written."""
        new = scratch.save(with_day(new.select(*READING.names), "reading_at"), "load")
        days = days_of(new)
        self.days.add("fetch", new.join(self.fetches(days).select(*ROW, "day"), [*ROW, "day"], "left_anti"))
        touched = scratch.save(new.select(*KEY).distinct(), "touched")

        first, _ = readings.deduplicate(self.fetches(days).join(touched, KEY, "left_semi").select(*READING.names))
        own = scratch.save(with_day(first, "reading_at"), "readings")
        self.days.swap("reading", self.readings(days).join(touched, KEY, "left_anti").unionByName(own), days)
        row = F.struct(*facts.ORDER, "available_spaces", "status")
        ends = own.groupBy(*KEY).agg(F.min(row).alias("_first"), F.max(row).alias("_last"))
        self.days.swap("ends", self.ends(days).join(touched, KEY, "left_anti").unionByName(ends), days)

        before, after = self._freshness(new)
        dim = scratch.save(dim.select("facility_name", "facility_key", "capacity"), "dim")
        affected, seams = self._affected(touched, before, after, self._resized(dim))
        changed = days_of(affected)
        old = self.availability(changed).join(affected, KEY, "left_semi")
        r = self.readings(changed).join(affected, KEY, "left_semi").withColumn("_part", F.col("day"))
        r = facts.neighbours(r, seams=seams.withColumnRenamed("day", "_part"))
        avail = scratch.save(facts.availability(r, r, dim, after, self.glitch, ("facility", "day")), "availability")
        hours = scratch.save(self._covered(old.unionByName(avail)), "hours")  # before the old rows go
        self.days.swap("availability", self.availability(changed).join(affected, KEY, "left_anti").unionByName(avail), changed)

        hdays = days_of(hours)
        h = facts.hourly(self._intervals(hours, hdays), after, self.max_gap, self.zone, ("facility",))
        h = with_day(h, "hour_start").join(hours, KEY, "left_semi")
        self.days.swap("hourly", self.hourly(hdays).join(hours, KEY, "left_anti").unionByName(h), hdays)
        dim.write.mode("overwrite").parquet(f"{self.days.root}/dim")  # last, so that a load that died finds the change again
        scratch.done(new, touched, own, before, after, dim, affected, avail, hours)
        return {"reading": days, "availability": changed, "hourly": hdays}

    def _freshness(self, new: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Stale periods before and after the load; snapshots, one row for each fetched file, are few."""
        before = scratch.save(readings.stale_periods(self.snapshots().drop("day"), self.stale_after), "periods")
        days = days_of(with_day(new, "ingested_at"))
        files = new.select("source_id", "raw_file", "ingested_at", "reading_at").unionByName(self.snapshots(days).select("source_id", "raw_file", "ingested_at", F.col("source_reading_at").alias("reading_at")))
        self.days.swap("snapshot", with_day(readings.freshness(files, self.stale_after), "ingested_at"), days)
        return before, scratch.save(readings.stale_periods(self.snapshots().drop("day"), self.stale_after), "periods")

    def _resized(self, dim: DataFrame) -> DataFrame:
        """The facilities that the dimension now gives another key or capacity."""
        if not self.days.has("dim"):
            return dim.limit(0).select(F.col("facility_name").alias("facility"))
        was = self.spark.read.schema(dim.schema).parquet(f"{self.days.root}/dim").select("facility_name", F.col("facility_key").alias("key"), F.col("capacity").alias("size"))
        both = dim.join(was, "facility_name").where(~F.col("key").eqNullSafe(F.col("facility_key")) | ~F.col("size").eqNullSafe(F.col("capacity")))
        return both.select(F.col("facility_name").alias("facility"))

    def _affected(self, touched: DataFrame, before: DataFrame, after: DataFrame, resized: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The facilities and days whose intervals may change; and the seams (_before, _after) of all days of their facilities."""
        span = lambda p: p.select("source_id", "source_reading_at", "stale_from", "last_stale_fetch_at")
        moved = span(before).exceptAll(span(after)).union(span(after).exceptAll(span(before))).select("source_id", F.col("source_reading_at").alias("reading_at")).distinct()
        moved = scratch.save(with_day(moved, "reading_at"), "moved")
        stale = self.readings(days_of(moved)).join(moved, ["source_id", "reading_at", "day"], "left_semi").select(*KEY).distinct()
        sized = self.ends().join(resized, "facility", "left_semi").select(*KEY)
        keys = scratch.save(touched.union(stale).union(sized).distinct(), "keys")
        over = Window.partitionBy("facility").orderBy("day")
        ends = self.ends().join(keys.select("facility").distinct(), "facility", "left_semi")
        line = ends.select(*KEY, F.lag("_last").over(over).alias("_before"), F.lead("_first").over(over).alias("_after"), F.lag("day").over(over).alias("_back"), F.lead("day").over(over).alias("_on"))
        beside = line.join(keys, KEY, "left_semi").select("facility", F.explode(F.array("day", "_back", "_on")).alias("day"))
        affected = scratch.save(beside.where("day is not null").distinct(), "affected")
        scratch.done(moved)
        return affected, line.select(*KEY, "_before", "_after")

    def _covered(self, avail: DataFrame) -> DataFrame:
        """The facilities and days that intervals cover."""
        a = avail.withColumn("_to", facts.covered_to(self.max_gap)).where(F.col("_to") > F.col("valid_from"))
        last = F.to_date(F.col("_to") - F.expr("interval 1 microsecond"))
        return a.select("facility", F.explode(F.sequence(F.to_date("valid_from"), last)).alias("day")).distinct()

    def _intervals(self, hours: DataFrame, days: list[dt.date]) -> DataFrame:
        """The intervals of these facilities and days, and the last one before each."""
        ends = self.ends().join(hours.select("facility").distinct(), "facility", "left_semi")
        both = ends.select(*KEY, F.struct(F.col("day").alias("day"), F.col("_last").alias("last")).alias("own")).unionByName(hours.withColumn("own", F.lit(None)), allowMissingColumns=True)
        both = both.withColumn("n", F.datediff("day", F.lit(dt.date(1970, 1, 1))))
        back = F.last("own", ignorenulls=True).over(Window.partitionBy("facility").orderBy("n").rangeBetween(Window.unboundedPreceding, -1))
        lasts = both.withColumn("back", back).where("own is null and back is not null").select("facility", F.col("back.day").alias("day"), F.col("back.last.reading_at").alias("valid_from"), F.col("back.last.last_fetched_at").alias("last_fetched_at"), F.col("back.last.source_id").alias("source_id")).distinct()
        lasts = scratch.save(lasts, "lasts")
        at = ["facility", "day", "valid_from", "last_fetched_at", "source_id"]
        one = self.availability(days_of(lasts)).join(lasts, at, "left_semi")
        return self.availability(days).join(hours, KEY, "left_semi").unionByName(one).dropDuplicates(at)
