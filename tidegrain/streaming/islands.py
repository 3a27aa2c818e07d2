"""Stale periods as a stream: state per source, with a buffer in which snapshots that come late find their place.

A snapshot waits until the watermark has passed it, so a source's snapshots are taken in the order of their fetches however files
arrive, as long as none is later than ``late``. What is kept of a source is its buffer and the period that is open. A period is sent
out once when it ends; a tick, a row without a file that only says that time has gone on, moves the watermark and sends the open one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegrain.functions.time import minutes
from tidegrain.schemas import STALE_PERIOD, conform

NONE = -(2**62)
OUT = "source_id string, shown long, first long, last long, n int, ongoing boolean"
PROVIDER, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Islands(StatefulProcessor):
    """Runs of stale snapshots that show one source time; times are microseconds."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", "t long, file string, shown long, stale boolean")
        self.run = handle.getValueState("run", "shown long, first long, last long, n int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        new = [tuple(r) for b in rows for r in zip(b["t"].tolist(), b["file"].tolist(), b["shown"].tolist(), b["stale"].tolist(), strict=True)]
        yield self.taken(key, [*self.buffer.get(), *new], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        yield self.taken(key, list(self.buffer.get()), timerValues.getCurrentWatermarkInMs())

    def taken(self, key, rows: list[tuple], watermark: int) -> pd.DataFrame:
        rows.sort(key=lambda r: (r[0], r[1] or ""))
        ready = [r for r in rows if r[0] // 1000 < watermark]
        rest = rows[len(ready) :]
        out, run = [], self.run.get() if self.run.exists() else None
        run = tuple(run) if run else None
        for t, file, shown, stale in ready:
            if not file:  # a tick
                if run:
                    out.append((key[0], *run, True))
                continue
            if run and stale and shown == run[0]:
                run = (shown, run[1], t, run[3] + 1)
                continue
            if run:
                out.append((key[0], *run, False))
            run = (shown, t, t, 1) if stale else None
        if run:
            self.run.update(run)
        elif self.run.exists():
            self.run.clear()
        self.buffer.clear()
        if rest:
            self.buffer.put(rest)
            self.handle.registerTimer(rest[0][0] // 1000)
        return pd.DataFrame(out, columns=["source_id", "shown", "first", "last", "n", "ongoing"])

    def close(self) -> None:
        pass


def periods(snapshots: DataFrame, late: str = "1 hour") -> DataFrame:
    """A stream of (source_id, shown, first, last, n, ongoing) of a stream of snapshots as freshness() makes them."""
    shown = F.coalesce(F.unix_micros("source_reading_at"), F.lit(NONE))
    s = snapshots.withWatermark("ingested_at", late).select("source_id", "ingested_at", F.unix_micros("ingested_at").alias("t"), F.col("raw_file").alias("file"), shown.alias("shown"), F.coalesce("is_stale", F.lit(False)).alias("stale"))
    return s.groupBy("source_id").transformWithStateInPandas(Islands(), OUT, "Append", "EventTime")


def run_available(spark: SparkSession, snapshots: DataFrame, out: str, checkpoint: str, late: str = "1 hour") -> None:
    """Takes in what is new and stops. Each batch has a folder of its own below out, so one that is done again replaces its rows."""

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={number}")

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)  # state of several variables needs it
    try:
        periods(snapshots, late).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)


def read(spark: SparkSession, out: str, stale_after_minutes: float = 15) -> DataFrame:
    """The stale periods so far: of each the fullest row, so one that went on after a tick counts once."""
    p = spark.read.schema(f"{OUT}, batch long").parquet(out)
    latest = F.row_number().over(Window.partitionBy("source_id", "first").orderBy(F.desc("n"), "ongoing"))
    at = lambda c: F.timestamp_micros(F.when(F.col(c) != NONE, F.col(c)))
    p = p.withColumn("r", latest).where("r = 1").select("source_id", at("shown").alias("source_reading_at"), at("first").alias("first_stale_fetch_at"), at("last").alias("last_stale_fetch_at"), F.col("n").alias("fetch_count"), "ongoing")
    return conform(p.withColumn("stale_from", F.col("source_reading_at") + minutes(stale_after_minutes)), STALE_PERIOD)
