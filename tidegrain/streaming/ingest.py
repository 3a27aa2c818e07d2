"""Bronze ingestion as a stream: each raw file once, by the checkpoint, in as many batches as there are new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.sources import bronze
from tidegrain.sources.store import TableStore


def ingest_available(spark: SparkSession, raw_root: str, store: TableStore, source: str, table: str, checkpoint: str, files_a_batch: int = bronze.STEP) -> None:
    """Loads what is new and stops. A batch that ran before a crash is found by its files, so a rerun adds nothing twice.

    Raw file and sidecar are two files and may fall in two batches: a batch's sidecars are looked up by the paths of its raw
    files (files_a_batch at most), so a raw file whose sidecar comes later is an issue, as in batch loading.
    """
    stream = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files_a_batch).load(raw_root)
    stream = stream.select(F.col("_metadata.file_path").alias("file"))

    def batch(df: DataFrame, _: int) -> None:
        own = bronze.with_path(df, raw_root).where("not endswith(path, '.meta.json')").withColumnRenamed("path", "raw_file")
        own = bronze.unhandled(own, bronze.handled_files(store, source, table), ["raw_file"])
        files = [r["file"] for r in own.select("file").collect()]  # of one batch
        if files:
            bronze.store_files(store, bronze.read_files(spark, files + bronze.sidecars_of(spark, files), raw_root), source, table)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
