"""Fetches as a table bucketed by facility and month, so that deduplication and intervals need no shuffle of the rows.

Rows are dealt once, when they are written. Windows of deduplicate() and neighbours() are by these two columns and more, which the
buckets already keep together; what is shuffled after the scan is one row for each facility and month (the seams) and the
partial sums of hours. The month is in the key so that a facility with most of the rows fills many buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrain.operators import readings

KEY = ["facility", "_part"]


def write(fetches: DataFrame, table: str, path: str, buckets: int | None = None) -> DataFrame:
    """Writes fetches as ``table``, with its files below ``path``, a file for each bucket, and reads it back with the column _part.

    At least as many buckets as there are shuffle partitions (the default), as Spark would rather deal the rows anew than join in
    fewer. The table is known to this session's catalog; drop() forgets it and leaves the files.
    """
    spark = fetches.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = readings.by_entity(fetches).repartition(n, *KEY)
    dealt.write.mode("overwrite").option("path", path).bucketBy(n, *KEY).sortBy(*KEY, "reading_at").saveAsTable(table)
    return spark.table(table)


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{table}`")
