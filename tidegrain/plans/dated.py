"""Facts kept by local date: a rerun of some dates writes these alone, and a page reads only the dates that its slicer leaves.

The folder of a date is named by date_key, which relates facts to the calendar. A slicer is a filter on dim_date before the join,
so Spark passes the keys that are left to the scan of the fact (dynamic partition pruning) and lists no other folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegrain.schemas import AVAILABILITY, HOURLY

SCHEMAS = {"fact_parking_hourly": HOURLY, "fact_parking_availability": AVAILABILITY}


class Dated:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, table: str, df: DataFrame, salt: int = 1) -> None:
        """Puts df in the place of the rows of its own dates; other dates stay as they are. A date goes to ``salt`` tasks, and so
        files, by hash of the facility: more where a date is more than a task should write. df may not read the table itself."""
        part = ["date_key"] if salt == 1 else ["date_key", F.pmod(F.xxhash64("facility_key"), F.lit(salt))]
        df.repartition(*part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_key").parquet(f"{self.root}/{table}")

    def read(self, table: str) -> DataFrame:
        """The table by its known schema, so no file is opened before the query runs."""
        s = SCHEMAS[table]
        out = StructType([*[f for f in s if f.name != "date_key"], s["date_key"]])
        return self.spark.read.schema(out).parquet(f"{self.root}/{table}").select(*s.names)
