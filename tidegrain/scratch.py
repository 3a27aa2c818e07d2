"""Where intermediate tables go: the folder that all machines of the cluster share, as the session names it."""

from __future__ import annotations

import atexit
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

_MADE: dict[str, tuple] = {}


def home(spark: SparkSession) -> str:
    """A folder of this application below spark.checkpoint.dir, or below the session's warehouse, which is shared as well,
    where no checkpoint folder is named (as in tests). Never a temporary folder of one machine: on a cluster a warehouse below
    file: isn't taken, as it is the driver's own by default."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and base.split(":")[0] == "file":
            raise ValueError(f"spark.checkpoint.dir isn't set, and the warehouse {base} may be a folder of the driver's machine alone")
    path = f"{base.rstrip('/')}/tidegrain-{spark.sparkContext.applicationId}"
    if path not in _MADE:
        _MADE[path] = spark._jvm, spark._jsc.hadoopConfiguration()
    return path


def new(spark: SparkSession, name: str) -> str:
    return f"{home(spark)}/{name}-{uuid.uuid4().hex}"


def _delete(jvm, conf, path: str) -> None:
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def drop(spark: SparkSession, path: str) -> None:
    _delete(spark._jvm, spark._jsc.hadoopConfiguration(), path)


def save(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes df as Parquet in the shared folder and reads it back, so that lost executors cost no earlier step."""
    spark = df.sparkSession
    path = new(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidegrain_path = path
    return out


def done(*saved: DataFrame) -> None:
    """Drops what save() wrote, once nothing reads it any more."""
    for df in saved:
        drop(df.sparkSession, df._tidegrain_path)


def sweep(spark: SparkSession) -> None:
    """Lets the driver forget shuffles that nothing refers to any more, so that executors delete their files now."""
    gc.collect()  # what Python still refers to stays
    spark._jvm.System.gc()


def _clean() -> None:
    for path, (jvm, conf) in _MADE.items():
        try:
            _delete(jvm, conf, path)
        except Exception:  # the JVM is gone: the cluster's own clean-up of the folder is left
            return


atexit.register(_clean)
