"""One place for the session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "tidegrain", master: str | None = None, cores: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with AQE; ``cores`` sets small shuffle counts for local runs."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    b = b.config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if cores:
        b = b.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(cores))
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
