"""Raw JSON snapshots and their sidecars into bronze rows, each file once, with bad files as issues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.schemas import LOAD_ISSUE, OUTAGE, conform
from tidegrain.sources.store import TableStore

META = ["source_id", "raw_file", "record_index", "ingested_at", "source_url", "resource_id", "run_id", "content_hash", "values_fingerprint", "polling_mode", "next_due", "loaded_at"]
SIDECAR = ["source_url", "resource_id", "run_id", "content_hash", "values_fingerprint", "polling_mode", "next_due"]


#: Raw files that one step of a load reads and commits.
STEP = 20_000


def text_files(spark: SparkSession, root: str, base: str | None = None) -> DataFrame:
    """path (below base, or root) and value of every JSON file below root, each file one row."""
    raw = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(root)
    return with_path(raw.select("value", F.col("_metadata.file_path").alias("file")), base or root)


def with_path(raw: DataFrame, root: str) -> DataFrame:
    """The column file as path below root; other columns stay."""
    tail = F.regexp_replace("file", "^[a-z]+:/+", "/")
    base = root.split(":", 1)[-1].rstrip("/")
    return raw.select(F.substring_index(tail, base + "/", -1).alias("path"), *raw.columns)


def listed(spark: SparkSession, root: str, base: str | None = None) -> DataFrame:
    """path and file of every JSON file below root; the files aren't opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(root)
    return with_path(found.select(F.col("path").alias("file")), base or root)


def unhandled(rows: DataFrame, handled: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key (source included, where there are several) isn't among the handled ones."""
    return rows.join(handled.select(keys).distinct(), keys, "left_anti")


def sidecars_of(spark: SparkSession, files: list[str]) -> list[str]:
    """The sidecars that are there of a few raw files, each looked up by its path."""
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    meta = [f.removesuffix(".json") + ".meta.json" for f in files]
    return [m for m in meta if (p := fs.Path(m)).getFileSystem(conf).exists(p)]


def read_files(spark: SparkSession, files: list[str], base: str) -> DataFrame:
    """path and value of these files."""
    raw = spark.read.format("text").option("wholetext", True).load(files)
    return with_path(raw.select("value", F.col("_metadata.file_path").alias("file")), base).select("path", "value")


def classify(files: DataFrame, source: str) -> DataFrame:
    """raw_file, source_id, ingested_at, the sidecar's fields, records, reason (null: sound) and detail of every raw file.

    A file lacks its sidecar, or has an unreadable one, or isn't a list of objects, or is an empty list: the first that
    holds is its reason. The detail says which sidecar is missing, what its time is, or how many records are no objects.
    """
    side = F.col("path").endswith(".meta.json")
    raw = files.where(~side).select(F.col("path").alias("raw_file"), "value", F.regexp_replace("path", r"\.json$", "").alias("_stem"))
    meta = files.where(side).select(F.regexp_replace("path", r"\.meta\.json$", "").alias("_stem"), F.col("value").alias("_meta"))
    j = raw.join(meta, "_stem", "left").withColumn("records", F.from_json("value", "array<map<string,string>>"))
    of = lambda n: F.get_json_object("_meta", f"$.{n}")
    at = F.try_to_timestamp(of("ingested_at"))
    reason = F.when(F.col("_meta").isNull(), "missing_sidecar").when(at.isNull(), "unreadable_sidecar").when(F.col("records").isNull() | F.exists("records", lambda x: x.isNull()), "unreadable_payload").when(F.size("records") == 0, "no_records")
    odd = F.concat(F.size(F.filter("records", lambda x: x.isNull())), F.lit(" of "), F.size("records"), F.lit(" records are no objects"))
    j = j.select("*", F.lit(source).alias("source_id"), at.alias("ingested_at"), *[of(n).alias(n) for n in SIDECAR], reason.alias("reason"))
    detail = (
        F.when(F.col("reason") == "missing_sidecar", F.concat("_stem", F.lit(".meta.json")))
        .when(F.col("reason") == "unreadable_sidecar", F.concat(F.lit("ingested_at: "), F.coalesce(of("ingested_at"), F.lit("none"))))
        .when(F.col("reason") == "unreadable_payload", F.coalesce(odd, F.lit("no list of objects")))
        .when(F.col("reason") == "no_records", "0 records")
    )
    return j.select("raw_file", "source_id", "ingested_at", *SIDECAR, "records", "reason", detail.alias("detail"))


def rows(sound: DataFrame) -> DataFrame:
    """A row per record: the lineage columns and fields, a map of every source field as text."""
    due = F.try_to_timestamp("next_due").alias("next_due")
    return sound.select("source_id", "raw_file", "ingested_at", *SIDECAR[:-1], due, F.current_timestamp().alias("loaded_at"), F.posexplode("records").alias("record_index", "fields"))


def widen(bronze: DataFrame, fields: list[str]) -> DataFrame:
    """fields as columns of their own; one that no record has is null. A field named as a lineage column is an error."""
    if clash := set(fields) & set(META):
        raise ValueError(f"source fields named as lineage columns: {sorted(clash)}")
    return bronze.select("*", *[F.try_element_at("fields", F.lit(f)).alias(f) for f in fields]).drop("fields")


def store_files(store: TableStore, files: DataFrame, source: str, table: str) -> tuple[int, int]:
    """Appends the rows and then the issues of raw files; each file is parsed once."""
    parsed = store.staged(classify(files, source))
    n = store.append_counted(table, rows(parsed.where("reason is null")))
    m = store.append_counted(f"{table}_load_issues", conform(parsed.where("reason is not null").withColumn("detected_at", F.current_timestamp()), LOAD_ISSUE))
    store.unstage()
    return n, m


def handled_files(store: TableStore, source: str, table: str) -> DataFrame:
    """raw_file of this source's files that bronze or its issues hold."""
    have = store.spark.createDataFrame([], "raw_file string")
    for done in (table, f"{table}_load_issues"):
        if store.exists(done):
            have = have.union(store.read(done).where(F.col("source_id") == source).select("raw_file"))
    return have


def load(store: TableStore, raw_root: str, source: str, table: str, base: str | None = None) -> tuple[int, int]:
    """Loads the files that neither bronze nor its issues hold yet: rows first, then issues. Returns their numbers.

    Files are listed first, without opening them; only new ones are read, once, in steps of STEP files in path order, so the
    driver holds the paths of one step. A load that dies goes on with the step that it was at.
    """
    found = listed(store.spark, raw_root, base)
    side = F.col("path").endswith(".meta.json")
    meta = found.where(side).select(F.regexp_replace("path", r"\.meta\.json$", ".json").alias("raw_file"), F.col("file").alias("meta"))
    new = found.where(~side & ~F.col("path").contains("unavailable/")).withColumnRenamed("path", "raw_file")
    new = unhandled(new, handled_files(store, source, table), ["raw_file"]).join(meta, "raw_file", "left").orderBy("raw_file")
    n = m = 0
    step: list[str] = []

    def flush() -> None:
        nonlocal n, m
        if step or not (n + m or store.exists(table)):
            files = read_files(store.spark, step, base or raw_root) if step else store.spark.createDataFrame([], "path string, value string")
            a, b = store_files(store, files, source, table)
            n, m = n + a, m + b
            step.clear()

    for r in new.select("file", "meta").toLocalIterator():
        step += [f for f in r if f]
        if len(step) >= 2 * STEP:
            flush()
    flush()
    return n, m


def outages(files: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Outage records, and the paths of files that aren't such."""
    j = files.withColumn("r", F.from_json("value", "source_id string, observed_at string, source_url string, run_id string, http_status string"))
    j = j.withColumns({"observed_at": F.try_to_timestamp("r.observed_at"), "http_status": F.col("r.http_status").try_cast("int"), "source_url": F.col("r.source_url"), "run_id": F.col("r.run_id"), "raw_file": F.col("path"), "source_id": F.lit(source)})
    ok = F.col("observed_at").isNotNull() & F.col("http_status").isNotNull()
    return conform(j.where(ok), OUTAGE), j.where(~ok).select("raw_file")
