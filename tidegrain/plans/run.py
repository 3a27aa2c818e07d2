"""The whole run: bronze, silver, gold, quality, in order, with an exit code. A rerun on the same files changes nothing.

Exit codes: 0 fine, 1 a step failed (later steps don't run), 2 wrong arguments, 3 a critical check failed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain import schemas as s
from tidegrain.config import Source
from tidegrain.operators import calendar, checks, facility, facts, pricing, readings, register
from tidegrain.plans import daily
from tidegrain.sources import bronze, collector
from tidegrain.sources.store import TableStore

STEP_ERRORS = (OSError, ValueError, RuntimeError, PySparkException)
CONFLICT = "conflicting_duplicate"


@dataclass
class Setup:
    store: TableStore
    raw_root: str
    feed: str = "feed"
    feed_table: str | None = None  # bronze_<feed> where none is named
    base: str | None = None  # the root that raw_file paths start from, if it isn't raw_root
    register_root: str | None = None
    outage_root: str | None = None
    history: collector.History | None = None
    register: str = "register"
    register_table: str | None = None
    spec: readings.FeedSpec = readings.FeedSpec()
    mapping: list = field(default_factory=list)
    tariff_list: list = field(default_factory=list)
    rules: pricing.Rules = pricing.Rules()
    stale_after: float = 15
    glitch: facts.Glitch | None = facts.Glitch()
    max_gap: float = 20
    box: checks.Box = checks.Box()
    days_root: str | None = None  # a shared folder for facts kept by day, which a run brings up to date by what its load touches

    def mapping_frame(self) -> DataFrame:
        return self.store.spark.createDataFrame(self.mapping, "facility string, register_id long, reserved_spaces int")

    @property
    def bronze(self) -> str:
        return self.feed_table or f"bronze_{self.feed}"

    @property
    def bronze_register(self) -> str:
        return self.register_table or f"bronze_{self.register}"


def setups(store: TableStore, raw_root: str, sources: list[Source], **own) -> list[Setup]:
    """A setup for each feed of a source file (those without a filter), with its intervals, glitch limits and paths; the
    source with a filter is the register."""
    register = next((s for s in sources if s.filter), None)
    out = []
    for s in sources:
        if s.filter:
            continue
        c = Setup(store, f"{raw_root}/{s.folder}", s.id, s.bronze_table, raw_root, **own)
        unavailable = f"{raw_root}/{s.folder}/unavailable"
        p = store.spark._jvm.org.apache.hadoop.fs.Path(unavailable)
        c.outage_root = unavailable if p.getFileSystem(store.spark._jsc.hadoopConfiguration()).exists(p) else None
        c.stale_after = s.freshness.get("stale_after_minutes", c.stale_after)
        c.glitch = facts.Glitch(**s.glitch) if s.glitch else None
        c.max_gap = s.polling.get("slow_interval_minutes", c.max_gap)
        if register:
            c.register, c.register_table, c.register_root = register.id, register.bronze_table, f"{raw_root}/{register.folder}"
        out.append(c)
    return out


REGISTER_FIELDS = ["id", register.VERSION, register.DEACTIVATED]
#: What names a row of bronze; raw files of two sources may have one path.
ROW = ["source_id", "raw_file", "record_index"]


def run_bronze(c: Setup) -> None:
    bronze.load(c.store, c.raw_root, c.feed, c.bronze, c.base)
    if c.register_root:
        bronze.load(c.store, c.register_root, c.register, c.bronze_register, c.base)
    if c.outage_root:
        found, _ = bronze.outages(bronze.text_files(c.store.spark, c.outage_root, c.base), c.feed)
        c.store.insert_if_new("bronze_source_outages", found, ["source_id", "raw_file"])
    if c.history:
        load_runs(c)


def load_runs(c: Setup, say: Callable[[str], None] = print) -> None:
    """The collector's failed runs. An error of the history's server keeps the table as it was and never ends the run."""
    st = c.store
    known = {(r["run_id"], r["run_attempt"]): r["failed_step"] for r in st.read_or_empty("bronze_collect_runs", s.RUNS).collect()}  # failed runs: a few a month
    try:
        rows = [(r["run_id"], r["run_attempt"], r["started_at"], r["failed_step"], r["url"]) for r in c.history.failed(known)]
    except Exception as e:  # whatever a transport raises
        say(f"run history not read: {e}")
        return
    df = st.spark.createDataFrame(rows, "run_id long, run_attempt int, started_at string, failed_step string, url string")
    st.overwrite("bronze_collect_runs", s.conform(df.withColumn("started_at", F.try_to_timestamp("started_at")), s.RUNS))


def run_silver(c: Setup, rebuild: bool = False) -> dict[str, int]:
    """Parses what is new: rows that are neither in fetches nor quarantined as no reading at all. The quarantine is written before
    fetches, so a crash between the two repeats and doesn't lose; a rebuild replaces what the feed has in both. The rest is derived from all fetches. What two results come from is written once. Readings and conflicts
    are derived when there are fetches that they weren't made from (a changed spec takes a rebuild, as it does for parsed rows). Conflicts and the register's quarantine are written under
    tags of their own, so that replacing them leaves all other rows of the quarantine where they are. Returns how much is new (rows,
    fetches, quarantined values, rows excluded) and how much there is now (readings, conflicts, stale snapshots and periods)."""
    st = c.store
    raw = bronze.widen(st.read(c.bronze), c.spec.fields)
    own = F.col("source_id") == c.feed
    if st.exists("silver_parking_fetch") and not rebuild:
        quarantined = st.read_or_empty("silver_quarantine", s.QUARANTINE).where(own & F.col("reading_excluded")).select(ROW)
        raw = bronze.unhandled(raw, st.read("silver_parking_fetch").where(own).select(ROW).union(quarantined), ROW)
    fetched, bad = readings.parse_readings(raw, c.spec, st.staged)
    n = readings.tallies(bad, []).select("quarantined", "excluded").first()  # each distinct count that isn't asked for would copy the rows once more
    counts = {"fetches": fetched.count(), "quarantined": n["quarantined"], "excluded": n["excluded"]}
    counts = {"new_rows": counts["fetches"] + counts["excluded"]} | counts
    if rebuild:
        st.replace_tagged("silver_quarantine", f"parsed {c.feed}", bad)
    else:
        st.insert_if_new("silver_quarantine", bad, [*ROW, "field", "reason"], f"parsed {c.feed}")
    if rebuild and st.exists("silver_parking_fetch"):
        st.replace_where("silver_parking_fetch", own, fetched)
    else:
        st.append("silver_parking_fetch", fetched)
    st.unstage()
    fetches = st.read("silver_parking_fetch")
    made_of = f"{st.manifest('silver_parking_fetch')['dirs']}"
    if rebuild or st.made_of("silver_parking_reading") != made_of:
        first, conflicts = readings.deduplicate(readings.by_entity(fetches), c.spec, st.staged)
        st.replace_tagged("silver_quarantine", CONFLICT, conflicts)
        st.overwrite("silver_parking_reading", first.drop("_part"), made_of)  # last, so that a run that died does both again
        st.unstage()
    counts["conflicts"] = st.read("silver_quarantine").where(F.col("reason") == CONFLICT).count()
    st.overwrite("silver_snapshot_freshness", readings.freshness(fetches, c.stale_after))
    st.overwrite("silver_stale_period", readings.stale_periods(st.read("silver_snapshot_freshness"), c.stale_after))
    if c.register_root:
        areas, bad = register.parse_areas(bronze.widen(st.read(c.bronze_register), REGISTER_FIELDS))
        st.overwrite("silver_parking_area", areas)
        st.replace_tagged("silver_quarantine", c.register, bad)
    counts["readings"] = st.read("silver_parking_reading").count()
    counts["stale_snapshots"] = st.read("silver_snapshot_freshness").where("is_stale").count()
    return counts | {"stale_periods": st.read("silver_stale_period").count()}


def fact(c: Setup, name: str) -> DataFrame:
    """The availability or the hourly fact, from where the run keeps it."""
    if not c.days_root:
        return c.store.read(f"fact_parking_{name}")
    return getattr(daily.Facts(c.store.spark, c.days_root), name)().drop("facility", "day")


def run_gold(c: Setup) -> None:
    st, spark = c.store, c.store.spark
    st.overwrite("dim_date", calendar.dim_date(spark))
    st.overwrite("dim_time", calendar.dim_time(spark))
    fetches, areas = st.read("silver_parking_fetch"), st.read_or_empty("silver_parking_area", s.AREA)
    attrs = facility.attributes(fetches, areas, c.mapping_frame())
    st.overwrite("dim_parking_facility", facility.dim_facility(attrs, st.read_or_empty("dim_parking_facility", s.FACILITY), st.staged))
    st.unstage()
    dim, periods = st.read("dim_parking_facility"), st.read("silver_stale_period")
    if c.days_root:
        own = daily.Facts(spark, c.days_root, c.glitch, c.stale_after, c.max_gap, c.spec.zone)
        own.update(bronze.unhandled(fetches, own.fetches(), ROW), dim)
    else:
        st.overwrite("fact_parking_availability", facts.availability(st.read("silver_parking_reading"), fetches, dim, periods, c.glitch))
    avail = fact(c, "availability")
    span = st.read("dim_date").agg(F.min("date_key").alias("a"), F.max("date_key").alias("b")).first()
    if not avail.where(~F.col("date_key").between(span["a"], span["b"])).isEmpty():
        raise ValueError("a reading lies outside the calendar")
    if not c.days_root:
        st.overwrite("fact_parking_hourly", facts.hourly(avail, periods, c.max_gap, c.spec.zone))
    if c.tariff_list:
        st.overwrite("fact_suggested_price", pricing.suggested_prices(fact(c, "hourly"), dim, pricing.tariffs(spark, c.tariff_list), c.rules, c.spec.zone))
    st.overwrite("fact_source_stale_period", facts.stale_fact(periods, c.spec.zone))


def run_quality(c: Setup, shared: bool = True) -> bool:
    """Stores the results of the feed's own rows, and with ``shared`` those of tables that all feeds share; then says whether a
    critical check failed."""
    st, own = c.store, F.col("source_id") == c.feed
    raw = st.read(c.bronze)
    names = [r[0] for r in raw.select(F.explode(F.map_keys("fields")).alias("k")).distinct().collect()]  # field names, not rows
    t = {
        "bronze": bronze.widen(raw, sorted(names)), "issues": st.read_or_empty(f"{c.bronze}_load_issues", s.LOAD_ISSUE), "fetches": st.read("silver_parking_fetch").where(own),
        "quarantine": st.read("silver_quarantine").where(own), "snapshots": st.read("silver_snapshot_freshness").where(own), "areas": st.read_or_empty("silver_parking_area", s.AREA), "mapping": c.mapping_frame(),
        "facilities": st.read("dim_parking_facility"), "availability": fact(c, "availability").where(own), "hourly": fact(c, "hourly"),
        "runs": st.read_or_empty("bronze_collect_runs", s.RUNS), "outages": st.read_or_empty("bronze_source_outages", s.OUTAGE).where(own),
    }
    st.append("quality_check_results", checks.run_checks(t, c.spec.fields, bronze.META, c.spec.count, c.box, shared))
    r = st.read("quality_check_results")
    last = r.agg(F.max("checked_at")).first()[0]
    return not r.where((F.col("checked_at") == last) & ~F.col("passed") & (F.col("severity") == checks.CRITICAL)).isEmpty()


def run(c: Setup | list[Setup], say: Callable[[str], None] = print) -> int:
    """All steps in order, bronze and silver for each feed, the rest once over all of them."""
    feeds = [*c] if isinstance(c, list) else [c]
    steps: list[tuple[str, Callable]] = [(f"{name} {f.feed}", lambda step=step, f=f: step(f)) for f in feeds for name, step in (("bronze", run_bronze), ("silver", run_silver))]
    for name, step in [*steps, ("gold", lambda: run_gold(feeds[0]))]:
        try:
            counts = step()
        except STEP_ERRORS as e:
            say(f"{name} failed: {e}")
            return 1
        if counts:
            say(f"{name}: " + ", ".join(f"{k} {v}" for k, v in counts.items()))
    try:
        return 3 if any([run_quality(f, f is feeds[0]) for f in feeds]) else 0
    except STEP_ERRORS as e:
        say(f"quality failed: {e}")
        return 1
