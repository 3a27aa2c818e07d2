"""The command line: collect, run, maintenance, publish.

    python -m tidegrain.cli collect --config sources.json --storage RAW [--source ID] [--mapping FILE] [--run-id ID]
    python -m tidegrain.cli gaps --config sources.json --storage RAW [--tolerance-minutes 10]
    python -m tidegrain.cli run --config sources.json --raw-root RAW --tables-root TABLES [--mapping F] [--tariffs F] [--rules F] [--collector F]
    python -m tidegrain.cli bronze|silver|gold|check ...   one step of the run; silver --rebuild parses all of bronze anew
    python -m tidegrain.cli maintain --tables-root TABLES [--retention-days 7] [--dry-run] [--force]
    python -m tidegrain.cli publish --tables-root TABLES --catalog C --schema S

Exit codes: 0 fine, 1 a step failed, 2 wrong arguments or files, 3 a critical check failed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from pathlib import Path

from tidegrain import config

#: The tables that reports read.
PUBLISHED = ["dim_date", "dim_time", "dim_parking_facility", "fact_parking_availability", "fact_parking_hourly", "fact_suggested_price", "fact_source_stale_period", "quality_check_results"]
STEPS = ("run", "bronze", "silver", "gold", "check")


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidegrain")
    commands = p.add_subparsers(dest="command", required=True)
    for name in STEPS:
        c = commands.add_parser(name)
        c.add_argument("--config", required=True)
        c.add_argument("--raw-root", required=name in ("run", "bronze"), default="")
        c.add_argument("--tables-root", required=True)
        for file in ("mapping", "tariffs", "rules", "collector"):
            c.add_argument(f"--{file}")
        c.add_argument("--rebuild", action="store_true")
    c = commands.add_parser("collect")
    c.add_argument("--config", required=True)
    c.add_argument("--storage", type=Path, required=True)
    c.add_argument("--source")
    c.add_argument("--mapping")
    c.add_argument("--run-id", default="")
    c = commands.add_parser("gaps")
    c.add_argument("--config", required=True)
    c.add_argument("--storage", required=True)
    c.add_argument("--tolerance-minutes", type=float, default=10)
    c = commands.add_parser("maintain")
    c.add_argument("--tables-root", required=True)
    c.add_argument("--retention-days", type=float, default=7)
    c.add_argument("--dry-run", action="store_true")
    c.add_argument("--force", action="store_true")
    c = commands.add_parser("publish")
    c.add_argument("--tables-root", required=True)
    c.add_argument("--catalog", default="")
    c.add_argument("--schema", default="")
    return p


def collect(a, net=None, now: dt.datetime | None = None, say=print) -> int:
    """Polls every source that is due; one that fails doesn't keep the others from being polled."""
    from tidegrain.sources.collector import CollectError, Https, Poll

    sources, mapping = config.load_sources(a.config), config.load_mapping(a.mapping) if a.mapping else []
    values = {"facility": {m[0] for m in mapping}, "register_id": {str(m[1]) for m in mapping if m[1] is not None}}
    failed = 0
    for s in sources:
        if a.source not in (None, s.id) or not (s.polling or a.source):
            continue
        try:
            wanted = values.get(s.filter["mapping_field"]) if s.filter and mapping else None
            say(f"{s.id}: {Poll(a.storage, s, net or Https(), now or dt.datetime.now(dt.UTC), a.run_id, wanted).run()}")
        except (CollectError, OSError, ValueError) as e:
            failed = 1
            say(f"{s.id} failed: {e}")
    return failed


def gaps(a, spark, say=print) -> int:
    """Lists the times in which a source's next snapshot was late."""
    from pyspark.sql import functions as F

    from tidegrain.operators import polling
    from tidegrain.sources import bronze

    for s in config.load_sources(a.config):
        side = bronze.text_files(spark, f"{a.storage}/{s.folder}", a.storage).where("endswith(path, '.meta.json')")
        of = lambda n: F.try_to_timestamp(F.get_json_object("value", f"$.{n}")).alias(n)
        rows = side.select(F.lit(s.id).alias("source_id"), F.col("path").alias("raw_file"), of("ingested_at"), of("next_due")).where("ingested_at is not null")
        for g in polling.gaps(rows, a.tolerance_minutes, dt.datetime.now(dt.UTC).replace(tzinfo=None)).orderBy("gap_from").toLocalIterator():
            say(f"{s.id}: due {g['gap_from']}, " + (f"next {g['gap_to']}" if g["gap_to"] else "none since"))
    return 0


def pipeline(a, spark, say=print) -> int:
    from tidegrain.plans import run
    from tidegrain.sources.collector import History, github
    from tidegrain.sources.store import TableStore

    own = {"mapping": config.load_mapping(a.mapping) if a.mapping else [], "tariff_list": config.load_tariffs(a.tariffs) if a.tariffs else []}
    if a.rules:
        own["rules"] = config.load_rules(a.rules)
    if a.collector:
        own["history"] = History(github(), config.load_collector(a.collector))
    feeds = run.setups(TableStore(spark, a.tables_root), a.raw_root, config.load_sources(a.config), **own)
    if a.command == "run" and not a.rebuild:
        return run.run(feeds, say)
    try:
        for f in feeds:
            if a.command in ("run", "bronze"):
                run.run_bronze(f)
            if a.command in ("run", "silver"):
                run.run_silver(f, a.rebuild)
        if a.command in ("run", "gold"):
            run.run_gold(feeds[0])
        return 3 if a.command in ("run", "check") and any([run.run_quality(f, f is feeds[0]) for f in feeds]) else 0
    except run.STEP_ERRORS as e:
        say(f"{a.command} failed: {e}")
        return 1


def maintain(a, spark, say=print) -> int:
    from tidegrain.sources.store import TableStore

    st = TableStore(spark, a.tables_root)
    for t in st.tables():
        if not a.dry_run:
            st.compact(t)
        gone = st.vacuum(t, a.retention_days * 24, a.force, a.dry_run)
        say(f"{t}: {len(gone)} folders {'would go' if a.dry_run else 'gone'}")
    return 0


def publish(a, spark, say=print) -> int:
    from tidegrain.sources.store import TableStore

    say("published " + ", ".join(TableStore(spark, a.tables_root).publish(PUBLISHED, ".".join(x for x in (a.catalog, a.schema) if x))))
    return 0


def main(argv: list[str] | None = None, spark=None, say=print) -> int:
    a = arguments().parse_args(argv)
    try:
        if a.command == "collect":
            return collect(a, say=say)
        if spark is None:
            from tidegrain.session import session

            spark = session()
        return {"gaps": gaps, "maintain": maintain, "publish": publish}.get(a.command, pipeline)(a, spark, say)
    except config.ConfigError as e:
        say(str(e))
        return 2
    except ValueError as e:
        say(str(e))
        return 1


if __name__ == "__main__":
    sys.exit(main())
