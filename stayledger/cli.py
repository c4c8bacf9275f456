"""Command line: ``python -m stayledger.cli -t <task> --root <landing folder>``."""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.dimensions import SITES, site_registry
from stayledger.plans import ledger as marts
from stayledger.plans import staging
from stayledger.plans.audit import store_audit
from stayledger.plans.rates import LAK_PAIRS, USD_PAIRS, lak_rates, refresh_rates, usd_rates
from stayledger.session import build_session
from stayledger.sinks.archive import archive_taken
from stayledger.sinks.tables import Ledger
from stayledger.sinks.versions import reconcile
from stayledger.sources.files import list_snapshots
from stayledger.streaming.ingest import refresh_stream

TASKS = (
    "init",
    "fload",
    "iload",
    "fload_history",
    "iload_history",
    "fload_property",
    "iload_property",
    "fload_property_history",
    "iload_property_history",
    "fload_detail",
    "iload_detail",
    "fload_report",
    "iload_report",
    "restore_history",
    "get_exchange_rate",
    "sample",
    "stream",
    "audit",
    "reconcile",
)
# Tasks that take files in.
LOADING = ("fload", "iload", "fload_property", "iload_property", "fload_history", "iload_history", "stream")
LOADING += ("fload_property_history", "iload_property_history")
CURRENCIES = {"USD": (usd_rates, USD_PAIRS), "LAK": (lak_rates, LAK_PAIRS)}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stayledger")
    p.add_argument("--task", "-t", choices=TASKS, required=True)
    p.add_argument("--property", "-p", help="code of one property; all when left out")
    p.add_argument("--database", default="default")
    p.add_argument("--location", help="folder for newly created tables")
    p.add_argument("--root", help="landing folder, or file of the sample workbook or of the rate payloads")
    p.add_argument("--as-of", type=date.fromisoformat, default=None, help="the run's today (yyyy-mm-dd)")
    p.add_argument("--history_date", type=date.fromisoformat, help="history cutoff (yyyy-mm-dd)")
    p.add_argument("--start_date", type=date.fromisoformat)
    p.add_argument("--end_date", type=date.fromisoformat)
    p.add_argument("--day", "-d", type=lambda text: datetime.strptime(text, "%d%m%Y").date(), help="rate day (ddmmyyyy)")
    p.add_argument("--currency", choices=(*CURRENCIES, "BOTH"), default="USD", help="BOTH: payloads of one name each below the root")
    p.add_argument("--archive", help="folder that files are moved to once they are taken in")
    p.add_argument("--checkpoint", help="checkpoint folder of the stream")
    return p


def landed_payload(spark: SparkSession, path: str, day: date, currency: str) -> DataFrame:
    """One day's landed payload file."""
    column = "PAYLOAD" if currency == "USD" else "HTML"
    now = F.current_timestamp().cast("timestamp_ntz")
    return spark.read.text(path, wholetext=True).select(
        F.lit(day).alias("REPORT_DATE"),
        F.col("value").alias(column),
        now.alias("CREATED_AT"),
        now.alias("MODIFIED_AT"),
    )


def _need(args: argparse.Namespace, *names: str) -> None:
    missing = [n for n in names if getattr(args, n) is None]
    if missing:
        raise SystemExit(f"{args.task} needs --{' --'.join(missing)}")


def run(args: argparse.Namespace, spark: SparkSession | None = None) -> None:
    spark = spark or build_session()
    ledger = Ledger(spark, args.database)
    as_of = args.as_of or date.today()
    task, prop = args.task, args.property

    if task == "init":
        ledger.create(args.location)
    elif task in ("fload", "fload_property"):
        _need(args, "root")
        staging.stage_full(ledger, args.root, SITES, prop)
        if task == "fload":
            marts.run_full(ledger, as_of)
    elif task in ("iload", "iload_property"):
        _need(args, "root")
        if task == "iload":
            staging.history_incremental(ledger, args.root, SITES, prop)
        staging.stage_incremental(ledger, args.root, SITES, prop)
        if task == "iload":
            marts.run_incremental(ledger, as_of)
    elif task in ("fload_history", "fload_property_history"):
        _need(args, "root", "history_date")
        staging.history_full(ledger, args.root, args.history_date, SITES, prop)
    elif task in ("iload_history", "iload_property_history"):
        _need(args, "root")
        staging.history_incremental(ledger, args.root, SITES, prop)
    elif task == "fload_detail":
        marts.refresh_detail_full(ledger, as_of)
    elif task == "iload_detail":
        marts.refresh_detail_incremental(ledger, as_of)
    elif task == "fload_report":
        marts.refresh_report_full(ledger)
    elif task == "iload_report":
        marts.refresh_report_incremental(ledger, as_of)
    elif task == "restore_history":
        _need(args, "start_date", "end_date")
        marts.restore(ledger, args.start_date, args.end_date)
    elif task == "get_exchange_rate":
        _need(args, "root")
        both = args.currency == "BOTH"
        for currency in CURRENCIES if both else (args.currency,):
            path = f"{args.root}/{currency}" if both else args.root
            landed = landed_payload(spark, path, args.day or as_of, currency)
            rates, pairs = CURRENCIES[currency]
            refresh_rates(ledger, rates(landed), landed, pairs)
    elif task == "sample":
        _need(args, "root")
        staging.load_sample(ledger, args.root)
    elif task == "stream":
        _need(args, "root", "checkpoint")
        refresh_stream(ledger, args.root, args.checkpoint, as_of).awaitTermination()
        ledger.refresh()
    elif task == "audit":
        print(f"{store_audit(ledger, as_of)} lines in {ledger.name('audit')}, AUDIT_DATE {as_of}")
    elif task == "reconcile":
        print(f"{reconcile(ledger).count()} entries of day_versions were not borne out by the rows")
    if args.archive is not None and args.root is not None and task in LOADING:
        files = list_snapshots(spark, args.root, site_registry(spark, SITES, *staging.DAILY_LAYOUTS))
        moved, kept = archive_taken(ledger, files, args.root, args.archive)
        print(f"{moved} files moved to {args.archive}, {kept} could not be")


if __name__ == "__main__":
    run(parser().parse_args())
