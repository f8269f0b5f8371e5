"""Command line: ``python -m tierflow <step> --store DIR [...]``; see ``--help`` for the steps."""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from .plans import landing, onboard, run
from .session import tune
from .sources import csv_files
from .sources.tables import LayerStore

STEPS = ["load", "land", "conform", "enrich", "report", "live-sessions", "memberships", "onboard", "remove-students"]


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """All CSV files of a folder as one table with ``_seq``; columns that a file lacks are NULL."""
    found = csv_files.list_csv_files(spark, folder)
    if not found:
        raise SystemExit(f"no CSV file in {folder}")
    parts = [csv_files.read_csv(spark, f.path, f.separator, multi_line=csv_files.way([f])) for f in found]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tierflow")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--store", required=True, help="root folder of the layers")
    parser.add_argument("--folder", help="CSV folder of every step that takes in files")
    parser.add_argument("--filter", default="", help="only files whose name contains this text")
    parser.add_argument("--cohort", action="append", help="cohort code for attendance; repeatable, default all")
    parser.add_argument("--rebuild", action="store_true", help="make tables anew instead of merging")
    parser.add_argument("--single-line", action="store_true", help="no cell holds a line break, so large files can be split")
    parser.add_argument("--domain", default="example.org", help="domain of addresses made for onboarded students")
    parser.add_argument("--run-id", help="name of the run; a broken run goes on if it is repeated with its name")
    parser.add_argument("--dry-run", action="store_true", help="only count what remove-students would remove")
    args = parser.parse_args(argv)
    if args.step not in ("conform", "enrich", "report") and not args.folder:
        parser.error("--folder is needed")

    spark = tune(SparkSession.builder.appName("tierflow").getOrCreate())
    store, run_id = LayerStore(spark, args.store), args.run_id or dt.datetime.now().strftime("%Y%m%d_%H%M%S")
    if args.step == "load":
        outcomes = [run.Outcome(n, p) for n, p in landing.load_folder(spark, args.folder, store).items()]
    elif args.step == "land":
        done = landing.run_landing(spark, args.folder, store, args.filter, multi_line=not args.single_line)
        outcomes = [run.Outcome(n, p) for n, p in done.published.items()]
        outcomes += [run.Outcome(path, error="skipped: unknown or incomplete header") for path in done.skipped]
    elif args.step == "conform":
        outcomes = run.run_conform(store, run_id)
    elif args.step == "enrich":
        outcomes = run.run_enrich(store, run_id, args.cohort, args.rebuild)
    elif args.step == "report":
        outcomes = run.run_report(store, args.rebuild)
    elif args.step == "live-sessions":
        outcomes = [run.Outcome("live_session", run.run_live_sessions(store, _files(spark, args.folder), run_id))]
    elif args.step == "memberships":
        outcomes = [run.Outcome("student_cohort", run.run_memberships(store, _files(spark, args.folder).drop(csv_files.SEQ), run_id))]
    else:
        if args.step == "onboard":
            counts = onboard.run_onboarding(store, _files(spark, args.folder).drop(csv_files.SEQ), run_id, args.domain)
        else:  # the first column of the files lists the ids
            counts = run.run_removal(store, _files(spark, args.folder), run_id, args.dry_run)
        for table, rows in counts.items():
            print(f"{table}: {rows} rows")
        return 0
    for o in outcomes:
        print(f"{o.table}: {f'version {o.published.version}, {o.published.rows} rows' if o.published else o.error}")
    return 1 if any(o.published is None for o in outcomes) else 0


if __name__ == "__main__":
    sys.exit(main())
