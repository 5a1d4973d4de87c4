"""``python -m hindcast.cli``: run, coverage and demo."""

from __future__ import annotations

import argparse
import sys
import tempfile
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession

from hindcast.operators.gates import PASS
from hindcast.plans import coverage as cov
from hindcast.plans import run as runs
from hindcast.schemas import REPORTS
from hindcast.sources import files, synthetic


def session() -> SparkSession:
    return SparkSession.builder.appName("hindcast").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _run(a: argparse.Namespace) -> int:
    options = {"cutoff_lag_hours": a.cutoff_lag_hours, "seasonal_lag_days": a.seasonal_lag_days, "window_days": a.window_days, "window_start": a.window_start, "window_end": a.window_end}
    try:
        code, results = runs.run(session(), a.raw, a.warehouse, a.processing_date, a.reports, **options)
    except ValueError as e:
        print(e, file=sys.stderr)
        return runs.NOT_READY
    if not results:
        print(f"no files were published before the end of {a.processing_date}", file=sys.stderr)
    for r in results:
        print(f"{r.gate}: {r.status}")
        for reason in r.reasons:
            print(f"  {reason.code} {reason.count}: {reason.detail}")
    return code


def _coverage(a: argparse.Namespace) -> int:
    spark, complete = session(), True
    if a.out:
        names = files.scan_all(spark, a.raw, digest=False)
        Path(a.out).write_text(cov.statement(spark, names, {r: (a.start, a.end) for r in REPORTS.values()}))
    for report in REPORTS.values():
        found = cov.coverage(spark, files.scan(spark, a.raw, report.key, digest=False), report, a.start, a.end)
        print(found.summary())
        complete &= not found.missing
    return 0 if complete else 1


def _demo(a: argparse.Namespace) -> int:
    spark, ok = session(), True
    for scenario in synthetic.SCENARIOS:
        with tempfile.TemporaryDirectory() as folder:
            day = synthetic.build(spark, scenario, Path(folder, "raw"))
            code, results = runs.run(spark, f"{folder}/raw", f"{folder}/warehouse", day, window_days=1)
            print(f"{scenario}: exit {code}; {', '.join(f'{r.gate} {r.status}' for r in results)}; {', '.join(x.code for r in results for x in r.reasons) or 'no reasons'}")
            ok &= (results[0].status == PASS) == (scenario in ("pass", "dst_spring_forward"))
    return 0 if ok else 1


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="hindcast")
    commands = parser.add_subparsers(required=True)
    day = date.fromisoformat

    def command(name, f, *options):
        p = commands.add_parser(name)
        p.set_defaults(call=f)
        for flag, settings in options:
            p.add_argument(flag, **settings)

    raw = ("--raw", {"default": "raw"})
    span = (("--start", {"type": day, "required": True}), ("--end", {"type": day, "required": True}))
    command("run", _run, raw, ("--warehouse", {"default": "warehouse"}), ("--reports", {"default": "reports"}), ("--processing-date", {"type": day, "required": True}), ("--window-start", {"type": day}), ("--window-end", {"type": day}), ("--window-days", {"type": int, "default": 30}), ("--cutoff-lag-hours", {"type": int, "default": 24}), ("--seasonal-lag-days", {"type": int, "default": 7}))
    command("coverage", _coverage, raw, *span, ("--out", {"help": "write a statement of what is held and missing"}))
    command("demo", _demo)
    args = parser.parse_args(argv)
    return args.call(args)


if __name__ == "__main__":
    sys.exit(main())
