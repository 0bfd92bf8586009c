"""Command line for spark-submit: `ledgerlake --root s3a://bucket/lake`.

The only place that looks at the clock, and only where no date is given.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import SparkSession

from ledgerlake.plans.monthly_run import STEPS, RunReport, run_month
from ledgerlake.sources.layers import LakePaths
from ledgerlake.sources.subjects import SUBJECTS


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> RunReport:
    now = datetime.now()
    parser = argparse.ArgumentParser(prog="ledgerlake")
    parser.add_argument("--root", required=True)
    parser.add_argument("--dt-proc", default=f"{now:%Y%m%d%H%M%S}")
    parser.add_argument("--as-of", type=date.fromisoformat, default=now.date())
    parser.add_argument("--steps", nargs="+", choices=STEPS, default=STEPS)
    parser.add_argument("--subjects", nargs="+", choices=list(SUBJECTS), default=list(SUBJECTS))
    parser.add_argument("--landing", choices=("batch", "stream"), default="batch")
    parser.add_argument("--clean", choices=("off", "archive", "delete"), default="off")
    parser.add_argument(
        "--on-bad-row", choices=("FAILFAST", "PERMISSIVE", "DROPMALFORMED", "reject"),
        default="FAILFAST",
    )
    parser.add_argument("--dedup", choices=("business", "with_load"), default="business")
    parser.add_argument("--loads", choices=("new", "own", "all"), default="new")
    parser.add_argument("--resume", action="store_true")
    parser.add_argument("--replaced", choices=("remove", "keep"), default="remove")
    parser.add_argument("--book-from", choices=("stage", "states"), default="stage")
    parser.add_argument("--snapshots", choices=("run", "newest", "all"))
    chosen = parser.parse_args(arguments)

    return run_month(
        spark or SparkSession.builder.appName("ledgerlake").getOrCreate(),
        LakePaths(chosen.root.rstrip("/")),
        chosen.dt_proc,
        chosen.as_of,
        steps=chosen.steps,
        landing=chosen.landing,
        clean=chosen.clean,
        on_bad_row=chosen.on_bad_row,
        dedup=chosen.dedup,
        loads=chosen.loads,
        book_from=chosen.book_from,
        resume=chosen.resume,
        replaced=chosen.replaced,
        snapshots=chosen.snapshots or ("run" if "refined" in chosen.steps else "newest"),
        subjects=tuple(SUBJECTS[name] for name in chosen.subjects),
    )


if __name__ == "__main__":
    main()
