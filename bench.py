"""Headline queries on one machine; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the threads. Every query is built and
run to the end (all rows and columns, no output files) three times; the fastest
run counts, so that starting up the JVM does not. With BENCH_COMPARE=1 the other forms of
book and latest load are timed as well, once each and outside the total.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalogue.queries import QUERIES, transactions  # noqa: E402
from catalogue.retail import AS_OF, DT_PROC, shipped_lines  # noqa: E402
from ledgerlake.operators.book import feature_book  # noqa: E402
from ledgerlake.operators.dedup import latest_load  # noqa: E402
from ledgerlake.operators.stage import book_lines  # noqa: E402
from ledgerlake.operators.windows import recency_windows  # noqa: E402

HEADLINES = (
    "trusted_transactions",
    "dedup_latest_transactions",
    "stage_features",
    "recency_windows",
    "book_amount_day",
    "book_counts_day",
    "book_full",
    "book_full_from_stage",
    "book_dictionary",
)
COMPARED = {
    "book_full_wide": lambda spark, sf_dir: feature_book(
        recency_windows(book_lines(transactions(spark, sf_dir), DT_PROC, AS_OF), AS_OF), form="wide"
    ),
    "dedup_latest_transactions_rank": lambda spark, sf_dir: latest_load(
        shipped_lines(spark, sf_dir), "invoice_id", strategy="rank"
    ),
}
RUNS = 3


def timed(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in names:
        seconds[name] = round(min(timed(QUERIES[name], spark, sf_dir) for _ in range(RUNS)), 3)
    compared = {}
    if os.environ.get("BENCH_COMPARE") == "1":
        compared = {name: round(timed(query, spark, sf_dir), 3) for name, query in COMPARED.items()}
    spark.stop()

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                **({"compared": compared} if compared else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
