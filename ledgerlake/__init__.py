"""Monthly retail lake and customer feature book as Spark DataFrame operators."""

from ledgerlake.operators.audit import load_audit, write_audit
from ledgerlake.operators.book import (
    BOOK,
    BookSpec,
    feature_book,
    feature_coverage,
    feature_dictionary,
)
from ledgerlake.operators.dedup import exact_rows, latest_load, restamp
from ledgerlake.operators.ingest import ingest_subject, stamp_load
from ledgerlake.operators.stage import book_lines, stage_features
from ledgerlake.operators.standardise import standardise
from ledgerlake.operators.windows import recency_windows
from ledgerlake.plans.monthly_run import run_month
from ledgerlake.sources.layers import LakePaths
from ledgerlake.sources.subjects import SUBJECTS, SubjectSpec

__all__ = [
    "BOOK",
    "BookSpec",
    "LakePaths",
    "SUBJECTS",
    "SubjectSpec",
    "book_lines",
    "exact_rows",
    "feature_book",
    "feature_coverage",
    "feature_dictionary",
    "ingest_subject",
    "latest_load",
    "load_audit",
    "recency_windows",
    "restamp",
    "run_month",
    "stage_features",
    "stamp_load",
    "standardise",
    "write_audit",
]
