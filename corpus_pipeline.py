"""Documents through five stages: toxic ones out, repeated lines out, one of each group of near
copies, benchmark passages out, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet in
the shared folder and the next stage reads that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import bpe_round_trip
from ledgerlake.llm.decontamination import without_leaks
from ledgerlake.llm.jaccard_join import one_of_each_component
from ledgerlake.llm.lines import line_dedup
from ledgerlake.llm.queries import table, vocabulary_path
from ledgerlake.llm.tables import written
from ledgerlake.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold stay."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go; every document stays, n_chars follows its text."""
    shorter = line_dedup(docs).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return shorter
    return shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays; five-word shingles, similarity of 0.8."""
    return one_of_each_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item stay."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and decoded text."""
    return bpe_round_trip(docs, vocabulary_path())


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", token_ids),
]

# Toxicity and the shingle hashes have no counterpart in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
