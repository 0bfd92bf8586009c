"""The operators of this subpackage applied to whole test tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import bpe_digests
from ledgerlake.llm.decontamination import benchmark_leaks
from ledgerlake.llm.jaccard_join import jaccard_components
from ledgerlake.llm.kneser_ney import lm_scores
from ledgerlake.llm.licenses import license_scan
from ledgerlake.llm.lines import line_dedup
from ledgerlake.llm.neighbours import nearest_neighbours
from ledgerlake.llm.periodic_runs import periodic_runs, planted_periods, run_lines
from ledgerlake.llm.substrings import substring_dedup
from ledgerlake.llm.suffixes import suffix_dedup
from ledgerlake.llm.token_counts import token_counts
from ledgerlake.llm.toxicity import toxicity
from ledgerlake.llm.whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), shingle=3, tenths=9)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), digest=True)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), digest=True)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_path())


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted_periods)
    return runs.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(run_lines(), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_toxicity": op2_toxicity,
    "op3_line_dedup": op3_line_dedup,
    "op4_neighbours": op4_neighbours,
    "op5_benchmark_leaks": op5_benchmark_leaks,
    "op6_bpe": op6_bpe,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_licenses": op9_licenses,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_whitening": op12_whitening,
    "op13_lm_scores": op13_lm_scores,
}
