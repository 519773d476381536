"""One query per operator over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluicework.llm import (
    bpe_automaton,
    decontaminate,
    gated_lm,
    kneser_ney,
    line_quality,
    merkle_manifest,
    page_template,
    periodic_runs,
    ppm_language,
    run_length_index,
    secret_scan,
    shingle_join,
    sql,
    token_counts,
)
from sluicework.llm.arrow import read

Query = Callable[[SparkSession, str], DataFrame]
BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), RANK_FILE)


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kneser_ney.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "perplexity", "threshold", "kept")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(read(spark, sf_dir, "documents"))


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(read(spark, sf_dir, "documents"))


def op5_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.shingle_components(read(spark, sf_dir, "documents"))


def op6_page_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_template.main_text(read(spark, sf_dir, "pages"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


def op8_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.round_trip(read(spark, sf_dir, "documents"), BPE_FILE)


def op9_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = run_length_index.remove_repeats(read(spark, sf_dir, "documents"))
    return run_length_index.digest(removed)


def op10_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_language.identify(read(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.verified_manifest(read(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.planted(read(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.periodic_runs(docs))


def op13_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated_lm.score(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = (
        op1_token_counts,
        op2_kneser_ney,
        op3_secret_scan,
        op4_line_quality,
        op5_shingle_join,
        op6_page_template,
        op7_decontaminate,
        op8_bpe_automaton,
        op9_run_length_index,
        op10_ppm_language,
        op11_merkle_manifest,
        op12_periodic_runs,
        op13_gated_lm,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_secret_scan": sql.SECRET_SCAN,
        "op4_line_quality": sql.LINE_QUALITY,
        "op7_decontaminate": sql.DECONTAMINATE,
        "op11_merkle_manifest": sql.MERKLE_MANIFEST,
    }
