"""Registered queries of the subpackage: ``opN_<name>`` over whole tables, and their DuckDB SQL."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, hard_negatives, jaccard_join, katz_lm, license_scan, line_dedup, phrase_mining, quality_rules, secret_scan, source_mix, substring_dedup, url_filter, warc
from ._tables import table
from .oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def importable(spark: SparkSession) -> None:
    """Let local Python workers import this package when the entry module was loaded by its path; on a cluster
    it is installed or shipped with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"), runs=True)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.line_report(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op5_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_lm.score_documents(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_copies(table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_plan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.ranked_phrases(table(spark, sf_dir, "documents"))


def _query(f: Query) -> Query:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return f(spark, sf_dir)
    return run


QUERIES: dict[str, Query] = {f.__name__: _query(f) for f in (
    op1_line_dedup, op2_quality_rules, op3_secret_scan, op4_ngram_jaccard_join, op5_katz_lm, op6_url_filter, op7_substring_dedup,
    op8_source_mix, op9_warc, op10_benchmark_decontamination, op11_license_scan, op12_hard_negatives, op13_phrase_mining)}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
