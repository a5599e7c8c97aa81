"""Corpus pipeline: documents -> quality rules -> line dedup -> near-duplicate documents -> benchmark
decontamination -> mixing plan.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that its predecessor kept; all but the
last return the columns of ``documents``. Stages take null ids, sources and texts, empty texts, repeated rows,
empty tables and extra columns as their operators define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airmart.llm import decontaminate, jaccard_join, line_dedup, quality_rules, source_mix
from airmart.llm._tables import materialize, table
from airmart.llm.registry import importable

NEAR_WORDS, NEAR_PERCENT = 5, 80
NEAR_ROUNDS = 2  # at this similarity signatures take three times the disk of the documents, if shuffled at once


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the rules reject."""
    importable(spark)
    return quality_rules.clean_documents(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line chunks that occurred before go, and documents of which nothing is left."""
    importable(spark)
    return line_dedup.clean_documents(docs)


def _unused(docs: DataFrame, name: str) -> str:
    """The name, made longer until no column of the input has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicate texts the row with the smallest id stays. A row is judged by its own text,
    whatever else shares its id; rows equal in id and text are one, of which one stays. Texts without words are
    linked with nothing and stay, each row of them that has no id too."""
    importable(spark)
    nodes = jaccard_join.jaccard_nodes(docs, n_words=NEAR_WORDS, percent=NEAR_PERCENT, rounds=NEAR_ROUNDS)
    node, bare, alone = (_unused(docs, c) for c in ("node", "bare", "alone"))
    first = nodes.where("id = first.id").select(F.col("id").alias(node), (F.col("n") == 0).alias(bare)).distinct()
    kept = docs.withColumn(node, jaccard_join.node("doc_id", "text")).join(first, node)
    single = F.when(F.col("doc_id").isNull() & F.col(bare), F.monotonically_increasing_id())
    return kept.withColumn(alone, single).dropDuplicates([node, alone]).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    importable(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixing plan: how many words the mix takes from each document."""
    return source_mix.mix_plan(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_group),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mix", mix),
]

# SQL cannot express the content-defined chunks and edit windows; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is a written table that the next stage reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
