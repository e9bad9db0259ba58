"""A training corpus from raw documents, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it
kept; all but the last return the columns of ``docs``. ``run`` writes each stage's
result as Parquet to the shared folder and reads it back for the next one.

Null, empty and very long texts, repeated rows, empty tables and extra columns
are treated as the operators state; a stage passes extra columns on unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.llm import decontaminate, mixing, near_dedup, quality_rules, token_output
from tablevault.llm.common import written
from tablevault.llm.queries import tokenizer_file
from tablevault.sources.tables import table


def as_documents(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, whatever their names."""
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def rate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return as_documents(quality_rules.keep_good(docs), docs)


def dedupe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near duplicates."""
    return as_documents(near_dedup.one_of_each(docs), docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as its source's target asks."""
    return as_documents(mixing.mixed(docs), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix in training order, and per document what was read back
    from them: ``place`` is where it stands there, ``start`` where it would in id order."""
    return token_output.tokens_written_and_read(docs, tokenizer_file(), order=mixing.written_order(docs))


STAGES = [("quality_rules", rate), ("near_dedup", dedupe), ("decontaminate", clean), ("mixing", mix),
          ("token_output", tokens)]

# Robust estimates, sketches and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
