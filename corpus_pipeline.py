"""Corpus pipeline: quality, line dedup, near-dedup, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; its result is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import line_dedup, mixing, packing, quality_knn, simhash
from threadloom.llm.common import documents, stage, workers_can_import
from threadloom.llm.queries import vocabulary
from threadloom.sources.tables import read_table


def _with_text(docs: DataFrame, text) -> DataFrame:
    """``docs`` with a new text and its length."""
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return docs.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour vote accepts; the labelled sample comes from ``labels``."""
    model = quality_knn.fit(docs, read_table(spark, sf_dir, "labels"))
    kept = quality_knn.quality_scores(docs, model).where("predicted = 1")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents or more share; untouched texts stay as they are."""
    out = line_dedup.line_dedup(docs)
    text = F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(F.col("kept_text"))
    return _with_text(out, text).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.simhash_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources, a row per document and epoch."""
    return _with_text(mixing.mixed_documents(docs), F.col("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [("quality classifier", quality), ("line dedup", dedup_lines), ("simhash near-dedup", near_dedup),
          ("mixing", mix), ("packing", pack)]

#: The vote, the fingerprints, the draws and the tokens have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers_can_import(spark)
    docs = documents(spark, sf_dir)
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
