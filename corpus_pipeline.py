"""The corpus pipeline: each stage works on all documents that the one before it kept.

Every stage but the last returns the columns of ``documents``; a stage over an empty table returns an empty one, and
null ids, null texts and repeated rows are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import mixing, near_dup, pieces, quality, secrets
from tidewire.llm.shared import table
from tidewire.sources.shared_folder import discard, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it is fitted on labelled ones of the training folds."""
    return quality.keep(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, stays of each group of near duplicates."""
    return near_dup.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret, encoded ones included, is replaced; n_chars counts the new text."""
    return secrets.redact(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixing.mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_ids, ids, restored) of each document of the mix."""
    return pieces.encode(docs, pieces.Pieces.load())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("pieces", encode),
]

#: The classifier, the decoding of secrets and the encoding are not expressible in SQL; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over ``documents``; each result is written to the shared folder and read again.

    A stage's table is deleted when the next one is written; that of the last but one stays, as the result reads it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
            if before is not None:
                discard(before)
            before = docs
    return docs
