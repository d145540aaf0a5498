"""Registered queries of the corpus operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import clusters, conversations, extraction, fingerprints, licenses, mixing, near_dup, neighbours, pieces, quality, secrets, substrings, toxicity
from tidewire.llm.shared import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.passages(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbours(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), pieces.Pieces.load())


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.report(*clusters.cluster(table(spark, sf_dir, "embeddings")))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_after_damage(table(spark, sf_dir, "conversations"))


def queries() -> dict:
    made = (
        op1_fingerprints, op2_secrets, op3_substrings, op4_mixing, op5_neighbours, op6_toxicity, op7_quality, op8_pieces, op9_near_dup, op10_licenses, op11_extraction, op12_clusters,
        op13_conversations,
    )
    return {f.__name__: f for f in made}


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": mixing.SQL, "op9_near_dup": near_dup.SQL, "op12_clusters": clusters.SQL, "op13_conversations": conversations.SQL}
