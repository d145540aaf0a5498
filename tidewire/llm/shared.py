"""What the corpus operators share: table access, bounded labelled samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: int | str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``most`` bytes of a text column, or of one row: so many texts are Python strings at once."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        upto, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < len(sizes):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, end - at)
            at = end


def fold(doc_id: Column) -> Column:
    """Held-out fold of a document: crc32 of the id's decimal text, modulo 5. A null id is in fold -1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(-1).cast("bigint"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, y) of at most ``rows`` labelled training documents, picked by the hash of the id.

    ``rows`` is the documented bound: the ids are at most that many, so they may be broadcast and the texts need no
    shuffle but that of the sample: of rows that repeat an id the least text counts. Rows of fold 0, null labels and
    null ids take no part; of several labels of a document the largest counts.
    """
    ids = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("_id").isNotNull() & F.col("y").isin(0, 1) & (fold(F.col("_id")) != 0))
        .groupBy("_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "_id").groupBy("_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
