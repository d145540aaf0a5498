"""Streaming forms of the incremental operators: new or changed articles by key, with late data bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.sources.shared_folder import shared_folder


def first_seen(stream: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """The row of each key that arrives first within the watermark; state older than ``late`` is dropped."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def counts_by_window(stream: DataFrame, ts: str, late: str, window: str, *keys: str) -> DataFrame:
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, window), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *keys, "n")


def run_complete(counts: DataFrame, name: str) -> DataFrame:
    """Run a stream of aggregates over what is there; the last batch's whole result, a table of the shared folder."""
    import uuid

    spark = counts.sparkSession
    base = f"{shared_folder(spark)}/tidewire/{name}-{uuid.uuid4().hex}"
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{base}/rows")
    counts.writeStream.outputMode("complete").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{base}/rows")


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there, into a table of the shared folder, and read that; exactly once by its checkpoint."""
    import uuid

    spark = stream.sparkSession
    base = f"{shared_folder(spark)}/tidewire/{name}-{uuid.uuid4().hex}"
    stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/rows").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")
