"""Keyed state with timers: what each article's processing is worth as its versions stream by."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_DAY = 86_400_000_000
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Rechecks(StatefulProcessor):
    """State of a key: (hash, checked, due): the last known content, when it was last seen, whether a recheck was called since.

    All times are microseconds. A timer stands at every last sight plus the interval; rows and timers give the same calls
    however the stream is cut into batches, since a row that comes after the interval calls the recheck first.
    """

    def __init__(self, interval: int):
        self.interval = interval

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("article", "hash string, checked long, due boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hash_, checked, due = self.state.get() if self.state.exists() else ("", None, False)
        seen = pd.concat(rows).sort_values(["at", "hash"], kind="stable")
        out = []
        for at, new in zip(seen["at"].tolist(), seen["hash"].tolist(), strict=True):
            if checked is not None and at < checked:
                out.append((at, "LATE", "older than the last sight", new, hash_))
                continue
            if checked is not None and not due and at >= checked + self.interval:
                out.append((checked + self.interval, "PENDING", "recheck", hash_, hash_))
            if checked is None:
                out.append((at, "PENDING", "new", new, ""))
            elif not new or not hash_:
                out.append((at, "REUSED", "unknown", new, hash_))
            else:
                out.append((at, "REUSED", "unchanged", new, hash_) if new == hash_ else (at, "PENDING", "changed", new, hash_))
            hash_, checked, due = new or hash_, at, False
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not due:
            self.handle.registerTimer(-(-(checked + self.interval) // 1000))
        self.state.update((hash_, checked, due))
        yield self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        hash_, checked, due = self.state.get()
        self.state.update((hash_, checked, True))
        yield self._rows(key, [] if due else [(checked + self.interval, "PENDING", "recheck", hash_, hash_)])

    def close(self) -> None:
        pass

    @staticmethod
    def _rows(key, out: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame(out, columns=["at", "state", "reason", "hash", "previous_hash"])
        made.insert(0, "key", [key[0]] * len(out))
        return made.astype({"at": "int64"})


def article_states(stream: DataFrame, key: str, ts: str, hash_col: str, days: int = 7, late: str = "1 day") -> DataFrame:
    """(key, seen_at, state, reason, hash, previous_hash): a row for every version seen, and one for every recheck that falls due.

    A first or changed version is PENDING, an equal one REUSED; without a hash on either side nothing can be told and the
    processing is reused. A key not seen for ``days`` is PENDING for a recheck at that time, once until it is seen again:
    by a timer when the watermark passes it, or at the latest when its next version comes. Rows later than ``late`` are
    dropped by the watermark, those within it that are older than the last sight change nothing (LATE). A null key is a
    key of its own, rows without a time are dropped. A batch's versions of one key (time and hash) are sorted in memory:
    bound a batch by the source's ``maxBytesPerTrigger``. State lives in RocksDB (``run_states`` sets it).
    """
    rows = stream.select(F.col(key).alias("key"), F.col(ts).cast("timestamp").alias("_ts"), F.coalesce(F.col(hash_col).cast("string"), F.lit("")).alias("hash")).where("_ts is not null")
    marked = rows.withColumn("at", F.unix_micros("_ts")).withWatermark("_ts", late)
    kind = stream.schema[key].dataType.simpleString()
    out = f"key {kind}, at bigint, state string, reason string, hash string, previous_hash string"
    told = marked.groupBy("key").transformWithStateInPandas(_Rechecks(days * _DAY), out, "append", "EventTime")
    return told.select("key", F.timestamp_micros("at").alias("seen_at"), "state", "reason", "hash", "previous_hash")


def run_states(spark: SparkSession, run) -> DataFrame:
    """``run()`` with the state store that keyed state with timers needs."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        return run()
    finally:
        spark.conf.set(_STORE, before)
