"""Keyed state with timers: the same calls however the stream is cut into batches."""

from datetime import datetime, timedelta


from tidewire.streaming.incremental import run_available
from tidewire.streaming.states import article_states, run_states

DAY = timedelta(days=1)
START = datetime(2024, 1, 1)


def told(spark, folder, batches, days=2, late="1 day"):
    schema = "k string, ts timestamp, h string, key int"
    for i, rows in enumerate(batches):
        spark.createDataFrame([(k, None if t is None else START + t * DAY, h, 1) for k, t, h in rows], schema).coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(folder))
    made = run_states(spark, lambda: run_available(article_states(stream, "k", "ts", "h", days, late), "states-test"))
    return sorted((r.key or "-", (r.seen_at - START) / DAY, r.state, r.reason, r.hash, r.previous_hash) for r in made.collect())


def test_states_by_rows_and_timers(spark, tmp_path):
    rows = [("a", 0, "x"), ("a", 1, "x"), ("a", 2, "y"), ("a", 9, "y"), ("b", 1, None), ("b", 1.5, "z"), (None, 3, "n"), ("c", None, "x"), ("d", 9.5, "q"), ("e", 20, "last")]
    want = sorted([
        ("a", 0, "PENDING", "new", "x", ""), ("a", 1, "REUSED", "unchanged", "x", "x"), ("a", 2, "PENDING", "changed", "y", "x"), ("a", 4, "PENDING", "recheck", "y", "y"),
        ("a", 9, "REUSED", "unchanged", "y", "y"), ("a", 11, "PENDING", "recheck", "y", "y"), ("b", 1, "PENDING", "new", "", ""), ("b", 1.5, "REUSED", "unknown", "z", ""),
        ("b", 3.5, "PENDING", "recheck", "z", "z"), ("-", 3, "PENDING", "new", "n", ""), ("-", 5, "PENDING", "recheck", "n", "n"), ("d", 9.5, "PENDING", "new", "q", ""),
        ("d", 11.5, "PENDING", "recheck", "q", "q"), ("e", 20, "PENDING", "new", "last", ""),
    ])
    assert told(spark, tmp_path / "one", [rows]) == want
    in_order = sorted(rows, key=lambda r: -1 if r[1] is None else r[1])
    assert told(spark, tmp_path / "many", [in_order[:4], in_order[4:7], in_order[7:]]) == want


def test_late_rows_change_nothing(spark, tmp_path):
    # The first batch puts the watermark at day 9, in force for late rows one batch later: day 3 is dropped, day 9.5 is told as late.
    got = told(spark, tmp_path / "late", [[("a", 0, "x"), ("a", 10, "x")], [("z", 9.2, "x")], [("a", 3, "y"), ("a", 9.5, "y")], [("a", 10.5, "x")]], days=30)
    got = [r for r in got if r[0] == "a"]
    assert [(t, s, r) for _, t, s, r, _, _ in got] == [(0, "PENDING", "new"), (9.5, "LATE", "older than the last sight"), (10, "REUSED", "unchanged"), (10.5, "REUSED", "unchanged")]
    assert told(spark, tmp_path / "none", [[]]) == []
