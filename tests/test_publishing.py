"""Gated publication, snapshots by the day, and lexicons scanned at once."""

import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidewire.functions import lexicon
from tidewire.functions.automaton import scan
from tidewire.operators import publishing, ranking

RULES = lambda: {"EMPTY": ("error", F.col("n") <= 0), "LARGE": ("warning", F.col("n") > 100)}


def test_a_bad_batch_is_not_published(spark, tmp_path):
    folder = str(tmp_path / "snap")
    make = lambda rows: spark.createDataFrame(rows, "id string, n int")
    assert publishing.publish(make([("a", 1), ("b", 200)]), folder, "v1", RULES()) == (True, {"rows": 2, "EMPTY": 0, "LARGE": 1, "ID_REPEATED": 0})
    assert publishing.publish(make([("a", 1), ("b", None)]), folder, "v2", RULES()) == (False, {"rows": 2, "EMPTY": 1, "LARGE": 1, "ID_REPEATED": 0})
    assert publishing.publish(make([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)]), folder, "v3", RULES()) == (False, {"rows": 5, "EMPTY": 0, "LARGE": 0, "ID_REPEATED": 2})
    assert sorted(r.id for r in publishing.published(spark, folder).collect()) == ["a", "b"] and sorted(os.listdir(folder)) == ["version=v1"]
    with pytest.raises(Exception):  # noqa: B017
        publishing.publish(make([("a", 1)]).withColumn("n", F.expr("raise_error('lost')").cast("int")), folder, "v4", RULES())
    assert sorted(r.id for r in publishing.published(spark, folder).collect()) == ["a", "b"]
    assert publishing.publish(make([]), folder, "v10", RULES())[0] and publishing.published(spark, folder).count() == 0


def test_only_touched_days_are_rewritten(spark, tmp_path):
    folder = str(tmp_path / "days")
    rows = spark.range(60).selectExpr("id AS k", "date_add(date'2024-01-01', CAST(id % 6 AS INT)) AS day", "1 AS n")
    publishing.rewrite_days(rows, folder)
    files = lambda: {d: sorted(os.listdir(f"{folder}/{d}")) for d in os.listdir(folder) if d.startswith("day=")}
    before = files()
    snapshot = spark.read.schema(rows.schema).parquet(folder)
    changes = spark.createDataFrame([(2, date(2024, 1, 3), 9), (100, date(2024, 1, 3), 9), (101, date(2024, 2, 1), 9)], "k bigint, day date, n int")
    made = publishing.touched_days(changes, snapshot, "k")
    assert "PartitionFilters: [isnotnull(day" in made._jdf.queryExecution().toString() or "PartitionFilters: [day" in made._jdf.queryExecution().toString()
    publishing.rewrite_days(made, folder)
    after = files()
    assert {d for d in after if after[d] != before.get(d)} == {"day=2024-01-03", "day=2024-02-01"}
    now = spark.read.schema(rows.schema).parquet(folder)
    assert now.count() == 62 and {r.k for r in now.where("n = 9").collect()} == {2, 100, 101}
    assert publishing.drop_days(spark, folder, date(2024, 1, 3)) == ["day=2024-01-01", "day=2024-01-02"]
    assert spark.read.schema(rows.schema).parquet(folder).count() == 42


def test_scanned_lexicons_equal_searches(spark):
    draw = random.Random(6)
    terms = ["ab", "b", "abc", "ca b", "زيت", "aa", "c"]
    rows = [("".join(draw.choice("abc زيت") for _ in range(draw.randint(0, 14))), "abc ab") for _ in range(60)] + [(None, None), ("", "x")]
    df = spark.createDataFrame(rows, "t string, u string")
    made, (t, u) = (lambda pair: (pair[0], list(pair[1].values())))(scan(df, {"t_terms": F.col("t"), "u_terms": F.col("u")}, [*terms, ""]))
    for some in (terms, ["ab", "ab", "zz"][:2], [], ["", "ab"], ["زيت"]):
        for scanned, plain in ((t, F.col("t")), (u, F.col("u"))):
            both = (lexicon.any_of(scanned, some), lexicon.any_of(plain, some), lexicon.count_of(scanned, some), lexicon.count_of(plain, some))
            got = made.where(plain.isNotNull()).select(*(x.alias(f"c{i}") for i, x in enumerate(both))).collect()
            assert [tuple(r) for r in got if r.c0 != r.c1 or r.c2 != r.c3] == [], some
    got = made.where("t is not null").select(lexicon.evidence(t, terms).alias("a"), lexicon.evidence(F.col("t"), terms).alias("b")).collect()
    assert all(r.a == r.b for r in got)
    with pytest.raises(KeyError):
        lexicon.any_of(t, ["never scanned"])


def test_order_as_readers_collate(spark):
    df = spark.createDataFrame([("احمد", None), ("أحمد", None), ("بغداد", None), ("إربيل", None), ("z", "2024-01-01"), ("a", "2024-01-02")], "title string, at string").withColumn("ts", F.to_timestamp("at"))
    assert [r.title for r in df.orderBy(*ranking.by_time(F.col("ts"), F.col("title"))).collect()] == ["a", "z", "أحمد", "احمد", "إربيل", "بغداد"]
    assert [r.title for r in df.orderBy(*ranking.by_time(F.col("ts"), F.col("title"), oldest=True)).collect()][:2] == ["z", "a"]
    entries = {"한국": ["aa"], "가": ["bb"], "나": ["cc"], "abc": ["dd"]}
    assert spark.range(1).select(lexicon.glossary_terms(F.lit("aa bb cc dd"), entries).alias("g")).first().g == ["가", "나", "한국", "abc"]
