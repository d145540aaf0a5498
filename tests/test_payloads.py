import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.operators import enrich
from tidewire.sources import payloads

ARTICLE = T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType())])


@pytest.mark.parametrize("wrap", [lambda rows: {"schemaVersion": "1", "articles": rows}, lambda rows: rows])
def test_either_form_of_payload(spark, tmp_path, wrap):
    (tmp_path / "p.json").write_text(json.dumps(wrap([{"id": "a", "title": "x"}, {"id": "b"}])))
    got = payloads.read_payload(spark, str(tmp_path / "p.json"), ARTICLE).orderBy("pos").collect()
    assert [(r.id, r.title) for r in got] == [("a", "x"), ("b", None)]


def test_missing_payload(spark, tmp_path):
    assert payloads.read_payload(spark, str(tmp_path / "none.json"), ARTICLE, required=False).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        payloads.read_payload(spark, str(tmp_path / "none.json"), ARTICLE).count()


def test_versions(spark, tmp_path):
    for v in ("2024-01-01", "2024-01-02"):
        payloads.write_version(spark.createDataFrame([(v,)], "x string"), str(tmp_path / "s"), v)
    assert [r.x for r in payloads.read_latest(spark, str(tmp_path / "s")).collect()] == ["2024-01-02"]


def test_document_export(spark):
    rows = spark.createDataFrame([("A & B", "one\ntwo")], "title string, body string")
    with zipfile.ZipFile(io.BytesIO(payloads.export_document(rows, "Report"))) as archive:
        assert "A &amp; B" in archive.read("word/document.xml").decode()
    with pytest.raises(ValueError):
        payloads.export_document(spark.range(41).select(F.lit("t").alias("title"), F.lit("b").alias("body")), "Report")


def test_providers_by_table(spark):
    rows = spark.createDataFrame([(1, 50), (2, 90), (3, None)], "id bigint, score int")
    queue = enrich.work_queue(rows, F.lit(True), F.col("id") == 3, F.col("score"), F.col("id"), 2)
    assert [r.id for r in queue.collect()] == [2, 1]
    answers = spark.createDataFrame([(2, 0.5), (9, 0.9)], "id bigint, model double")
    assert {r.id: r.model for r in enrich.enriched(rows, queue, lambda q: answers, "model").collect()} == {1: None, 2: 0.5, 3: None}
    assert [r.id for r in enrich.missing(queue, answers).collect()] == [1]
    assert {r.model for r in enrich.enriched(rows, queue, None, "model").collect()} == {None}
    latest = spark.createDataFrame([(1, "h")], "id bigint, hash string")
    made = spark.createDataFrame([(1, "h", 1), (1, "h", 2), (1, "old", 3), (7, "h", 1)], "id bigint, hash string, ts int")
    assert sorted((r.id, r.ts, r.reason) for r in enrich.newest_current(latest, made, "id", "hash", "ts").collect()) == [(1, 1, "OLDER"), (1, 2, None), (1, 3, "SOURCE_CHANGED"), (7, 1, "UNKNOWN_ID")]
