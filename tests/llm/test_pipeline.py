"""The stages of the corpus pipeline, one by one and in a chain, over odd rows."""

from collections import Counter

import pytest

import corpus_pipeline
from tidewire.llm import mixing, quality, secrets

from .conftest import prose
from .test_operators import components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _p int, doc string"
SECRET = "password = hunter2hunter2"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with nulls, empties, repeated rows, copies, a long text, secrets, clashing names; even ids below 60 are bad."""
    path = tmp_path_factory.mktemp("pipeline")
    base = prose(500, 60)
    rows = [(i, prose(600 + i, 50) if i % 2 else " | ".join(prose(600 + i, 50).split()), f"s{i % 3}") for i in range(60)]
    rows += [(100, base, "s0"), (101, base, "s1"), (102, base + " more", None), (103, None, "s1"), (104, "", None), (None, prose(700, 40), "s0"), (None, None, None), (105, prose(701, 40), "s2"), (105, prose(701, 40), "s2")]
    rows += [(106, prose(702, 20_000), "s2"), (107, f"{prose(703, 30)} {SECRET} {prose(704, 30)}", "s0")]
    docs = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), 1, "x") for i, t, s in rows], SCHEMA)
    docs.write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def _rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_every_stage_on_its_own(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    every, told = _rows(docs), docs.collect()
    # Quality: what the classifier scores below its threshold goes.
    model = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = stages["quality"](spark, docs, folder)
    assert kept.columns == docs.columns
    want = Counter((r.doc_id, r.text) for r in told if model.scores([r.text or ""])[0] >= 0.3)
    assert _rows(kept) == want and 0 < sum(want.values()) < len(told)
    # Near duplicates: the least id of each group stays; rows without an id are no one's copy.
    one = stages["near_duplicates"](spark, docs, folder)
    parts = components([(r.doc_id, r.text) for r in told if r.doc_id is not None])
    assert one.columns == docs.columns
    assert _rows(one) == Counter({k: n for k, n in every.items() if k[0] is None or parts[k[0]][1] == k[0]})
    # Secrets: the same rows, every span replaced, the length that of the new text.
    clean = stages["secrets"](spark, docs, folder).collect()
    assert Counter((r.doc_id, r.text) for r in clean) == Counter((r.doc_id, r.text and secrets.redacted(r.text, secrets.all_spans(r.text)[1])) for r in told)
    assert all(r.n_chars == len(r.text or "") for r in clean) and not any(SECRET in (r.text or "") for r in clean)
    # Mixing: each row as often as the mix takes it.
    mixed = stages["mixing"](spark, docs, folder)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.epochs for r in mixing.mix(docs).collect())
    # Pieces: every text is restored.
    coded = stages["pieces"](spark, docs, folder)
    assert coded.count() == len(told) and coded.where("not restored").count() == 0


def test_chain_and_empty_tables(spark, folder, tmp_path):
    made = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in made}
    assert 100 in ids and not {101, 102} & ids and all(r.restored for r in made)
    assert len([i for i in range(0, 60, 2) if i in ids]) < 3 and len([i for i in range(1, 60, 2) if i in ids]) > 20
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id bigint, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
