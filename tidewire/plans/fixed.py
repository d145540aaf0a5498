"""Queries whose cases are stated as rows: every document is dealt one case, and the SQL says what each must give.

The driver's tables hold no Arabic reports and no stored records, so the cases stand for them: case ``doc_id % n`` goes
to each document, and the rules run over all documents. The tests hold the same rules to the cases one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.plans.registry import Tables


def _value(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def values(columns: str, rows: list[tuple], first: int | None = None) -> str:
    """SQL of the rows, with columns given as "name type, ..."; numbered from ``first`` as ``case_no`` if that is given."""
    named = [c.strip().split(" ", 1) for c in columns.split(",")]
    own = [f"c{i}" for i in range(len(named))]
    casts = ", ".join(f"CAST(c{i} AS {kind}) AS {name}" for i, (name, kind) in enumerate(named))
    if first is None:
        return f"SELECT {casts} FROM (VALUES {', '.join('(' + ', '.join(map(_value, row)) + ')' for row in rows)}) t({', '.join(own)})"
    told = ", ".join("(" + ", ".join(map(_value, (first + i, *row))) + ")" for i, row in enumerate(rows))
    return f"SELECT case_no, {casts} FROM (VALUES {told}) t({', '.join(['case_no', *own])})"


def per_document(columns: str, rows: list[tuple | None]) -> str:
    """SQL of (doc_id, columns): what the case of every document gives; None where it gives no row."""
    n = len(rows)
    blocks = " UNION ALL ".join(values(columns, [r], i) for i, r in enumerate(rows) if r is not None)
    names = ", ".join("cases." + c.strip().split(" ", 1)[0] for c in columns.split(","))
    return f"SELECT doc_id, {names} FROM documents JOIN ({blocks}) cases ON doc_id % {n} = case_no"


def dealt(spark: SparkSession, d: str, rows: list[tuple], schema: str) -> DataFrame:
    """The cases, one for each document, with its doc_id: a broadcast of the cases, no shuffle."""
    cases = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "_n int, " + schema)
    docs = Tables(spark, d).documents.select("doc_id", (F.col("doc_id") % len(rows)).cast("int").alias("_n"))
    return docs.join(F.broadcast(cases), "_n").drop("_n")


def copied(spark: SparkSession, d: str, rows: list[tuple], schema: str, *keys: str) -> DataFrame:
    """Every document has its own copy of all cases, for operators over several rows: keys carry the document's id, so copies never meet."""
    cases = spark.createDataFrame(rows, schema)
    told = [F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, cases.schema.fields, strict=True))) for row in rows]
    each = Tables(spark, d).documents.select("doc_id", F.inline(F.array(*told)))
    own = lambda f: F.col(f.name) + F.col("doc_id") * 1000 if f.dataType.simpleString() in ("bigint", "int") else F.when(F.col(f.name) != "", F.concat(F.col(f.name), F.lit(":"), F.col("doc_id").cast("string"))).otherwise(F.col(f.name))
    return each.select(*(own(f).cast("bigint" if f.dataType.simpleString() == "int" else f.dataType).alias(f.name) if f.name in keys else F.col(f.name) for f in cases.schema.fields))


def per_copy(columns: str, rows: list[tuple], *keys: str) -> str:
    """SQL of what all copies together give."""
    names = [c.strip().split(" ", 1) for c in columns.split(",")]
    own = lambda name, kind: f"cases.{name} + doc_id * 1000" if kind in ("BIGINT", "INT") else f"CASE WHEN cases.{name} <> '' THEN cases.{name} || ':' || doc_id ELSE cases.{name} END"
    picked = ", ".join(f"{own(n, k)} AS {n}" if n in keys else f"cases.{n}" for n, k in names)
    return f"SELECT {picked} FROM documents, ({values(columns, rows)}) cases"
