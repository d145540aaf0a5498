"""Payload files: an object with ``articles`` or a bare array of them; versions of a snapshot; a short export as a document."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidewire.functions.text import first_filled


def read_payload(spark: SparkSession, path: str, articles: T.StructType, required: bool = True) -> DataFrame:
    """Articles with their position, from either form of the file; a missing or broken file is an error, or empty if not required."""
    envelope = T.StructType([T.StructField("articles", T.ArrayType(articles)), *(f for f in articles.fields if f.name != "articles"), T.StructField("_broken", T.StringType())])
    try:
        raw = spark.read.schema(envelope).json(path, multiLine=True, mode="FAILFAST" if required else "PERMISSIVE", columnNameOfCorruptRecord="_broken").where("_broken is null")
    except AnalysisException:
        if required:
            raise
        return spark.createDataFrame([], T.StructType([T.StructField("pos", T.LongType()), *articles.fields]))
    names = [f.name for f in articles.fields]
    nested = raw.where("articles is not null").select(F.posexplode("articles").alias("pos", "a")).select(F.col("pos").cast("bigint").alias("pos"), *(F.col(f"a.{n}").alias(n) for n in names))
    bare = raw.where("articles is null").select(F.monotonically_increasing_id().alias("pos"), *names)
    return nested.unionByName(bare)


def read_first(spark: SparkSession, paths: list[str], articles: T.StructType) -> DataFrame:
    """The articles of the first file that is there; the last one is required."""
    for path in paths[:-1]:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            return read_payload(spark, path, articles)
    return read_payload(spark, paths[-1], articles)


def flattened(df: DataFrame, nested: str, columns: list[str], nested_first: bool = False) -> DataFrame:
    """Columns that may also stand inside a nested record, each from the first filled place."""
    of = lambda c: (F.col(f"{nested}.{c}"), F.col(c)) if nested_first else (F.col(c), F.col(f"{nested}.{c}"))
    return df.withColumns({c: first_filled(*of(c)) for c in columns}).drop(nested)


def enabled_rules(configured: DataFrame, built_in: DataFrame, replaced: str, categories: list[str]) -> DataFrame:
    """Enabled rules of the wanted categories; those built in take the place of a whole configured category."""
    kept = configured.where(F.col("enabled") & (F.col("category") != replaced)).unionByName(built_in, allowMissingColumns=True)
    return kept.where(F.col("category").isin(categories))


def write_version(df: DataFrame, folder: str, version: str) -> str:
    """Write a snapshot beside the earlier ones, never over the one being read."""
    path = f"{folder.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def read_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot of the greatest version; versions are a partition, so only that one is read."""
    every = spark.read.option("basePath", folder).parquet(folder)
    version = F.col("version").cast("string")
    # Numbers inside a version compare as numbers: v9 comes before v10.
    order = F.array_join(F.transform(F.regexp_extract_all(version, F.lit("[0-9]+|[^0-9]+"), 0), lambda x: F.when(x.rlike("^[0-9]"), F.lpad(x, 20, "0")).otherwise(x)), "")
    return every.where(version == str(every.select(version.alias("version")).agg(F.max_by("version", order)).first()[0])).drop("version")


#: Most articles of a document export.
EXPORT_ROWS = 40


def export_document(rows: DataFrame, heading: str, title: str = "title", body: str = "body") -> bytes:
    """A word-processor document of the rows in their order, at most ``EXPORT_ROWS``; more are an error, not cut."""
    found = rows.select(title, body).limit(EXPORT_ROWS + 1).collect()
    if len(found) > EXPORT_ROWS:
        raise ValueError(f"an export holds at most {EXPORT_ROWS} articles")
    line = lambda text, style: f'<w:p><w:pPr><w:pStyle w:val="{style}"/></w:pPr><w:r><w:t xml:space="preserve">{escape(text or "")}</w:t></w:r></w:p>'
    parts = [line(heading, "Title")]
    for r in found:
        parts += [line(r[0], "Heading1"), *(line(p, "Normal") for p in (r[1] or "").split("\n"))]
    main = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    package = "http://schemas.openxmlformats.org/package/2006"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument"
    kind = "application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"
    files = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="{kind}"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}" Target="word/document.xml"/></Relationships>',
        "word/document.xml": f'<w:document xmlns:w="{main}"><w:body>{"".join(parts)}</w:body></w:document>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in files.items():
            archive.writestr(name, f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>{text}')
    return out.getvalue()
