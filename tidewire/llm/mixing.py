"""Mixing sources to target weights: Efraimidis-Spirakis keys, sorted within source, summed up to a word budget.

DataFrame functions only. Each source gets a share of all words in proportion to its weight, at most ``MOST`` times its
own words; what is above is shared again by weight, in closed form over the table of sources. A source whose target is
q times its words and a rest gives q complete epochs and then documents in order of their keys
-ln(u) / quality up to the rest; u is a hash of the document, so reruns agree, and a document is taken whole, the one
across the budget only if that comes nearer to it. Hot sources are summed in ranges of the keys, so no task holds one:
the keys of a source are distributed as its qualities tell (a mixture of exponentials), and the ranges are cut evenly
by that distribution.

Defined results: a null or empty text has size 0 and is taken for 0 words; null is a source, last in order; a source
without words has target 0. Rows of equal id and text have equal keys; their order is that of the id, then the text's
hash, and any between fully equal rows. The table of sources is windowed in one task: a row a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.sources.shared_folder import written

WEIGHTS, MOST, SEED = (5, 2, 1), 3, "mix-1"
#: Marks that clean prose has few of; their share of a text lowers its quality.
MARKS = "#$%&*|!{}[]<>\\^~="


def words(text: Column) -> Column:
    """Number of runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def quality(text: Column) -> Column:
    """Weight of a document, 1 for clean text, falling with its share of marks to 0.1."""
    share = (F.length(text) - F.length(F.translate(text, MARKS, ""))) / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(1 - 5.0 * share, F.lit(0.1)), F.lit(1.0))


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Uniform in (0, 1): 32 bits of the md5 of the seed, the id and, where that is null, the text."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))))
    return (F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, docs, target) from one row a document.

    The windows below run over one row a source. Sources are capped in ascending order of cap over weight: the first
    one whose cap holds the level that is left, and all after it, get that level times their weight.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    place = (F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1) % len(weights)
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), place.cast("int") + 1))
    weighed = weighed.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    total = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum(F.col("source_size").cast("double")).over(total) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levelled = weighed.withColumn("level", level)
    settled = F.min_by("level", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("cap") / F.col("weight"))).over(total)
    share = F.coalesce(settled, F.lit(float("inf"))) * F.col("weight")
    return levelled.select("source", "source_size", "docs", F.least("cap", share).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken, epochs, text_hash) of every row."""
    doc_id, text = F.col(id_col), F.col(text_col).cast("string")
    # Read once: a few numbers a document.
    sizes = docs.select(
        doc_id.alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        words(text).alias("size"),
        quality(text).alias("quality"),
        _place(doc_id, text, seed).alias("place"),
    ).select("doc_id", "source", "size", "quality", "place.key", "place.text_hash")
    return ranked(written(sizes, "sizes"), weights, most)


def _spread(sizes: DataFrame) -> DataFrame:
    """(source, rates) with the share of documents at each level of quality in steps of a twentieth, at most 48 a source."""
    level = F.round(F.log("quality") / 0.05).cast("int")
    levels = sizes.groupBy("source", level.alias("level")).agg(F.count("*").alias("n"), F.avg("quality").alias("rate"))
    return levels.groupBy("source").agg(F.collect_list(F.struct("n", "rate")).alias("rates"))


def ranked(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken, epochs, text_hash, source, key) of rows of sizes, keys and qualities."""
    goals = written(targets(sizes, weights, most).select("source", "source_size", "docs", "target").join(_spread(sizes).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "goals")
    # A small table by its size on disk is broadcast; a large one is not.
    rows = sizes.join(goals, sizes["source"].eqNullSafe(goals["source"])).drop(goals["source"])
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rows = rows.withColumns({"full": full, "rest": F.col("target") - full * F.col("source_size")})
    # As many ranges as rows in each: the share of keys below this one is nearly uniform.
    n, key = F.ceil(F.sqrt("docs")), F.col("key")
    below = F.aggregate("rates", F.lit(0.0), lambda total, r: total + r["n"] * (1 - F.exp(-r["rate"] * key))) / F.col("docs")
    rows = rows.withColumn("range", F.greatest(F.least(F.floor(below * n), n - 1), F.lit(0)).cast("bigint")).drop("rates")
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("in_range").over(upto), F.lit(0)).alias("before"))
    summed = rows.join(ranges, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))).drop("s", "r")
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    summed = summed.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    picked = (F.col("size") > 0) & (F.col("before") + F.col("size") / 2 <= F.col("rest"))
    epochs = F.least(F.col("full") + picked.cast("bigint"), F.lit(int(most)))
    return summed.select("doc_id", "size", "source_size", "target", (F.col("size") * epochs).alias("taken"), epochs.cast("int").alias("epochs"), "text_hash", "source", "key", "full")


def _place(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Where a document stands in the order of its source."""
    return F.struct((-F.log(draw(doc_id, text, seed)) / quality(text)).alias("key"), doc_id.alias("doc_id"), F.xxhash64(text).alias("text_hash"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it; of fully equal rows, together as often as they are taken.

    The mix takes a source's documents once more up to some place of its order, so the texts meet one row a source and
    aren't shuffled. Only rows equal in id and text that share that last place are numbered, if some go and some stay.
    """
    taken = mix(docs, id_col, text_col, source_col).withColumn("place", F.struct("key", "doc_id", "text_hash"))
    picked = F.col("epochs") > F.col("full")
    last = taken.where(picked).groupBy(F.col("source").alias("s")).agg(F.max("place").alias("last"))
    at_last = taken.where("size > 0").join(last, F.col("source").eqNullSafe(F.col("s")) & (F.col("place") == F.col("last"))).groupBy("s").agg(F.count_if(picked).alias("go"), F.count("*").alias("of"))
    fulls = taken.groupBy("source").agg(F.max("full").alias("full"))
    cuts = fulls.join(last, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").join(at_last, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    cuts = written(cuts.select(F.struct("source", "full", "last", F.coalesce("go", F.lit(0)).alias("go"), F.coalesce("of", F.lit(0)).alias("of")).alias("cut")), "cuts")
    doc_id, text = F.col(f"doc.{id_col}"), F.col(f"doc.{text_col}").cast("string")
    # The document is one column, so none of its own can clash with those used here.
    rows = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("doc")).join(cuts, F.col(f"doc.{source_col}").cast("string").eqNullSafe(F.col("cut.source")))
    placed = rows.withColumn("place", F.when(words(text) > 0, _place(doc_id, text)))
    at = F.col("place") == F.col("cut.last")
    times = F.col("cut.full") + F.coalesce(F.col("place") <= F.col("cut.last"), F.lit(False)).cast("bigint")
    split = F.coalesce(at & (F.col("cut.go") < F.col("cut.of")), F.lit(False))
    repeated = lambda rows, times: rows.withColumn("copy", F.explode(F.when(times > 0, F.sequence(F.lit(1).cast("bigint"), times)))).select("doc.*")
    if cuts.where("cut.go < cut.of").isEmpty():
        return repeated(placed, times)
    turn = F.row_number().over(Window.partitionBy("cut.source").orderBy(F.lit(1)))
    tied = placed.where(split).withColumn("turn", turn)
    return repeated(placed.where(~split), times).unionByName(repeated(tied, F.col("cut.full") + (F.col("turn") <= F.col("cut.go")).cast("bigint")))


#: The same in DuckDB's SQL.
SQL = """
WITH sizes AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         -ln((CAST('0x' || substr(md5('{seed}:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296.0)
           / coalesce(greatest(1 - 5.0::DOUBLE * ((length(text) - length(translate(text, '{marks}', ''))) / greatest(length(text), 1)::DOUBLE), 0.1), 1.0) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source
), weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight, 3.0::DOUBLE * source_size AS cap FROM sources
), levelled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM weighed WINDOW w AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), settled AS (
  SELECT coalesce((SELECT level FROM levelled WHERE level * weight <= cap ORDER BY cap / weight LIMIT 1), 'inf'::DOUBLE) AS level
), goals AS (
  SELECT source, source_size, least(cap, settled.level * weight) AS target FROM levelled, settled
), ranked AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       (size * least(epochs + (size > 0 AND before + size / 2.0 <= target - epochs * source_size)::INT, 3))::BIGINT AS taken
FROM ranked
""".format(seed=SEED, marks=MARKS.replace("\\", "\\"))
