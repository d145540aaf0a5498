"""Rules over stored records: final scores, readiness, selection and export, validity, retention, reset and restore."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.text import BLANKS, clamp, script_ratio
from tidewire.functions.urls import canonical
from tidewire.operators.incremental import day_in
from tidewire.operators.rules import blend, ladder

# Why a translation is hidden and how a fallback URL was found, as stored data holds them.
HIDDEN_REASON, FALLBACK_METHOD = "LEGACY_TRANSLATION_HIDDEN_IN_BROWSER", "PRIORITY_AGGREGATOR_FALLBACK"
# Output codes and names that stored data hold.
SECTIONS = {"bismayah": "politicsItems", "politics": "politicsItems", "security": "securityItems", "economy": "economyItems", "international": "internationalItems"}
EXPORT_ORDER = ("bismayah", "politics", "security", "economy", "international")
ROUTE_LABELS = {
    "direct-iraq-security-headline": "이라크 직접 관련 치안·안보 기사", "direct-iraq-economic-headline": "이라크 직접 관련 경제 중심 기사",
    "direct-iraq-security-dominant": "이라크 직접 관련 치안·안보 중심 기사", "direct-iraq-economy-dominant": "이라크 직접 관련 경제 중심 기사",
    "direct-iraq-government-or-diplomatic-affairs": "이라크 정부·외교·양국관계 기사", "direct-iraq-economic-affairs": "이라크 경제·사업 기사",
    "direct-iraq-security-affairs": "이라크 치안·안보 기사",
}
KEPT_LABEL = "국제사회 유지"
LEAST_CHARS, LEAST_RATIO, READY_CHARS, EXPORT_ROWS = 300, 0.35, 50, 40


def relevance(score: Column, floor: Column) -> Column:
    return ladder(((floor >= 90) | (score >= 90), "DIRECT"), ((floor >= 70) | (score >= 75), "HIGH"), ((floor >= 40) | (score >= 60), "MEDIUM"), otherwise="LOW")


def outcome(rule: Column, model: Column, model_priority: Column, business: Column, category: Column, default_priority: Column) -> Column:
    """(score, floor, floor_rule, relevance, priority, rule_weight) from a rule's and a model's score and two floors (score, rule).

    The stronger floor counts, the business floor among equals. Where it makes the score, it makes the priority, too.
    """
    stronger = F.when(business["score"] >= category["score"], business).otherwise(category)
    floor = stronger["score"]
    score = blend(rule, F.when(model.isNotNull(), clamp(model)), floor)
    by_floor = ladder((floor >= 90, "MUST_INCLUDE"), (floor >= 80, "PRIORITY_REVIEW"), (floor >= 70, "REVIEW"), otherwise="REFERENCE")
    priority = F.when((floor > 0) & (floor >= score), by_floor).otherwise(F.coalesce(model_priority, default_priority))
    return F.struct(
        score.alias("score"), floor.alias("floor"), stronger["rule"].alias("floor_rule"), relevance(score, floor).alias("relevance"), priority.alias("priority"),
        F.when(model.isNull(), 1.0).otherwise(0.35).alias("rule_weight"),
    )


def section_of(category: Column) -> Column:
    named = F.create_map(*(F.lit(x) for pair in SECTIONS.items() for x in pair))
    return F.coalesce(F.element_at(named, F.lower(category)), F.lit("politicsItems"))


def route_label(reason: Column) -> Column:
    named = F.create_map(*(F.lit(x) for pair in ROUTE_LABELS.items() for x in pair))
    given = F.trim(F.regexp_replace(reason, BLANKS, " "))
    return F.coalesce(F.element_at(named, reason), F.nullif(given, F.lit("")), F.lit(KEPT_LABEL))


def report_range(day: Column) -> Column:
    """(start, end) of the week before a report's day."""
    return F.struct(F.date_sub(day, 7).alias("start"), F.date_sub(day, 1).alias("end"))


def stored_score(*alternatives: Column) -> Column:
    """The first score there is, rounded and kept within 0 and 100; null without one or if it is no number."""
    first = F.coalesce(*(a.cast("string") for a in alternatives)).try_cast("double")
    return F.when(first.isNotNull() & ~F.isnan(first) & (F.abs(first) != float("inf")), clamp(first))


def ready(status: Column, title: Column, text: Column) -> Column:
    """Translated: completed, with a title and a text of ``READY_CHARS``."""
    filled = lambda c: F.trim(F.coalesce(c, F.lit("")))
    return (F.lower(F.coalesce(status, F.lit("pending"))) == "completed") & (filled(title) != "") & (F.length(filled(text)) >= READY_CHARS)


def exportable(is_ready: Column, source_text: Column, id_col: Column) -> Column:
    return is_ready & (F.length(F.trim(F.coalesce(source_text, F.lit("")))) >= LEAST_CHARS) & (F.trim(F.coalesce(id_col, F.lit(""))) != "")


def still_selected(selected: DataFrame, rows: DataFrame, key: str, fine: Column) -> DataFrame:
    """Selected keys that still name a representative row that may be exported."""
    return selected.join(rows.where(F.coalesce("is_representative", F.lit(True)) & fine).select(key), key, "left_semi")


def export_order(category: Column, ts: Column, id_col: Column) -> list[Column]:
    """By category in the export's order, unknown ones last, then the oldest first; a missing date counts as the epoch."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, EXPORT_ORDER)), F.lower(category)), F.lit(0).cast("bigint")), F.lit(99).cast("bigint"))
    return [rank, F.coalesce(ts, F.timestamp_seconds(F.lit(0))), id_col]


def export_verdict(selected: DataFrame, start: str | None, end: str | None, fine: Column, ts: str = "published_at", zone: str = "Asia/Seoul") -> DataFrame:
    """One row (problem, n): what forbids the export of the selected rows, the first that does, null if nothing does."""
    day = day_in(F.col(ts), zone)
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    counted = selected.agg(F.count("*").alias("n"), F.count_if(~fine).alias("unfit"), F.count_if(~F.coalesce(day.between(first, last), F.lit(False))).alias("outside"))
    problem = ladder(
        (first.isNull() | last.isNull(), "DATES"), (F.col("n") == 0, "NOTHING_SELECTED"), (F.col("n") > EXPORT_ROWS, "TOO_MANY"), (F.col("unfit") > 0, "NOT_TRANSLATED"), (F.col("outside") > 0, "OUTSIDE_PERIOD"),
        otherwise=F.lit(None).cast("string"),
    )
    return counted.select(problem.alias("problem"), "n")


def guarded(status: Column, version: Column, title: Column, text: Column, current: str) -> Column:
    """(status, title, text, reset_reason): translations of another pipeline are hidden."""
    own = F.coalesce(version == current, F.lit(False))
    return F.struct(
        F.when(own, status).otherwise("PENDING").alias("status"), F.when(own, title).otherwise("").alias("title"), F.when(own, text).otherwise("").alias("text"),
        F.when(~own, HIDDEN_REASON).alias("reset_reason"),
    )


def translation_errors(status: Column, version: Column, current_version: str, is_current: Column, full: Column, summary: Column) -> Column:
    """Codes of what is wrong with a completed translation; an older pipeline's is LEGACY and nothing else."""
    done = F.upper(F.coalesce(status, F.lit(""))) == "COMPLETED"
    own = F.coalesce(version == current_version, F.lit(False))
    code = lambda bad, name: F.when(F.coalesce(bad, F.lit(True)), F.lit(name))
    found = F.array_compact(F.array(code(~is_current, "STALE"), code(~F.coalesce(full, F.lit(False)), "NOT_MARKED_FULL"), code(summary.isNotNull(), "SUMMARY_PRESENT")))
    return F.when(~done, F.array().cast("array<string>")).when(~own, F.array(F.lit("LEGACY"))).otherwise(found)


def card_errors(facts_status: Column, facts_current: Column, card_status: Column, card_current: Column, card_full: Column, card_text: Column) -> Column:
    """Codes of what is wrong with completed facts and cards; a card must neither claim nor hold a full translation."""
    done = lambda s: F.upper(F.coalesce(s, F.lit(""))) == "COMPLETED"
    no = lambda c: ~F.coalesce(c, F.lit(False))
    code = lambda bad, name: F.when(bad, F.lit(name))
    return F.array_compact(F.array(
        code(done(facts_status) & no(facts_current), "STALE_FACTS"), code(done(card_status) & no(card_current), "STALE_CARD"),
        code(done(card_status) & F.coalesce(card_full, F.lit(True)), "CLAIMS_FULL_TRANSLATION"), code(done(card_status) & card_text.isNotNull(), "FULL_TEXT_IN_CARD"),
    ))


def leaked_columns(df: DataFrame, forbidden: tuple[str, ...]) -> list[str]:
    """Columns that the input of a stage must not have."""
    return [c for c in df.columns if c in forbidden]


def keyword_problems(keywords: DataFrame, key: str = "keyword_id", query: str = "query") -> DataFrame:
    """(rule, id): ids that repeat, queries without a letter of the script."""
    repeated = keywords.groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("DUPLICATE_ID").alias("rule"), "id")
    bare = keywords.where(~F.coalesce(F.col(query).rlike("[\\x{0600}-\\x{06FF}]"), F.lit(False))).select(F.lit("NO_ARABIC_QUERY").alias("rule"), F.col(key).alias("id"))
    return repeated.unionByName(bare)


def first_time(*stamps: Column) -> Column:
    """The first stamp that is a time after the epoch."""
    return F.coalesce(*(F.when(F.unix_micros(t) > 0, t) for t in (F.try_to_timestamp(s) for s in stamps)))


def kept_base(base: DataFrame, current: DataFrame, key: str, stamps: list[str], as_of: Column, days: int = 14) -> DataFrame:
    """Base and current rows of the last days by the first valid stamp; a current row takes the place of its base row."""
    fresh = lambda df: df.where(F.coalesce(first_time(*map(F.col, stamps)) >= as_of - F.expr(f"INTERVAL {days} DAYS"), F.lit(False)))
    old, new = fresh(base), fresh(current)
    missing = old.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").join(new.select(key), key, "left_anti")
    return missing.withColumn("restored", F.lit(True)).unionByName(new.withColumn("restored", F.lit(False)), allowMissingColumns=True)


def seed_valid(enabled: Column, allowed: Column, category: Column, url: Column, title: Column, text: Column) -> Column:
    body = F.trim(F.coalesce(text, F.lit("")))
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    return (
        F.coalesce(enabled, F.lit(True)) & F.coalesce(allowed, F.lit(False)) & F.coalesce(category == "bismayah", F.lit(False)) & filled(url) & filled(title)
        & (F.length(body) >= LEAST_CHARS) & (script_ratio(F.concat_ws("\n", title, body)) >= LEAST_RATIO)
    )


def has_full_text(text: Column, status: Column) -> Column:
    """A text that isn't marked as failed; without a status it counts as full."""
    return (F.trim(F.coalesce(text, F.lit(""))) != "") & (F.upper(F.coalesce(status, F.lit("FULL_TEXT"))) != "FAILED")


def needs_work(is_representative: Column, text: Column, current: Column, least: int) -> Column:
    return F.coalesce(is_representative, F.lit(True)) & (F.length(F.trim(F.coalesce(text, F.lit("")))) >= least) & ~F.coalesce(current, F.lit(False))


def with_fallback(resolved: DataFrame, found: DataFrame, key: str = "id") -> DataFrame:
    """Unresolved rows with the fallback URL of the recovered row of their id, where that row allows one.

    Of several recovered rows of an id the one of the greatest URL counts; a resolved row stays as it is.
    """
    offers = found.where(F.coalesce("allow_fallback", F.lit(False)) & (F.coalesce("fallback_url", F.lit("")) != "")).groupBy(key).agg(F.max("fallback_url").alias("_fallback"))
    open_ = ~F.coalesce((F.col("url_status") == "RESOLVED") & (F.col("url") != ""), F.lit(False)) & F.col("_fallback").isNotNull()
    out = resolved.join(offers, key, "left").withColumn("_open", open_)
    return out.withColumns({
        "url": F.when(F.col("_open"), F.col("_fallback")).otherwise(F.col("url")), "url_status": F.when(F.col("_open"), "RESOLVED").otherwise(F.col("url_status")),
        "method": F.when(F.col("_open"), FALLBACK_METHOD),
    }).drop("_fallback", "_open")


def origin_restored(rows: DataFrame, origins: DataFrame) -> DataFrame:
    """``rows`` (id, title_key, origin) with the snapshot's origin by id, else by title; ``restored`` tells which had another."""
    by_id = origins.where(F.coalesce("id", F.lit("")) != "").groupBy("id").agg(F.max("origin").alias("_by_id"))
    by_title = origins.where(F.coalesce("title_key", F.lit("")) != "").groupBy("title_key").agg(F.max("origin").alias("_by_title"))
    out = rows.join(by_id, "id", "left").join(by_title, "title_key", "left").withColumn("_was", F.coalesce("_by_id", "_by_title"))
    restored = F.coalesce(F.col("_was") != F.coalesce("origin", F.lit("")), F.lit(False))
    return out.withColumn("restored", restored).withColumn("origin", F.coalesce("_was", "origin")).drop("_by_id", "_by_title", "_was")


def last_by_url(items: DataFrame, pos: str = "pos") -> DataFrame:
    """The last item of each canonical URL, the newest first and undated ones last."""
    keyed = items.withColumn("url", canonical(F.col("url")))
    last = keyed.groupBy("url").agg(F.max_by(F.struct(*(c for c in keyed.columns if c != "url")), pos).alias("i"))
    return last.select("url", "i.*").orderBy(F.col("published_at").desc_nulls_last(), pos)


def group_totals(groups: DataFrame) -> DataFrame:
    """Groups, those of more than one report, and all reports that another one represents."""
    return groups.agg(F.count("*").alias("groups"), F.count_if(F.col("member_count") > 1).alias("merged"), F.coalesce(F.sum(F.col("member_count") - 1), F.lit(0)).alias("duplicates"))


def section_dates(reports: DataFrame) -> DataFrame:
    """Days and number of clusters of each section of a report: a few days a section."""
    return reports.groupBy("section").agg(F.array_join(F.array_sort(F.collect_set(F.col("day").cast("string"))), "|").alias("days"), F.count_distinct("cluster_id").alias("clusters"))


def facts_hash(title: Column, facts: Column) -> Column:
    """SHA-256 of a title and its facts as JSON in a fixed order."""
    return F.sha2(F.to_json(F.struct(title.alias("title"), facts.alias("facts"))), 256)


def translation_record(title: Column, text: Column, source: Column, model: Column, version: str) -> Column:
    """What is stored of a model's translation: cut, counted and stamped."""
    whole = F.trim(F.coalesce(text, F.lit("")))
    return F.struct(
        F.lit("COMPLETED").alias("status"), F.lit(version).alias("version"), F.substring(F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), BLANKS, " ")), 1, 300).alias("title"), whole.alias("text"),
        F.length(whole).alias("chars"), F.sha2(source, 256).alias("source_hash"), F.lit(True).alias("full"), model.alias("model"),
    )


def without(df: DataFrame, legacy: tuple[str, ...]) -> DataFrame:
    """``df`` without columns of earlier versions."""
    return df.drop(*legacy)


def locked(record: Column, category: Column) -> Column:
    """A nested record with its category set and locked."""
    return record.withField("category", category).withField("locked", F.lit(True))


def in_batches(queue: DataFrame, done_folder: str, batch: int, answer, key: str = "id") -> DataFrame:
    """Answers for the queue, batch by batch, each written as it is done: a new run asks only for what is missing.

    The batches are partitions of a bounded queue (see ``enrich.work_queue``), so the loop is over numbers of batches.
    """
    spark = queue.sparkSession
    numbered = queue.withColumn("_batch", F.floor((F.row_number().over(Window.orderBy(key)) - 1) / batch).cast("int"))
    done = {int(r["_batch"]) for r in _written(spark, done_folder).select("_batch").distinct().collect()} if _there(spark, done_folder) else set()
    last = numbered.agg(F.max("_batch")).first()[0]
    for number in range(0 if last is None else last + 1):
        if number not in done:
            answer(numbered.where(F.col("_batch") == number).drop("_batch")).write.mode("overwrite").parquet(f"{done_folder}/_batch={number}")
    return _written(spark, done_folder)


def _there(spark, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _written(spark, folder: str) -> DataFrame:
    return spark.read.option("basePath", folder).parquet(folder)




def sanitized(rows: DataFrame, forbidden: Column) -> DataFrame:
    """Rows whose URL is forbidden lose it and are to be resolved again; the others stay as they are."""
    bad = F.coalesce(forbidden, F.lit(False)) & (F.coalesce("url", F.lit("")) != "")
    marked = rows.withColumn("_bad", bad)
    return marked.withColumns({"url": F.when(F.col("_bad"), "").otherwise(F.col("url")), "url_status": F.when(F.col("_bad"), "PENDING").otherwise(F.col("url_status")), "error_code": F.when(F.col("_bad"), "FORBIDDEN_URL")}).drop("_bad")
