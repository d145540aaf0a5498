"""Queries over texts: normalisation, tokens, lexicons, ids, rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.functions import ids, lexicon, text
from tidewire.operators import rules
from tidewire.plans.registry import ARTICLES, Tables, query

#: Lexicons for the prose of the driver's tables.
TOPICS = {"economy": ["tion", "ment", "ung"], "security": ["ver", "keit", "ción"], "politics": ["ing", "eau", "que"]}
NOISE, HOME, INSTITUTIONS, FOREIGN, EXCEPTIONS, PRIORITY = ["***", "!!"], ["the", "der"], ["and", "les"], ["ich", "eux"], ["ach"], ["ndly", "ßkeit"]
FLOORS = [("DIRECT", 98, [["ndly"], ["ing"]]), ("PROJECT", 90, [["keit"], ["ung"]]), ("MENTION", 65, [["que"]])]
GATE = rules.Gate(NOISE, HOME, INSTITUTIONS, FOREIGN, EXCEPTIONS, TOPICS, PRIORITY)


def has(expr: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({expr}, '{t}')" for t in terms) + ")"


def count(expr: str, terms: list[str]) -> str:
    return "(" + " + ".join(f"contains({expr}, '{t}')::INT" for t in terms) + ")"


@query(f"""SELECT doc_id, {text.normalize_sql("text", "plain")} AS plain, {text.normalize_sql("text", "lower")} AS lowered,
  {text.normalize_sql("text", "gate")} AS gate, {text.normalize_sql("text", "words")} AS words FROM documents""")
def text_normalize(spark, d):
    docs = Tables(spark, d).spread("documents").select("doc_id", text.normalize(F.col("text"), "plain").alias("plain"))
    return docs.select("doc_id", "plain", *(text.from_plain(F.col("plain"), p).alias(c) for p, c in (("lower", "lowered"), ("gate", "gate"), ("words", "words"))))


@query()
def text_normalize_forms(spark, d):
    """The profiles with form folding, which DuckDB lacks."""
    docs = Tables(spark, d).spread("documents").select("doc_id", text.folded(F.col("text")).alias("folded"))
    return docs.select("doc_id", *(text.normalize(F.col("folded"), p, form_folded=True).alias(p) for p in ("scope", "routing", "origin", "glossary")))


@query(f"""SELECT doc_id, array_to_string(list_sort({text.tokens_sql("text", 3)}), '|') AS tokens, len({text.tokens_sql("text", 3)})::INT AS n FROM documents""")
def text_tokens_distinct(spark, d):
    found = text.tokens(F.col("text"))
    return Tables(spark, d).documents.select("doc_id", found.alias("t")).select("doc_id", F.array_join(F.array_sort("t"), "|").alias("tokens"), F.size("t").alias("n"))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\\b[0-9]+(?:[.,][0-9]+)?\\b'))), '|') AS numbers FROM documents")
def text_numbers(spark, d):
    return Tables(spark, d).documents.select("doc_id", F.array_join(F.array_sort(text.numbers(F.col("text"))), "|").alias("numbers"))


@query("""SELECT doc_id, CASE WHEN length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) > 0 THEN
  floor(length(regexp_replace(text, '[^à-ÿ]', '', 'g'))::DOUBLE / length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) * 10000 + 0.5) / 10000 ELSE 0.0 END AS ratio FROM documents""")
def text_script_ratio(spark, d):
    return Tables(spark, d).documents.select("doc_id", text.script_ratio(F.col("text"), "à-ÿ").alias("ratio"))


@query("SELECT doc_id, left(regexp_replace(text, '(?s)(?:Licensed|Released|All rights).*$', ''), 2200) AS lead FROM documents")
def lead_truncate(spark, d):
    return Tables(spark, d).documents.select("doc_id", text.lead(F.col("text"), ("Licensed", "Released", "All rights")).alias("lead"))


@query(f"""SELECT doc_id, {has("text", TOPICS["economy"])} AS any_term, (contains(text, left(text, 3)) AND contains(text, 'en')) AS all_terms, {count("text", sum(TOPICS.values(), []))} AS n,
  array_to_string(list_filter([{", ".join(f"'{t}'" for t in sum(TOPICS.values(), []))}], lambda t: contains(text, t)), '|') AS evidence FROM documents""")
def lexicon_matches(spark, d):
    t, every = F.col("text"), sum(TOPICS.values(), [])
    return Tables(spark, d).documents.select(
        "doc_id", lexicon.any_of(t, TOPICS["economy"]).alias("any_term"), lexicon.all_of(t, F.array(F.left(t, F.lit(3)), F.lit("en"))).alias("all_terms"),
        lexicon.count_of(t, every).alias("n"), F.array_join(lexicon.evidence(t, every), "|").alias("evidence"),
    )


@query("""SELECT doc_id, regexp_matches(text, '(^|[^a-zA-Z])der([^a-zA-Z]|$)') AS token, regexp_matches(text, '(?i)(^|[^a-z0-9])the([^a-z0-9]|$)') AS acronym,
  regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}])of[^\\p{L}\\p{N}]+the([^\\p{L}\\p{N}]|$)') AS phrase FROM documents""")
def phrase_boundary(spark, d):
    t = F.col("text")
    return Tables(spark, d).documents.select("doc_id", lexicon.exact_token(t, "der", "a-zA-Z").alias("token"), lexicon.acronym(t, "the").alias("acronym"), lexicon.any_phrase(F.lower(t), ["of the"], "").alias("phrase"))


_SCORES = {t: f"(5 * {count('title', terms)} + 2 * {count('lead', terms)} + {count('body', terms)})" for t, terms in TOPICS.items()}
_BEST = f"greatest({', '.join(_SCORES.values())})"


@query(f"""SELECT id, {", ".join(f"{s} AS {t}" for t, s in _SCORES.items())}, CASE {" ".join(f"WHEN {s} >= 2 AND {s} >= {_BEST} THEN '{t}'" for t, s in _SCORES.items())} ELSE 'other' END AS topic FROM {ARTICLES}""")
def topic_route(spark, d):
    scores = rules.topic_scores(F.col("title"), F.col("lead"), F.col("body"), TOPICS)
    scored = Tables(spark, d).articles().select("id", *(s.alias(t) for t, s in scores.items()))
    return scored.withColumn("topic", rules.route({t: F.col(t) for t in TOPICS}, "other"))


_HOME = f"(CASE WHEN {has('title', FOREIGN)} THEN {has('title', EXCEPTIONS)} AND {has('left(lead, 700)', INSTITUTIONS)} ELSE {has('title', HOME)} OR {has('left(lead, 700)', INSTITUTIONS)} OR {has('left(lead, 700)', HOME)} END)"
_TEXT = "(title || ' ' || lead)"
_COUNTS = {t: count(_TEXT, terms) for t, terms in TOPICS.items()}
_GATE = f"""SELECT id, category AS before, CASE WHEN length(title) < 10 THEN 'TITLE_TOO_SHORT' WHEN {has("title", NOISE)} THEN 'NOISE' WHEN {has(_TEXT, PRIORITY)} THEN 'PRIORITY_SUBJECT'
  WHEN category = 'en' AND {_HOME} THEN 'REROUTED' WHEN category <> 'en' AND NOT {_HOME} THEN 'NOT_PRIMARY' ELSE 'NO_CATEGORY_SIGNAL' END AS reason,
  CASE {" ".join(f"WHEN {s} >= 2 AND {s} >= greatest({', '.join(_COUNTS.values())}) THEN '{t}'" for t, s in _COUNTS.items())} ELSE 'en' END AS routed FROM {ARTICLES}"""


@query(f"""SELECT id, before, reason, CASE WHEN reason IN ('PRIORITY_SUBJECT', 'REROUTED') THEN 'keep' ELSE 'drop' END AS action, CASE WHEN reason = 'REROUTED' THEN routed ELSE before END AS category FROM ({_GATE})""")
def gate_decisions(spark, d):
    a = Tables(spark, d).articles()
    gate = rules.category_gate(F.col("category"), F.col("title"), F.col("lead"), GATE, "en")
    return a.select("id", F.col("category").alias("before"), gate.alias("g")).select("id", "before", "g.reason", "g.action", "g.category")


@query(f"SELECT reason, count(*) AS n FROM ({_GATE}) GROUP BY reason")
def gate_reason_counts(spark, d):
    return gate_decisions(spark, d).groupBy("reason").agg(F.count("*").alias("n"))


_B = "(^|[^\\p{{L}}\\p{{N}}])(?:{0})([^\\p{{L}}\\p{{N}}]|$)"
_WORDS = lambda expr, terms: f"regexp_matches({expr}, '{_B.format('|'.join(terms))}')"


@query(f"""SELECT id, CASE WHEN category <> 'en' THEN NULL WHEN {_WORDS("title", ["of", "in"])} AND NOT {_WORDS("title", ["the", "and"])} THEN 'FOREIGN_SECURITY_PRIMARY_TITLE'
  WHEN NOT {_WORDS("title", ["the", "and"])} AND NOT {_WORDS("left(body, 2200)", ["the", "and"])} THEN 'NO_HOME_EVIDENCE' END AS reason FROM {ARTICLES}""")
def scope_gate(spark, d):
    gate = rules.scope_gate(F.col("category"), F.col("title"), F.substring("body", 1, 2200), "en", ["the", "and"], ["of", "in"], "")
    return Tables(spark, d).articles().select("id", gate.alias("reason"))


@query(f"""SELECT id, CASE WHEN {has("title", FOREIGN)} AND NOT {has(_TEXT, HOME)} AND NOT {has("title", EXCEPTIONS)} THEN 'SUSPECT' ELSE 'REVIEWED' END AS audit FROM {ARTICLES}""")
def foreign_audit(spark, d):
    return Tables(spark, d).articles().select("id", rules.foreign_audit(F.col("title"), F.col("lead"), FOREIGN, HOME, EXCEPTIONS).alias("audit"))


_OWN = "CASE " + " ".join(f"WHEN category = '{c}' THEN least({count('body', TOPICS['economy'])} * 15, 40) + least({count('body', TOPICS['politics'])} * 10, 25)" for c in ("en", "fr")) + " ELSE 0 END"
_RULE = f"least(greatest(floor({_OWN} + least(length(source), 10) - CASE WHEN length(body) < 300 THEN 8 ELSE 0 END + 0.5), 0), 100)::INT"
_LEVEL = "CASE WHEN {0} >= 90 THEN 'CRITICAL' WHEN {0} >= 80 THEN 'VERY_HIGH' WHEN {0} >= 70 THEN 'HIGH' WHEN {0} >= 60 THEN 'MEDIUM' WHEN {0} >= 40 THEN 'LOW' ELSE 'MINIMAL' END"


def scored(t: Tables):
    parts = [(TOPICS["economy"], 15, 40), (TOPICS["politics"], 10, 25)]
    score = rules.rule_score(F.col("body"), F.col("category"), {"en": parts, "fr": parts}, F.length("source"), F.lit(True), F.length("body"), F.lit(True))
    return t.articles().withColumn("score", score)


@query(f"SELECT id, score, {_LEVEL.format('score')} AS level FROM (SELECT id, {_RULE} AS score FROM {ARTICLES})")
def importance_rule_score(spark, d):
    return scored(Tables(spark, d)).select("id", "score", rules.level(F.col("score")).alias("level"))


@query(f"""SELECT id, floor, rule, final, {_LEVEL.format("final")} AS level FROM (SELECT id, floor, rule,
  greatest(CASE WHEN quality IS NULL THEN score ELSE floor(0.35::DOUBLE * score + (1 - 0.35::DOUBLE) * quality * 100 + 0.5) END, floor)::INT AS final FROM (
  SELECT id, {_RULE} AS score, CASE {" ".join("WHEN " + " AND ".join(has("body", x) for x in lex) + f" THEN {n}" for _, n, lex in FLOORS)} ELSE 0 END AS floor,
  CASE {" ".join("WHEN " + " AND ".join(has("body", x) for x in lex) + f" THEN '{r}'" for r, _, lex in FLOORS)} END AS rule FROM {ARTICLES}) a LEFT JOIN labels l ON a.id = l.doc_id)""")
def importance_blend(spark, d):
    t = Tables(spark, d)
    rows = scored(t).withColumn("f", rules.floor_of(F.col("body"), FLOORS)).join(t.labels.select(F.col("doc_id").alias("id"), "quality"), "id", "left")
    final = rules.blend(F.col("score"), F.col("quality") * 100, F.col("f.score"))
    return rows.select("id", F.col("f.score").alias("floor"), F.col("f.rule").alias("rule"), final.alias("final"), rules.level(final).alias("level"))


@query("""SELECT doc_id, 'doc-' || left(replace(replace(replace(to_base64(unhex(sha256(text))), '+', '-'), '/', '_'), '=', ''), 24) AS id,
  sha256(trim(regexp_replace(source, '\\s+', ' ', 'g')) || chr(10) || trim(text)) AS hash, left(sha256(text), 20) AS fingerprint FROM documents""")
def stable_ids(spark, d):
    t = F.col("text")
    return Tables(spark, d).documents.select("doc_id", ids.stable_id(t, "doc-").alias("id"), ids.content_hash(F.col("source"), t).alias("hash"), ids.fingerprint(t).alias("fingerprint"))


_TERMS = {"capital": ["tion", "ation"], "project": ["keit", "lichkeit"], "council": ["que", "queeau"], "water": ["eau"]}


@query(f"""SELECT doc_id, array_to_string(list_transform(list_sort(list_filter([{", ".join(f"{{'rank': -greatest({', '.join(f'CASE WHEN contains(text, {chr(39)}{n}{chr(39)}) THEN {len(n)} ELSE 0 END' for n in names)}), 'term': '{t}'}}" for t, names in _TERMS.items())}],
  lambda s: s.rank < 0)), lambda s: s.term), '|') AS terms FROM documents""")
def glossary_longest_match(spark, d):
    return Tables(spark, d).documents.select("doc_id", F.array_join(lexicon.glossary_terms(F.col("text"), _TERMS), "|").alias("terms"))
