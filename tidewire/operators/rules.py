"""Rule ladders: gates, routers, importance. Lexicons and thresholds are parameters; see ``tidewire.operators.profiles``."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.lexicon import any_of, any_phrase, count_of, weighted_score
from tidewire.functions.text import clamp


def ladder(*steps: tuple[Column, object], otherwise: object = None) -> Column:
    """The value of the first step whose condition holds."""
    out = None
    for condition, value in steps:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def scope_gate(category: Column, title: Column, lead: Column, gated: str, home: list[str], foreign: list[str], proclitics: str = "وفبكل") -> Column:
    """Reason to drop a row of the gated category, else null: a foreign title without the home, or no home in title and lead.

    Terms are matched token by token, with proclitics taken off the text's tokens.
    """
    some = lambda text, terms: any_phrase(text, terms, proclitics)
    at_home = some(title, home)
    return ladder(
        (category != gated, F.lit(None).cast("string")),
        (some(title, foreign) & ~at_home, "FOREIGN_SECURITY_PRIMARY_TITLE"),
        (~at_home & ~some(lead, home), "NO_HOME_EVIDENCE"),
        otherwise=F.lit(None).cast("string"),
    )


@dataclass(frozen=True)
class Gate:
    """Lexicons of the category gate; texts and terms are normalised by one profile."""

    noise: list[str]
    home: list[str]
    institutions: list[str]
    foreign: list[str]
    exceptions: list[str]
    signals: dict[str, list[str]]
    priority: list[str] = field(default_factory=list)
    least_title: int = 10
    primary_lead: int = 700


def relevance(title: Column, lead: Column, gate: Gate) -> Column:
    """Whether the article is mainly about the home: by title or opening; with a foreign title only by exception."""
    opening = F.substring(lead, 1, gate.primary_lead)
    opens = any_of(opening, gate.institutions)
    return F.when(any_of(title, gate.foreign), any_of(title, gate.exceptions) & opens).otherwise(any_of(title, gate.home) | opens | any_of(opening, gate.home))


def category_gate(category: Column, title: Column, lead: Column, gate: Gate, open_category: str = "international") -> Column:
    """(action, category, reason): short title, noise, priority subject, relevance, signal of the category, rerouting."""
    text = F.concat_ws(" ", title, lead)
    primary = relevance(title, lead, gate)
    scores = {c: count_of(text, terms) for c, terms in gate.signals.items()}
    best = route(scores, open_category)
    signal = F.lit(False)
    for c, n in scores.items():
        signal = signal | ((category == c) & (n > 0))
    drop = lambda reason: F.struct(F.lit("drop").alias("action"), category.alias("category"), F.lit(reason).alias("reason"))
    keep = lambda to, reason: F.struct(F.lit("keep").alias("action"), to.alias("category"), F.lit(reason).alias("reason"))
    return ladder(
        (F.length(F.coalesce(title, F.lit(""))) < gate.least_title, drop("TITLE_TOO_SHORT")),
        (any_of(title, gate.noise), drop("NOISE")),
        (any_of(text, gate.priority), keep(category, "PRIORITY_SUBJECT")),
        ((category == open_category) & primary, keep(best, "REROUTED")),
        ((category != open_category) & ~primary, drop("NOT_PRIMARY")),
        (~signal, drop("NO_CATEGORY_SIGNAL")),
        otherwise=keep(category, "SIGNAL"),
    )


def route(scores: dict[str, Column], otherwise: str, least: int = 2) -> Column:
    """The category of the highest score of at least ``least``; earlier categories win ties."""
    steps = []
    for c, n in scores.items():
        steps.append(((n >= least) & (n >= F.greatest(*scores.values())) if len(scores) > 1 else n >= least, c))
    return ladder(*steps, otherwise=otherwise)


def topic_scores(title: Column, opening: Column, body: Column, topics: dict[str, list[str]]) -> dict[str, Column]:
    """Weighted score of each topic: 5 for terms of the title, 2 for the opening's, 1 for the body's."""
    return {t: weighted_score(title, opening, body, terms) for t, terms in topics.items()}


def category_alias(value: Column, aliases: dict[str, list[str]]) -> Column:
    """Canonical name: an alias exactly, before " >" or "/", or between blanks; the first family wins; others pass."""
    v = F.trim(F.lower(value))
    steps = []
    for name, family in aliases.items():
        hit = F.lit(False)
        for a in family:
            hit = hit | (v == a) | v.startswith(f"{a} >") | v.startswith(f"{a}/") | F.contains(v, F.lit(f" {a} "))
        steps.append((hit, name))
    return ladder(*steps, otherwise=v)


def capped(text: Column, parts: list[tuple[list[str], int, int]]) -> Column:
    """Sum of sub-scores: each counts its terms at so many points up to its cap."""
    return sum((F.least(count_of(text, terms) * points, F.lit(cap)) for terms, points, cap in parts), F.lit(0))


def rule_score(text: Column, category: Column, profiles: dict[str, list[tuple[list[str], int, int]]], reliability: Column, has_url: Column, chars: Column, representative: Column) -> Column:
    """Importance by rules: the category's capped sub-scores, the source's reliability, penalties; 0 to 100."""
    own = ladder(*((category == c, capped(text, parts)) for c, parts in profiles.items()), otherwise=0)
    penalty = F.when(~has_url, 10).otherwise(0) + F.when(chars < 300, 8).otherwise(0) + F.when(~representative, 15).otherwise(0)
    return clamp(own + F.least(reliability, F.lit(10)) - penalty)


def level(score: Column) -> Column:
    return ladder((score >= 90, "CRITICAL"), (score >= 80, "VERY_HIGH"), (score >= 70, "HIGH"), (score >= 60, "MEDIUM"), (score >= 40, "LOW"), otherwise="MINIMAL")


def floor_of(text: Column, floors: list[tuple[str, int, list[list[str]]]]) -> Column:
    """(score, rule) of the highest floor all of whose lexicons are met; earlier rules win ties."""
    met = [F.when(_all_lexicons(text, lexicons), F.struct(F.lit(score).alias("score"), F.lit(-i).alias("order"), F.lit(rule).alias("rule"))) for i, (rule, score, lexicons) in enumerate(floors)]
    best = F.array_max(F.array_compact(F.array(*met)))
    return F.struct(F.coalesce(best["score"], F.lit(0)).alias("score"), best["rule"].alias("rule"))


def _all_lexicons(text: Column, lexicons: list[list[str]]) -> Column:
    out = F.lit(True)
    for terms in lexicons:
        out = out & any_of(text, terms)
    return out


def blend(rule: Column, model: Column, floor: Column, rule_weight: float = 0.35) -> Column:
    """Final score: the weighted mean of rule and model score if there is one, else the rule's; never below the floor."""
    mixed = F.when(model.isNotNull(), F.floor(rule_weight * rule + (1 - rule_weight) * model + 0.5)).otherwise(rule)
    return F.greatest(mixed, floor).cast("int")


def foreign_audit(title: Column, lead: Column, foreign: list[str], home: list[str], exceptions: list[str]) -> Column:
    """SUSPECT: foreign terms in the title, no evidence of the home and no exception; REVIEWED otherwise."""
    return F.when(any_of(title, foreign) & ~any_of(F.concat_ws(" ", title, lead), home) & ~any_of(title, exceptions), "SUSPECT").otherwise("REVIEWED")


def error_code(message: Column) -> Column:
    m = F.lower(message)
    return ladder(
        (m.rlike("abort|timeout|timed out"), "FETCH_TIMEOUT"), (m.rlike("\\b(404|410)\\b"), "ARTICLE_REMOVED"), (m.rlike("\\b(401|403|429|451)\\b"), "ACCESS_BLOCKED"), otherwise="CONTENT_EXTRACTION_FAILED"
    )


def hydration(url: Column, text_chars: Column, ratio: Column, valid: Column, least_chars: int = 300, least_ratio: float = 0.35) -> Column:
    """Content status: no URL, too short, wrong script, rejected by its category, or full text."""
    return ladder((F.coalesce(url, F.lit("")) == "", "NOT_ATTEMPTED"), (text_chars < least_chars, "FAILED"), (ratio < least_ratio, "FAILED"), (~valid, "FAILED"), otherwise="FULL_TEXT")
