"""Lexicon matching as columns: containment, counts, phrases, aliases, glossaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.automaton import Scanned, signals


def any_of(text: Column | Scanned, terms: list[str]) -> Column:
    """Whether the (normalised) text contains any term as a substring; a null text has none."""
    if isinstance(text, Scanned):
        return text.any_of(terms)
    found = F.lit(False)
    for term in terms:
        found = found | F.coalesce(F.contains(text, F.lit(term)), F.lit(False))
    return found


def all_of(text: Column | Scanned, terms: Column) -> Column:
    """Whether the text contains every term of an array column; an empty array is met."""
    return F.coalesce(F.forall(terms, lambda t: F.contains(_plain(text), t)), F.lit(True))


def count_of(text: Column | Scanned, terms: list[str]) -> Column:
    """How many terms occur; overlapping terms count each."""
    if isinstance(text, Scanned):
        return text.count_of(terms)
    return sum((F.coalesce(F.contains(text, F.lit(t)), F.lit(False)).cast("int") for t in terms), F.lit(0))


def evidence(text: Column | Scanned, terms: list[str], most: int = 12) -> Column:
    """Which terms occur, in the lexicon's order."""
    if isinstance(text, Scanned):
        return text.evidence(terms, most)
    return F.slice(F.filter(F.array(*map(F.lit, terms)), lambda t: F.contains(text, t)), 1, most)


def weighted_score(title: Column, opening: Column, body: Column, terms: list[str]) -> Column:
    return 5 * count_of(title, terms) + 2 * count_of(opening, terms) + count_of(body, terms)


def _plain(text: Column | Scanned) -> Column:
    return text.text if isinstance(text, Scanned) else text


def exact_token(text: Column | Scanned, token: str, script: str = "\\x{0600}-\\x{06FF}") -> Column:
    """The token with no character of the script on either side."""
    return _plain(text).rlike(f"(^|[^{script}]){token}([^{script}]|$)")


def acronym(text: Column | Scanned, name: str) -> Column:
    return _plain(text).rlike(f"(?i)(^|[^a-z0-9]){name}([^a-z0-9]|$)")


def phrase_pattern(words: str, proclitics: str) -> str:
    """Regex of a phrase, token by token. A text's token may carry proclitics, taken off one by one while more than
    three letters stay, so only before words of three letters or more; the phrase's own words are taken as they are."""
    return "[^\\p{L}\\p{N}]+".join((f"[{proclitics}]*" if len(w) >= 3 and proclitics else "") + w for w in words.split())


def any_phrase(text: Column, phrases: list[str], proclitics: str = "وفبكل") -> Column:
    """Whether one of the phrases stands in the text, with no letter or digit before or after; a null text has none."""
    if not phrases:
        return F.lit(False)
    return F.coalesce(text.rlike(f"(^|[^\\p{{L}}\\p{{N}}])(?:{'|'.join(phrase_pattern(p, proclitics) for p in phrases)})([^\\p{{L}}\\p{{N}}]|$)"), F.lit(False))


def alias_signals(text: Column, aliases: dict[str, list[str]]) -> Column:
    """Names of the signals of which an alias stands in the text between blanks."""
    return signals(F.concat(F.lit(" "), text, F.lit(" ")), {signal: [f" {a} " for a in names] for signal, names in aliases.items()})


def glossary_terms(text: Column, entries: dict[str, list[str]], most: int = 16, locale: str = "ko") -> Column:
    """Preferred terms whose source term or alias occurs, the longest match first, then by name as the locale collates."""
    longest = lambda names: F.array_max(F.array(F.lit(0), *(F.when(F.contains(text, F.lit(n)), F.lit(len(n))).otherwise(0) for n in names)))
    ranked = (F.struct((-longest(names)).alias("rank"), F.collate(F.lit(term), locale).alias("name"), F.lit(term).alias("term")) for term, names in entries.items())
    found = F.filter(F.array(*ranked), lambda s: s["rank"] < 0)
    return F.slice(F.transform(F.array_sort(found), lambda s: s["term"]), 1, most)
