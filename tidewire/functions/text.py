"""Text normalisation profiles, tokens, numbers and ratios as columns."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Arabic marks that normalisation deletes, letters it joins, blanks it knows.
MARKS, TATWEEL, QURAN_MARKS = "\\x{064B}-\\x{065F}\\x{0670}", "\\x{0640}", "\\x{06D6}-\\x{06ED}"
LETTERS, LETTERS_AS = "إأآٱىة", "اااايه"
BLANKS = "[\\s\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]+"
WORDLESS = "[^\\p{L}\\p{N}]+"
BIDI = "[\\x{200E}\\x{200F}\\x{202A}-\\x{202E}\\x{2066}-\\x{2069}]"
QUOTES = "[\"'`\\x{201C}\\x{201D}]"


@dataclass(frozen=True)
class Profile:
    """One way to normalise: what is deleted besides the marks, what becomes a blank, and whether case and form are folded."""

    deleted: str = ""
    blank: str = ""
    lower: bool = True
    collapse: bool = True
    nfkc: bool = False
    tags: bool = False


#: The profiles differ on purpose; results depend on which one an operator uses.
PROFILES = {
    "plain": Profile(lower=False),
    "lower": Profile(),
    "gate": Profile(blank=QUOTES),
    "content": Profile(blank=BIDI),
    "event": Profile(blank="[^\\x{0600}-\\x{06FF}0-9\\s]+"),
    "scope": Profile(blank=BIDI, collapse=False, nfkc=True),
    "routing": Profile(deleted=QURAN_MARKS, nfkc=True),
    "origin": Profile(deleted=QURAN_MARKS, blank=WORDLESS, nfkc=True),
    "index": Profile(blank=WORDLESS, lower=False, tags=True),
    "glossary": Profile(nfkc=True),
    "words": Profile(blank=WORDLESS),
}


@F.pandas_udf(T.StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFKC", v))


def folded(text: Column) -> Column:
    """The text with its forms folded (NFKC), once for all profiles that read it; null stays null."""
    return _nfkc(text)


def normalize(text: Column, profile: str | Profile = "lower", form_folded: bool = False) -> Column:
    """The text under a profile; null stays null. Only the form folding leaves the JVM, in Arrow batches; ``form_folded``: it is done."""
    p = PROFILES[profile] if isinstance(profile, str) else profile
    if p.tags:
        text = F.regexp_replace(text, "<[^>]*>", " ")
    if p.nfkc and not form_folded:
        text = _nfkc(text)
    text = F.regexp_replace(text, f"[{MARKS}{TATWEEL}{p.deleted}]", "")
    text = F.translate(text, LETTERS, LETTERS_AS)
    if p.blank:
        text = F.regexp_replace(text, p.blank, " ")
    if p.collapse:
        # Where all but letters and digits became one blank each, there is nothing left to collapse.
        text = F.trim(text if p.blank == WORDLESS else F.regexp_replace(text, BLANKS, " "))
    return F.lower(text) if p.lower else text


def from_plain(plain: Column, profile: str) -> Column:
    """A profile from a text that is already under "plain": what they share is done once. Not for those with a folding of their own."""
    p = PROFILES[profile]
    if p.nfkc or p.tags or p.deleted or not p.collapse:
        raise ValueError(f"{profile} is no refinement of plain")
    text = F.trim(F.regexp_replace(F.regexp_replace(plain, p.blank, " "), BLANKS, " ")) if p.blank else plain
    return F.lower(text) if p.lower else text


def normalize_sql(text: str, profile: str = "lower") -> str:
    """The same in DuckDB's SQL, for profiles without form folding."""
    p = PROFILES[profile]
    if p.tags:
        text = f"regexp_replace({text}, '<[^>]*>', ' ', 'g')"
    text = f"translate(regexp_replace({text}, '[{MARKS}{TATWEEL}{p.deleted}]', '', 'g'), '{LETTERS}', '{LETTERS_AS}')"
    if p.blank:
        text = f"regexp_replace({text}, '{p.blank.replace(chr(39), chr(39) * 2)}', ' ', 'g')"
    if p.collapse:
        text = f"trim(regexp_replace({text}, '{BLANKS}', ' ', 'g'))"
    return f"lower({text})" if p.lower else text


def tokens(text: Column, least: int = 3, stop: tuple[str, ...] = (), profile: str = "words", most_chars: int | None = None, canonical: bool = False) -> Column:
    """Distinct words of at least ``least`` letters that are no stop words, in order; ``canonical``: without their articles."""
    if most_chars:
        text = F.substring(text, 1, most_chars)
    found = F.split(normalize(text, profile), " ")
    found = F.filter(F.transform(found, canonical_token) if canonical else found, lambda w: F.length(w) >= least)
    if stop:
        found = F.filter(found, lambda w: ~w.isin(*stop))
    return F.array_distinct(found)


def tokens_sql(text: str, least: int = 3, profile: str = "words", most_chars: int | None = None) -> str:
    if most_chars:
        text = f"left({text}, {most_chars})"
    return f"list_distinct(list_filter(string_split({normalize_sql(text, profile)}, ' '), lambda w: length(w) >= {least}))"


def canonical_token(word: Column) -> Column:
    """A word without its article: a joined preposition and article become the article, and that goes from longer words."""
    joined = F.when(word.rlike("^[بكفو]ال") & (F.length(word) > 5), F.substring(word, 2, 10_000))
    doubled = F.when(word.startswith("لل") & (F.length(word) > 4), F.concat(F.lit("ال"), F.substring(word, 3, 10_000)))
    whole = F.coalesce(joined, doubled, word)
    return F.when(whole.startswith("ال") & (F.length(whole) > 4), F.substring(whole, 3, 10_000)).otherwise(whole)


def canonical_phrase(text: Column, profile: str = "event") -> Column:
    """The normalised text with every word without its article."""
    return F.array_join(F.filter(F.transform(F.split(normalize(text, profile), " "), canonical_token), lambda w: w != ""), " ")


def numbers(text: Column, bounded: bool = True) -> Column:
    """Distinct numbers, a decimal part included; ``bounded``: not inside ASCII words."""
    # Digits are looked for first: hardly any place needs a look back.
    pattern = "(?=\\d)(?<![A-Za-z0-9_])\\d+(?:[.,]\\d+)?(?![A-Za-z0-9_])" if bounded else "[0-9]+(?:[.,][0-9]+)?"
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 0))


def script_ratio(text: Column, script: str = "\\x{0600}-\\x{06FF}") -> Column:
    """Characters of a script over letters and digits, to four places; 0 without any."""
    of = lambda cls: F.length(F.regexp_replace(text, f"[^{cls}]", ""))
    return F.when(of("\\p{L}\\p{N}") > 0, F.floor(of(script) / of("\\p{L}\\p{N}") * 10_000 + 0.5) / 10_000).otherwise(0.0)


def lead(text: Column, markers: tuple[str, ...], most_chars: int = 2_200) -> Column:
    """The text up to the first marker, matched before normalising, and at most so many characters."""
    return F.substring(F.regexp_replace(text, f"(?s)(?:{'|'.join(markers)}).*$", ""), 1, most_chars) if markers else F.substring(text, 1, most_chars)


def join_fields(*fields: Column, sep: str = "\n") -> Column:
    """Non-empty fields joined; an empty one counts as missing."""
    return F.concat_ws(sep, *(F.nullif(f, F.lit("")) for f in fields))


def first_filled(*fields: Column) -> Column:
    return F.coalesce(*(F.nullif(f, F.lit("")) for f in fields))


def clean_list(items: Column, most_items: int, most_chars: int) -> Column:
    """Items compacted and cut, without the empty ones, at most so many."""
    compact = F.transform(items, lambda x: F.substring(F.trim(F.regexp_replace(x, BLANKS, " ")), 1, most_chars))
    return F.slice(F.filter(compact, lambda x: x != ""), 1, most_items)


def preview(text: Column, most: int = 360) -> Column:
    compact = F.trim(F.regexp_replace(text, BLANKS, " "))
    return F.when(F.length(compact) > most, F.concat(F.substring(compact, 1, most), F.lit("…"))).otherwise(compact)


def clamp(value: Column, low: int = 0, high: int = 100) -> Column:
    """Rounded half up and kept within bounds."""
    return F.least(F.greatest(F.floor(value + 0.5), F.lit(low)), F.lit(high)).cast("int")
