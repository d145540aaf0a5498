"""Stable ids, content hashes and keys as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.text import BLANKS, first_filled


def stable_id(value: Column, prefix: str, length: int = 24) -> Column:
    """Prefix and the first characters of the URL-safe base64 of the value's SHA-256."""
    digest = F.base64(F.unhex(F.sha2(value, 256)))
    return F.concat(F.lit(prefix), F.substring(F.translate(digest, "+/=", "-_"), 1, length))


def group_id(members: Column, length: int = 18) -> Column:
    """Id of a group from its sorted members' ids."""
    return stable_id(F.array_join(F.array_sort(members), "|"), "event-", length)


def content_hash(title: Column, body: Column, compact_body: bool = False) -> Column:
    """SHA-256 of the compacted title and the trimmed (or compacted) body; "" if both are empty."""
    squeeze = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), BLANKS, " "))
    t, b = squeeze(title), squeeze(body) if compact_body else F.trim(F.coalesce(body, F.lit("")))
    return F.when((t == "") & (b == ""), F.lit("")).otherwise(F.sha2(F.concat(t, F.lit("\n"), b), 256))


def fingerprint(text: Column, length: int = 20) -> Column:
    return F.substring(F.sha2(text, 256), 1, length)


def article_key(*urls_then_id: Column) -> Column:
    return first_filled(*urls_then_id)
