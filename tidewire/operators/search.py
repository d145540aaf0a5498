"""Search of groups by what any of their members says: a stored inverted index of words, postings intersected, then the texts of candidates."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.sources.shared_folder import written

#: What ends a word; the index and the queries are cut alike.
_CUT = "[^\\p{L}\\p{N}]+"


@dataclass(frozen=True)
class Index:
    """(word, id) of every distinct word of every member, and the words with the number of members they are in."""

    postings: DataFrame
    vocabulary: DataFrame


def _lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text.cast("string"), F.lit("")))


def build(members: DataFrame, id_col: str = "id", text_col: str = "text") -> Index:
    """The index of (id, text); members of a group are never brought together."""
    words = F.explode(F.array_distinct(F.filter(F.split(_lowered(F.col(text_col)), _CUT), lambda w: w != "")))
    postings = written(members.select(F.col(id_col).alias("id"), words.alias("word")).repartition("word").sortWithinPartitions("word"), "postings")
    return Index(postings, written(postings.groupBy("word").agg(F.count("*").alias("members")), "vocabulary"))


def _matches(query: str) -> list[Column]:
    """For each part of a (lowered) query, which words may hold it: the outer parts may be an end or a beginning of one."""
    parts = [p for p in re.split(r"[\W_]+", query) if p]
    out = []
    for i, part in enumerate(parts):
        open_left, open_right = i == 0 and query.startswith(part), i == len(parts) - 1 and query.endswith(part)
        word = F.col("word")
        out.append(F.contains(word, F.lit(part)) if open_left and open_right else word.endswith(part) if open_left else word.startswith(part) if open_right else word == part)
    return out


def search(index: Index, members: DataFrame, queries: list[str], id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(query, columns of ``members``) of every member whose text holds a query, without case, wherever it stands in it.

    The vocabulary, not the texts, is searched for the parts of a query; the postings of what is found are intersected
    within a member, and only the candidates' texts are read for the whole query. A query without a letter or digit
    has no part in the index and is looked for in all texts; an empty one matches nothing. ``queries`` is what a person
    or a profile asks: a short list, part of the plan.
    """
    out = None
    for query in dict.fromkeys(q.strip().lower() for q in queries):
        parts = _matches(query)
        if not query:
            continue
        found = members
        for matches in parts:
            ids = index.postings.join(index.vocabulary.where(matches).select("word"), "word").select(F.col("id").alias("_id")).distinct()
            found = found.join(ids, members[id_col] == F.col("_id"), "left_semi")
        held = found.where(F.contains(_lowered(F.col(text_col)), F.lit(query))).select(F.lit(query).alias("query"), *members.columns)
        out = held if out is None else out.unionByName(held)
    return out if out is not None else members.where("false").select(F.lit("").alias("query"), *members.columns)


def groups(found: DataFrame, group: str = "component") -> DataFrame:
    """(query, group, members): groups with a member that was found, each a row of counts."""
    return found.groupBy("query", F.col(group).alias("group")).agg(F.count("*").alias("members"))
