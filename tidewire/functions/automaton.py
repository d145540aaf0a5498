"""Whole lexicons over one text in one pass: an Aho-Corasick automaton over Arrow batches, read by the ladders as columns.

A rule over a text otherwise unfolds into one search of the text for every term of every lexicon, and a plan as large.
``scan`` looks for all terms at once and gives the numbers of those that occur; ``Scanned`` stands in for the text in
``lexicon.any_of``, ``count_of`` and ``evidence``, which then read the numbers.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@lru_cache(maxsize=16)
def _automaton(terms: tuple[str, ...]):
    """Built once a task's process for each lexicon."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        made.add_word(term, i)
    made.make_automaton()
    return made


def occurring(texts: Iterable[str | None], terms: tuple[str, ...]) -> list[list[int]]:
    """For each text the numbers of the (distinct, non-empty) terms that stand in it, ascending; overlapping ones all count."""
    machine = _automaton(terms) if terms else None
    return [sorted({i for _, i in machine.iter(t)}) if t and machine else [] for t in texts]


#: Texts that are Python strings at once; a batch stays in Arrow's memory.
_AT_ONCE = 64


def _listed(texts: pa.Array, terms: tuple[str, ...], kind: pa.DataType, of=lambda found: found) -> pa.Array:
    """What ``of`` makes of the numbers found in each text; of a batch only some texts are Python strings at a time."""
    parts = (texts.slice(i, _AT_ONCE).to_pylist() for i in range(0, len(texts), _AT_ONCE))
    return pa.concat_arrays([pa.array([], kind), *(pa.array([of(f) for f in occurring(part, terms)], kind) for part in parts)])


def signals(text: Column, names: dict[str, list[str]]) -> Column:
    """Names of which a term stands in the text, in their order: one pass and one step of a plan, however many names there are."""
    known = tuple(dict.fromkeys(t for terms in names.values() for t in terms if t))
    order, numbers, of = list(names), {t: i for i, t in enumerate(known)}, {}
    for place, terms in enumerate(names.values()):
        for t in terms:
            of.setdefault(numbers.get(t), set()).add(place)
    always = of.pop(None, set())

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def find(texts: pa.Array) -> pa.Array:
        return _listed(texts, known, pa.list_(pa.string()), lambda found: [order[p] for p in sorted(always.union(*(of[i] for i in found)))])

    return find(text)


class Scanned:
    """A text whose terms were looked for: the text, the column of numbers, and the number of each term."""

    def __init__(self, text: Column, column: Column, numbers: dict[str, int]):
        self.text, self.column, self.numbers = text, column, numbers

    def _of(self, terms: Iterable[str]) -> tuple[list[int], bool]:
        """Numbers of the terms; whether the empty term, which is in every text, is one."""
        terms = list(dict.fromkeys(terms))
        return [self.numbers[t] for t in terms if t], "" in terms

    def any_of(self, terms: Iterable[str]) -> Column:
        numbers, always = self._of(terms)
        if always:
            return F.lit(True)
        return F.arrays_overlap(self.column, F.array(*map(F.lit, numbers))) if numbers else F.lit(False)

    def count_of(self, terms: Iterable[str]) -> Column:
        terms = list(terms)
        repeats = {}
        for t in terms:
            if t:
                repeats[t] = repeats.get(t, 0) + 1
        often = [t for t, n in repeats.items() if n > 1]
        numbers = [self.numbers[t] for t in repeats]
        found = F.size(F.array_intersect(self.column, F.array(*map(F.lit, numbers)))) if numbers else F.lit(0)
        return sum((F.array_contains(self.column, self.numbers[t]).cast("int") * (repeats[t] - 1) for t in often), found + terms.count(""))

    def evidence(self, terms: list[str], most: int) -> Column:
        named = F.array(*(F.struct(F.lit(self.numbers.get(t, -1)).alias("n"), F.lit(t).alias("term")) for t in terms))
        found = F.filter(named, lambda s: (s["n"] < 0) | F.array_contains(self.column, s["n"]))
        return F.slice(F.transform(found, lambda s: s["term"]), 1, most)


def scan(df: DataFrame, texts: dict[str, Column], terms: Iterable[str]) -> tuple[DataFrame, dict[str, Scanned]]:
    """``df`` with a column ``name`` of term numbers for each text, all texts in one pass, and what stands in for them.

    A null text has no terms. The terms are a plan's constant: lexicons, not tables.
    """
    known = tuple(dict.fromkeys(t for t in terms if t))
    numbers = {t: i for i, t in enumerate(known)}
    names = list(texts)

    @F.arrow_udf(T.StructType([T.StructField(n, T.ArrayType(T.IntegerType())) for n in names]))
    def find(*columns: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([_listed(c, known, pa.list_(pa.int32())) for c in columns], names)

    made = df.withColumn("_terms", find(*texts.values()))
    made = made.select(*df.columns, *(F.col("_terms")[n].alias(n) for n in names))
    return made, {n: Scanned(t, F.col(n), numbers) for n, t in texts.items()}
