"""Conversation repair against an exhaustive search, and its edge cases."""

import functools
import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tidewire.llm import conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, fault int, digest string, n int"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip("\t\n\x0b\x0c\r ")
        out.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired) by trying every edit everywhere."""
    of = faults(rows)

    @functools.lru_cache(None)
    def go(i, last, inserted):
        options = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def add(cost, edit, then, line=None):
            c, a, o = then
            options.append((cost + c, edit + a, (line, *o) if line else o))

        for x, name in (("u", "user"), ("a", "assistant")):
            if (last, x) in NEXT and inserted < 3:
                add(5, "I", go(i, x, inserted + 1), f"{name}:")
        if i < len(rows):
            _, role, text = rows[i]
            add(2, "D", go(i + 1, last, 0))
            if of[i] not in (1, 2):
                extra = 5 if of[i] == 3 else 0
                if (last, role[:1]) in NEXT:
                    add(extra, "K", go(i + 1, role[:1], 0), f"{role}:{text}")
                for x, name in (("u", "user"), ("a", "assistant")):
                    if (last, x) in NEXT:
                        add(extra + 1, "R", go(i + 1, x, 0), f"{name}:{text}")
        return min(options) if options else (10**9, "", ())

    return go(0, "", 0)


def expected(rows):
    cost, audit, lines = cheapest(tuple(rows))
    of, turns = faults(rows), [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, of.count(1), of.count(2), of.count(3), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def in_order(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    return sorted(rows, key=key)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["a.", "b!", "c", "", " ", "d? "])), max_size=9))
def test_acts_equal_an_exhaustive_search(turns):
    rows = [(i, r, t) for i, (r, t) in enumerate(turns)]
    known = [({"s": 1, "u": 2, "a": 3}.get(r[:1], 0), f) for (_, r, _), f in zip(rows, faults(rows), strict=True)]
    acts = list(conversations.suffix_acts(reversed(known)))[::-1]
    state, audit = 0, ""
    for (role, _), act in zip(known, acts, strict=True):
        audit += act[state]
        for edit in act[state]:
            state = role if edit == "K" else conversations.AFTER[state] if edit in "IR" else state
    audit += "I" * conversations.AT_END[state]
    assert audit == cheapest(tuple(rows))[1]


def test_query_on_odd_conversations(spark):
    draw, rows = random.Random(5), []
    for c in [*range(40), None]:
        for t in range(draw.randint(1, 9)):
            role = draw.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((c, draw.choice([t, t, t, 3, None]), role, draw.choice(["One.", "Two!", "open end", "", " \t", None, "ünï 漢字😀?", "x" * 70_000 + "."])))
    rows += [(50, 1, "user", "Same.")] * 3
    dropped = next(i for i in range(100, 400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "Gone."))
    df = spark.createDataFrame([(*r, 9, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in conversations.repaired_after_damage(df).collect()}
    said = lambda x: " " if x is None else str(x)
    want = {}
    for c, t, role, text in rows:
        k, of = zlib.crc32(f"{said(c)}:{said(t)}".encode()) % 20, want.setdefault(c, [])
        text = "" if k == 1 else re.sub("[.!?]", "", said(text)) if k == 2 else said(text)
        of += [(t, "user" if k == 4 else said(role), text)] * (0 if k == 0 else 2 if k == 3 else 1)
    assert got == {c: expected(in_order(of)) for c, of in want.items()}
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_repair_gives_turns_and_long_conversations(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 2, "assistant", "Yes."), (2, 0, "assistant", "Open"), (2, 1, "user", "Why?")], "conv_id int, turn int, role string, text string")
    made = conversations.repair(df).collect()
    assert [(r.edit, r.new_role, r.text) for r in made if r.conv_id == 1] == [("D", None, "Hi."), ("K", "user", "Again."), ("K", "assistant", "Yes.")]
    assert [r.edit for r in made if r.conv_id == 2] == ["D", "D"]
    n = 30_000
    long = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "CASE WHEN id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role", "concat('Turn ', id, '.') AS text")
    row = conversations.summary(conversations.repair(long)).collect()
    assert len(row) == 1 and row[0].audit == "K" * n and row[0].cost == 0


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repaired_after_damage(empty).collect() == [] and conversations.repair(empty).count() == 0
