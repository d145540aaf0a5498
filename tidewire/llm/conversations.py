"""Repair of conversations: the cheapest edits after which the roles read ``(s?(ua)+)?``.

A retained-subsequence DP chooses which turns are kept or reroled; all between two retained ones are deleted, priced by
differences of deletion sums, and the roles of the two say what must be inserted. For each role the least of (cost from
a turn retained in that role on) less (its deletion sum) is kept as one running minimum, so a turn costs a constant.
The sums run from the end, so that the edits, read from the start, can be chosen least first among equally cheap ones.

Edits: Keep 0; Rerole to user or assistant 1; Delete 2, the only one allowed for blank and duplicate turns; Insert of an
empty user or assistant turn 5; a truncated turn that stays adds 5. Ties: the least sequence of initials in ASCII.

The rows go by conversation twice, each time as a sorted stream: from last to first without texts, noting for every
turn and state what to do, and from first to last with their texts. Neither holds a conversation, however long it is.

Defined results: a null role or text counts as one space; rows without a conversation's id are one conversation; turns
run in ascending order, nulls first, those of one turn by the hash of role and text; extra columns take no part.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.shared import slices

DELETE, INSERT, TRUNCATED = 2, 5, 5
#: Faults of a turn, the first that holds.
FAULTS = ("", "blank", "duplicate", "truncated")
NEVER = 1 << 60
#: States are the role of the last retained turn: none yet, system, user, assistant. Inserts needed before a turn retained
#: in each role, and before the end; the role that an insert or a change of role gives.
START, SYSTEM, USER, ASSISTANT = range(4)
GAP = ((None, 0, 0, 1), (None, None, 0, 1), (None, None, 1, 0), (None, None, 0, 1))
AT_END = (0, 2, 1, 0)
AFTER = (USER, USER, ASSISTANT, USER)
ROLES = ("", "system", "user", "assistant")
_BLANK = "\t\n\x0b\x0c\r "
EDITS = "conv_id bigint, turn bigint, role string, text string, fault int, edit string, new_role string"


def crc(conv_id: Column, turn: Column) -> Column:
    """What the damage of a row is drawn from."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    return F.crc32(F.concat(text(conv_id), F.lit(":"), text(turn)).cast("binary")) % 20


def damage(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with one row in twenty dropped, emptied, unpunctuated, repeated or given to the user."""
    fault = crc(F.col("conv_id"), F.col("turn"))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = df.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(fault == 0, F.array().cast("array<int>")).when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def suffix_acts(turns: Iterable[tuple[int, int]]) -> Iterator[tuple[str, str, str, str]]:
    """For turns (role, fault) from last to first, what to do with each in every state."""
    deleted, least, after = 0, [NEVER] * 4, [INSERT * n for n in AT_END]
    for role, fault in turns:
        own = [NEVER] * 4
        if fault not in (1, 2):
            extra = TRUNCATED if fault == 3 else 0
            own[USER] = own[ASSISTANT] = 1 + extra
            if role:
                own[role] = extra
        via = [own[x] + after[x] for x in range(4)]
        done = deleted + DELETE
        least = [min(least[x], via[x] - done) for x in range(4)]
        now, acts = [], []
        for q in range(4):
            gaps = GAP[q]
            cost = done + min(INSERT * AT_END[q], *(least[x] + INSERT * gaps[x] for x in range(1, 4) if gaps[x] is not None))
            now.append(cost)
            if cost == DELETE + after[q]:
                acts.append("D")
            else:
                options = [("I" * gaps[x] + ("K" if role == x else "R")) for x in range(1, 4) if gaps[x] is not None and INSERT * gaps[x] + via[x] == cost]
                acts.append(min(options))
        deleted, after = done, now
        yield tuple(acts)


def _facts(df: DataFrame, cols: tuple[str, str, str, str]) -> DataFrame:
    """(conv_id, turn, role, text, digest) of every row."""
    conv, turn, role, text = cols
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), said(role).alias("role"), said(text).alias("text"))
    return rows.withColumn("digest", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))))


def _decided(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, n, fault, acts) of every row: the pass from last to first."""
    stripped = F.rtrim(F.col("text"), F.lit(_BLANK))
    known = rows.select(
        "conv_id",
        "turn",
        "digest",
        F.when(F.startswith("role", F.lit("s")), SYSTEM).when(F.startswith("role", F.lit("u")), USER).when(F.startswith("role", F.lit("a")), ASSISTANT).otherwise(0).alias("initial"),
        (stripped == "").alias("blank"),
        (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    # Streams over the copies of one turn's text; their sort may spill.
    n = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first()))
    turns = known.withColumn("n", n).select(
        "conv_id", "turn", "digest", "n", "initial", F.when(F.col("blank"), 1).when(F.col("n") > 1, 2).when(F.col("open"), 3).otherwise(0).alias("fault")
    )
    backwards = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").desc_nulls_last(), F.col("digest").desc(), F.col("n").desc())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, acts, waiting = object(), None, deque()
        for batch in batches:
            out = []
            for conv, role, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "initial", "fault")), strict=True):
                if conv != held:
                    held, waiting = conv, deque()
                    acts = suffix_acts(_drain(waiting))
                waiting.append((role, fault))
                out.append(",".join(next(acts)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "turn", "digest", "n", "fault")), pa.array(out, pa.string())], ["conv_id", "turn", "digest", "n", "fault", "acts"])

    return backwards.mapInArrow(run, "conv_id bigint, turn bigint, digest binary, n int, fault int, acts string")


def _drain(waiting: deque) -> Iterator[tuple[int, int]]:
    while True:
        yield waiting.popleft()


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, fault, edit, new_role) of every given and every inserted turn, a conversation's in one partition and in order.

    ``edit`` is K, R, D or I; ``new_role`` is the role in the repaired conversation, null for a deleted turn; an inserted
    turn has no ``turn`` and ``role`` and an empty text. ``fault`` is the index in ``FAULTS``.
    """
    rows = _facts(df, (conv_col, turn_col, role_col, text_col))
    decided = _decided(rows).select("conv_id", "turn", "digest", F.lit(0).alias("kind"), "n", "fault", "acts", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    told = rows.select("conv_id", "turn", "digest", F.lit(1).alias("kind"), F.lit(0).alias("n"), F.lit(0).alias("fault"), F.lit(None).cast("string").alias("acts"), "role", "text")
    both = decided.unionByName(told).repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "digest", "kind", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state, acts = object(), START, deque()
        names = ["conv_id", "turn", "role", "text", "fault", "edit", "new_role"]

        def ended() -> Iterator[tuple]:
            at = state
            for _ in range(AT_END[at]):
                at = AFTER[at]
                yield (held, None, None, "", 0, "I", ROLES[at])

        def table(out: list) -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        for batch in slices(batches, "text"):
            out: list[tuple] = []
            for conv, turn, kind, fault, act, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "kind", "fault", "acts", "role", "text")), strict=True):
                if conv != held:
                    out += ended()
                    held, state = conv, START
                if not kind:
                    acts.append((fault, act))
                    continue
                fault, act = acts.popleft()
                act = act.split(",")[state]
                for edit in act:
                    if edit == "D":
                        out.append((conv, turn, role, text, fault, "D", None))
                        continue
                    state = "-sua".index(role[0]) if edit == "K" else AFTER[state]
                    new = ROLES[state]
                    out.append((conv, None, None, "", 0, "I", new) if edit == "I" else (conv, turn, role, text, fault, edit, role if edit == "K" else new))
            if out:
                yield table(out)
        out = list(ended())
        if out:
            yield table(out)

    return both.mapInArrow(run, EDITS)


class _Conversation:
    """Counts and digests of one conversation as its turns go by."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.faults, self.illegal, self.cost, self.audit, self.text = conv_id, [0] * 4, 0, 0, [], hashlib.sha256()
        self.first = self.last = self.role = None
        self.turns, self.retained = 0, False

    def add(self, turn: int | None, role: str | None, text: str, fault: int, edit: str, new_role: str | None) -> None:
        self.audit.append(edit)
        self.cost += {"K": 0, "R": 1, "D": DELETE, "I": INSERT}[edit] + (TRUNCATED if fault == 3 and edit != "D" else 0)
        if edit != "D":
            self.text.update(f"{chr(10) if self.retained else ''}{new_role}:{text}".encode())
            self.retained = True
        if edit == "I":
            return
        self.faults[fault] += 1
        if self.role is not None and self.role + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = role[:1]
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.text.hexdigest())


def summary(edits: DataFrame) -> DataFrame:
    """A row a conversation of ``repair``'s result, read in its own order: gaps, faults, cost, audit and the repaired text's hash."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [*([pa.int64()] * 7), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in slices(batches, "text"):
            done = []
            for conv, *rest in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True):
                if current is None or conv != current.conv_id:
                    if current is not None:
                        done.append(current.row())
                    current = _Conversation(conv)
                current.add(*rest)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(current.row(), types, strict=True)], names)

    return edits.mapInArrow(run, "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")


def repaired_after_damage(df: DataFrame) -> DataFrame:
    """``summary`` of every conversation of ``df`` after ``damage``; one without rows left has zeros, no audit and the hash of nothing."""
    made = summary(repair(damage(df))).withColumnRenamed("conv_id", "_made")
    ids = df.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    joined = ids.join(made, F.col("conv_id").eqNullSafe(F.col("_made")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *(F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


#: ``repaired_after_damage`` in DuckDB's SQL: one prefix of least (cost, audit) for each role of the last turn, row by row.
SQL = r"""
WITH RECURSIVE polynomial AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs
), drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), coded AS (
  SELECT d.*, xor(list_reduce([4294967295] || list_transform(range(1, len(k) + 1), lambda i: ascii(k[i:i])::BIGINT), lambda c, b: xor(c >> 8, crcs[xor(c & 255, b) + 1])), 4294967295) % 20 AS f FROM drawn d, polynomial
), damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE f WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM coded
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(len(role) || ':' || role || text), copy) AS i FROM damaged
), told AS (
  SELECT *, left(role, 1) AS r, regexp_matches(text, '[^\x20\x09-\x0D]') AS said, regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS ended,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ordered
), turns AS (
  SELECT conv_id, turn, i, r, before, role, text AS said, CASE WHEN NOT told.said THEN 1 WHEN again THEN 2 WHEN NOT ended THEN 3 ELSE 0 END AS fault FROM told
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (before || r NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM turns GROUP BY conv_id
), walk AS (
  SELECT conv_id, 0::BIGINT AS i, {'cost': 0, 'audit': '', 'text': ''} AS none, {'cost': 1000000000, 'audit': '', 'text': ''} AS system,
    {'cost': 5, 'audit': 'I', 'text': chr(10) || 'user:'} AS user_, {'cost': 10, 'audit': 'II', 'text': chr(10) || 'user:' || chr(10) || 'assistant:'} AS assistant FROM counts
  UNION ALL
  SELECT conv_id, i, none, system, user_, list_min([assistant, {'cost': user_.cost + 5, 'audit': user_.audit || 'I', 'text': user_.text || chr(10) || 'assistant:'}]) FROM (
    SELECT conv_id, i, none, system, assistant, list_min([user_] || list_transform([none, system, assistant], lambda p: {'cost': p.cost + 5, 'audit': p.audit || 'I', 'text': p.text || chr(10) || 'user:'})) AS user_ FROM (
      SELECT w.conv_id, t.i, {'cost': none.cost + 2, 'audit': none.audit || 'D', 'text': none.text} AS none,
        list_min([{'cost': system.cost + 2, 'audit': system.audit || 'D', 'text': system.text},
          {'cost': none.cost + CASE WHEN r = 's' THEN own ELSE 1000000000 END, 'audit': none.audit || 'K', 'text': none.text || chr(10) || role || ':' || said}]) AS system,
        list_min([{'cost': user_.cost + 2, 'audit': user_.audit || 'D', 'text': user_.text}]
          || list_transform([none, system, assistant], lambda p: {'cost': p.cost + CASE WHEN r = 'u' THEN own ELSE own + 1 END, 'audit': p.audit || CASE WHEN r = 'u' THEN 'K' ELSE 'R' END,
            'text': p.text || chr(10) || CASE WHEN r = 'u' THEN role ELSE 'user' END || ':' || said})) AS user_,
        list_min([{'cost': assistant.cost + 2, 'audit': assistant.audit || 'D', 'text': assistant.text},
          {'cost': user_.cost + CASE WHEN r = 'a' THEN own ELSE own + 1 END, 'audit': user_.audit || CASE WHEN r = 'a' THEN 'K' ELSE 'R' END,
            'text': user_.text || chr(10) || CASE WHEN r = 'a' THEN role ELSE 'assistant' END || ':' || said}]) AS assistant
      FROM walk w JOIN (SELECT *, CASE fault WHEN 0 THEN 0 WHEN 3 THEN 5 ELSE 1000000000 END AS own FROM turns) t ON w.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = w.i + 1))
), best AS (
  SELECT c.*, list_min([none, assistant]) AS b FROM walk w JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n
)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(b.cost, 0)::BIGINT AS cost, coalesce(b.audit, '') AS audit, sha256(coalesce(b.text[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN best ON a.conv_id IS NOT DISTINCT FROM best.conv_id
"""
