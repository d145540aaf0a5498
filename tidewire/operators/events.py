"""Reports of one event: signals, pair scores, sure matches, groups, representatives."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.ids import group_id
from tidewire.functions.lexicon import alias_signals
from tidewire.functions.text import canonical_phrase, normalize, numbers, tokens
from tidewire.operators.similarity import common, grouped, jaccard, overlap, ranges
from tidewire.sources.shared_folder import written

#: Weights of title Jaccard, title overlap, lead Jaccard, signals, numbers; bonuses for one incident type and one title.
WEIGHTS, INCIDENT, EXACT, LEAST, HOURS, LEAD = (0.29, 0.29, 0.18, 0.12, 0.12), 0.08, 0.14, 0.5, 72, 1400
#: Reports of a category and time bucket that a task holds of each side when it compares leads.
BLOCK = 4096
#: Reports whose elements are marked at once, marks, and elements looked up at once.
_ROWS, _MARKS, _LOOKUPS = 64, 16_000_000, 1_000_000


@dataclass(frozen=True)
class Sure:
    """Two reports of one category that share a signal of every family, at most ``hours`` apart, score ``score``."""

    score: float
    hours: float
    families: tuple[tuple[str, ...], ...]


@dataclass(frozen=True)
class Language:
    """How texts become tokens and signals: ``aliases`` and ``cues`` are looked for in title and body, ``actions`` in titles.

    ``canonical``: words lose their articles, in texts and in aliases. Cues serve sure matches only. Signals are sought
    in whole texts, or with ``whole`` off in the lead.
    """

    profile: str = "words"
    canonical: bool = False
    whole: bool = False
    stop: tuple[str, ...] = ()
    aliases: dict[str, list[str]] | None = None
    actions: dict[str, list[str]] | None = None
    cues: dict[str, list[str]] | None = None

    def phrase(self, text: Column) -> Column:
        return canonical_phrase(text, self.profile) if self.canonical else normalize(text, self.profile)


def features(articles: DataFrame, language: Language = Language()) -> DataFrame:
    """(id, category, published_at, title, title_tokens, lead_tokens, signals, actions, cues, numbers and, if given, incident) of articles."""
    texts = articles.withColumns({"_whole": F.concat_ws("\n", "title", "body"), "_numbers": F.concat_ws("\n", "title", F.substring("body", 1, LEAD))})
    texts = texts.withColumn("_lead", F.substring("_whole", 1, LEAD))
    texts = texts.withColumns({"_title": language.phrase(F.coalesce("title", F.lit(""))), "_sought": language.phrase(F.col("_whole" if language.whole else "_lead"))})
    signals = lambda text, names: alias_signals(text, names) if names else F.array().cast("array<string>")
    words = lambda c: tokens(F.coalesce(c, F.lit("")), stop=language.stop, profile=language.profile, canonical=language.canonical)
    return texts.select(
        "id", "category", "published_at", F.col("_title").alias("title"),
        words(F.col("title")).alias("title_tokens"),
        words(F.col("_lead")).alias("lead_tokens"),
        signals(F.col("_sought"), language.aliases).alias("signals"),
        signals(F.col("_title"), language.actions).alias("actions"),
        signals(F.col("_sought"), language.cues).alias("cues"),
        numbers(F.col("_numbers")).alias("numbers"),
        *(["incident"] if "incident" in articles.columns else []),
    )


def same_or_contained(a: Column, b: Column, least: int = 18) -> Column:
    """One title inside the other, or both equal, and the shorter long enough."""
    return (F.least(F.length(a), F.length(b)) >= least) & (F.contains(a, b) | F.contains(b, a))


def _hours_apart() -> Column:
    return F.abs(_seconds(F.col("a_published_at")) - _seconds(F.col("b_published_at"))) / 3600


def pair_score(sure: tuple[Sure, ...] = (), incident: bool = False) -> Column:
    """Score of a joined pair of features, columns prefixed a_ and b_; 0 without enough evidence. ``incident``: there is a type of incident to compare.

    Sure matches read ``every``: signals, actions and cues of a report together.

    First a conflict of actions rules a pair out; then the first sure match counts; then the titles must be near the same, or share much, or share some
    and have support from signals, numbers or leads.
    """
    a, b = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    tj, to = jaccard(a("title_tokens"), b("title_tokens")), overlap(a("title_tokens"), b("title_tokens"))
    lj, ej, nj = (jaccard(a(c), b(c)) for c in ("lead_tokens", "signals", "numbers"))
    shared, exact = common(a("title_tokens"), b("title_tokens")), F.coalesce(same_or_contained(a("title"), b("title")), F.lit(False))
    support = (common(a("signals"), b("signals")) > 0) | (common(a("numbers"), b("numbers")) > 0) | (lj >= 0.16)
    evidence = exact | ((shared >= 3) & (to >= 0.67)) | ((shared >= 2) & (to >= 0.45) & support)
    conflict = (F.size(a("actions")) > 0) & (F.size(b("actions")) > 0) & (common(a("actions"), b("actions")) == 0)
    total = sum((w * x for w, x in zip(WEIGHTS[1:], (to, lj, ej, nj), strict=True)), WEIGHTS[0] * tj) + EXACT * exact.cast("double")
    if incident:
        total = total + F.when((a("incident") == b("incident")) & (a("incident") != ""), INCIDENT).otherwise(0.0)
    out = F.when(conflict, 0.0)
    every = F.array_intersect(a("every"), b("every")) if sure else None
    for rule in sure:
        shared_all = _hours_apart() <= rule.hours
        for family in rule.families:
            shared_all = shared_all & F.arrays_overlap(every, F.array(*map(F.lit, family)))
        out = out.when(shared_all, rule.score)
    return out.when(~evidence, 0.0).otherwise(F.least(total, F.lit(1.0)))


def _bits(hashes: Column, half: int) -> Column:
    """One half of 128 bits, of which each element sets one."""
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(63).cast("int"))
    return F.aggregate(hashes, F.lit(0).cast("bigint"), lambda bits, h: bits.bitwiseOR(F.when(F.shiftright(h, 6).bitwiseAND(1) == half, bit(h)).otherwise(F.lit(0).cast("bigint"))))


def _sketched(nodes: DataFrame) -> DataFrame:
    """Nodes with bits of their tokens, of all words of the title, and of those but the first and the last."""
    words = F.transform(F.split("title", " "), lambda w: F.xxhash64(w))
    of = {"bits": F.col("title_tokens"), "words": words, "inner": F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0)))}
    return nodes.withColumns({f"{name}{half}": _bits(hashes, half) for name, hashes in of.items() for half in (0, 1)})


def _missing(a: str, b: str) -> Column:
    """How many bits of ``a`` are not among those of ``b``: at least as many elements are missing there."""
    return sum((F.bit_count(F.col(f"{a}{half}").bitwiseAND(F.bitwise_not(f"{b}{half}"))) for half in (0, 1)), F.lit(0))


def _candidates(nodes: DataFrame, hours: float) -> DataFrame:
    """(a_node, b_node) of sketched nodes (node, category, bucket, lo, hi, title, hashed title_tokens) that may have evidence within the hours.

    Evidence needs k = max(2, 0.45 n) of the n tokens of the smaller title, or, with one title of 18 characters inside
    the other, all but two. Sorted from the rarest token, the smaller title's first n - k + 1 tokens must therefore hold
    a common one; so only those are looked up among all tokens of the larger title, and frequent tokens meet hardly ever.
    """
    n = F.size("title_tokens")
    sketch = [f"{name}{half}" for name in ("bits", "words", "inner") for half in (0, 1)]
    tokens_ = nodes.select("node", "category", "bucket", "lo", "hi", *sketch, n.alias("n"), (F.length("title") >= 18).alias("long"), F.explode("title_tokens").alias("token"))
    counts = tokens_.groupBy("token").agg(F.count("*").alias("times"))
    most = F.greatest(F.lit(2), F.ceil(0.45 * F.col("n")))
    needed = F.when(F.col("long"), F.greatest(F.lit(1), F.least(most, F.col("n") - 2))).otherwise(most)
    place = F.row_number().over(Window.partitionBy("node").orderBy("times", "token"))
    smaller = tokens_.join(counts, "token").withColumns({"place": place, "most": most}).where(F.col("place") <= F.col("n") - needed + 1)
    smaller = smaller.withColumn("bucket", F.explode(F.array(*(F.col("bucket") + i for i in (-1, 0, 1)))))
    x, y = smaller.alias("x"), tokens_.drop("bits0", "bits1").alias("y")
    met = x.join(y, ["category", "bucket", "token"]).where((F.col("x.node") != F.col("y.node")) & (F.col("x.n") <= F.col("y.n")))
    close = F.greatest("x.lo", "y.lo") - F.least("x.hi", "y.hi") <= hours * 3600
    # Of a title inside another, all words but the first and the last are words of the other.
    inside = F.col("x.long") & F.col("y.long") & ((_missing("x.inner", "y.words") == 0) | (_missing("y.inner", "x.words") == 0))
    enough = inside | (F.col("x.n") - _missing("x.bits", "y.words") >= F.col("x.most"))
    return met.where(close & enough).select(F.least("x.node", "y.node").alias("a_node"), F.greatest("x.node", "y.node").alias("b_node")).distinct()


def _scored(met: DataFrame, feats: DataFrame, least: float, sure: tuple[Sure, ...] = ()) -> DataFrame:
    """The pairs (a_id, b_id) that score enough."""
    side = lambda p, columns: feats.select(*(F.col(c).alias(f"{p}_{c}") for c in columns))
    if sure:
        feats = feats.withColumn("every", F.array_union(F.array_union("signals", "actions"), "cues"))
    scored = met.join(side("a", feats.columns), "a_id").join(side("b", feats.columns), "b_id")
    return scored.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), pair_score(sure, "incident" in feats.columns).alias("score")).where(F.col("score") >= least)


def _combined(timed: DataFrame, sure: tuple[Sure, ...]) -> DataFrame:
    """(id, s, actions, key, width, bucket) of each report, each rule and each choice of one of its signals from every family of the rule, as a table.

    All rules are told in one step, so that a plan does not grow with rules and families. ``width``: the rule's hours in seconds, as long as a bucket is.
    """
    each = lambda keys, own: F.flatten(F.transform(keys, lambda k: F.transform(own, lambda name: F.concat(k, name, F.lit("\x1f")))))
    keyed = lambda keys, width: F.transform(keys, lambda k: F.struct(F.concat(k, F.coalesce("category", F.lit(""))).alias("key"), F.lit(width).alias("width")))
    chosen = []
    for number, rule in enumerate(sure):
        # Names of families hold no such sign, and their number is the rule's, so a category may be any text.
        keys = F.array(F.lit(f"{number}\x1f"))
        for family in rule.families:
            keys = each(keys, F.array_intersect(F.array(*map(F.lit, family)), F.col("_all")))
        chosen.append(keyed(keys, rule.hours * 3600.0))
    made = timed.where("s is not null").withColumn("_all", F.array_union(F.array_union("signals", "actions"), "cues"))
    made = made.select("id", "s", "actions", F.explode(F.concat(*chosen)).alias("_")).select("id", "s", "actions", "_.key", "_.width")
    return written(made.withColumn("bucket", F.floor(F.col("s") / F.col("width"))), "choices")


def _sure_pairs(timed: DataFrame, sure: tuple[Sure, ...]) -> DataFrame:
    """(a_id, b_id) of all pairs that share a choice of signals within the rule's hours."""
    at = _combined(timed, sure)
    x, y = at.alias("x"), at.withColumn("bucket", F.explode(F.array(*(F.col("bucket") + i for i in (-1, 0, 1))))).alias("y")
    met = x.join(y, ["key", "bucket"]).where((F.col("x.id") < F.col("y.id")) & (F.abs(F.col("x.s") - F.col("y.s")) <= F.col("x.width")))
    return met.select(F.col("x.id").alias("a_id"), F.col("y.id").alias("b_id")).distinct()


def _sure_links(timed: DataFrame, sure: tuple[Sure, ...], least: float) -> DataFrame:
    """(a, b): links that join what ``_sure_pairs`` would, without all pairs of a popular choice of signals.

    Reports without actions and those of one action never conflict, so for each action they form a chain in time: those
    of one bucket, as long as the hours, hang on its least id, and a bucket's last and the next one's first are joined.
    """
    sure = tuple(rule for rule in sure if rule.score >= least)
    if not sure:
        return timed.select(F.col("id").alias("a"), F.col("id").alias("b")).where("false")
    at = _combined(timed, sure)
    known = at.select("key", F.explode("actions").alias("action")).distinct().groupBy("key").agg(F.collect_set("action").alias("known"))
    chains = F.when(F.size("actions") > 0, F.col("actions")).otherwise(F.coalesce("known", F.array(F.lit(""))))
    at = at.join(known, "key", "left").withColumn("chain", F.explode(chains))
    at = written(at.select("id", "s", "key", "chain", "width", "bucket"), "chains")
    nodes = at.groupBy("key", "chain", "bucket").agg(F.min("id").alias("node"), F.min("s").alias("lo"), F.max("s").alias("hi"), F.first("width").alias("width"))
    members = at.join(nodes, ["key", "chain", "bucket"]).select(F.col("id").alias("a"), F.col("node").alias("b"))
    before = Window.partitionBy("key", "chain").orderBy("bucket")
    in_turn = nodes.withColumns({"prev": F.lag("node").over(before), "prev_hi": F.lag("hi").over(before)}).where(F.col("lo") - F.col("prev_hi") <= F.col("width"))
    return members.unionAll(in_turn.select(F.col("prev").alias("a"), F.col("node").alias("b")))


def _seconds(published_at: Column) -> Column:
    """A missing date counts as the epoch: undated reports are of one time, and far from all others."""
    return F.coalesce(published_at.cast("timestamp").cast("double"), F.lit(0.0))


def _timed(feats: DataFrame, hours: float) -> DataFrame:
    return feats.withColumn("s", _seconds(F.col("published_at"))).withColumn("bucket", F.floor(F.col("s") / (hours * 3600)))


def _reports(feats: DataFrame, hours: float) -> DataFrame:
    """Features at their time and with their ``node``, a category's title in one time bucket, as a table; words, numbers and nodes are 64-bit hashes."""
    hashed = {c: F.transform(c, lambda x: F.xxhash64(x)) for c in ("title_tokens", "lead_tokens", "numbers")}
    node = F.xxhash64("category", "bucket", "title", "title_tokens")
    return written(_timed(feats, hours).withColumn("node", node).withColumns(hashed), "reports")


def _matchable(reports: DataFrame) -> DataFrame:
    """A title of one token and under 18 characters matches nothing but by a sure match; nor does a report without a category."""
    return reports.where("category is not null").where((F.size("title_tokens") >= 2) | ((F.size("title_tokens") > 0) & (F.length("title") >= 18)))


def _title_pairs(reports: DataFrame, hours: float) -> tuple[DataFrame, DataFrame]:
    """(nodes, pairs of nodes): titles in their buckets, and those that have evidence or would have it with support.

    What titles tell is found once for all reports that bear them. Of a pair, ``old`` is of the earlier bucket; a node
    of several reports is paired with itself. ``titles`` is their part of the score, ``strong`` evidence needs no
    support, and pairs whose actions conflict are left out, as actions are of the title.
    """
    first = [F.first(c).alias(c) for c in ("category", "bucket", "title", "title_tokens", "actions")]
    nodes = _matchable(reports).groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("reports"), F.min("s").alias("lo"), F.max("s").alias("hi"), *first)
    nodes = written(_sketched(nodes), "nodes")
    told = ["node", "category", "bucket", "title", "title_tokens", "actions", "id"]
    side = lambda p: nodes.select(*(F.col(c).alias(f"{p}_{c}") for c in told))
    met = _candidates(nodes, hours).join(side("a"), "a_node").join(side("b"), "b_node")
    own = nodes.where("reports > 1").select(*(F.col(c).alias(f"{p}_{c}") for p in "ab" for c in told))
    n, m, shared = F.size("a_title_tokens"), F.size("b_title_tokens"), common(F.col("a_title_tokens"), F.col("b_title_tokens"))
    exact = F.coalesce(same_or_contained(F.col("a_title"), F.col("b_title")), F.lit(False))
    conflict = (F.size("a_actions") > 0) & (F.size("b_actions") > 0) & (common(F.col("a_actions"), F.col("b_actions")) == 0)
    swap = F.col("a_bucket") > F.col("b_bucket")
    turned = lambda c, x, y: F.when(swap, F.col(f"{y}_{c}")).otherwise(F.col(f"{x}_{c}"))
    likely = (shared >= F.greatest(F.lit(2), 0.45 * F.least(n, m) - 1e-6)) | exact
    pairs = met.where(likely).unionByName(own).where(~conflict).select(
        F.col("a_category").alias("category"), F.greatest("a_bucket", "b_bucket").alias("bucket"), turned("node", "a", "b").alias("old"), turned("node", "b", "a").alias("new"), F.col("a_id").alias("a"), F.col("b_id").alias("b"),
        n.alias("n"), m.alias("m"), shared.alias("shared"), exact.alias("exact"),
    )
    share = F.col("shared") / F.least("n", "m")
    strong = F.col("exact") | ((F.col("shared") >= 3) & (share >= 0.67))
    pairs = pairs.where(strong | ((F.col("shared") >= 2) & (share >= 0.45)))
    titles = WEIGHTS[0] * (F.col("shared") / (F.col("n") + F.col("m") - F.col("shared"))) + WEIGHTS[1] * share
    return nodes, pairs.select("category", "bucket", "old", "new", "a", "b", titles.alias("titles"), strong.alias("strong"), "exact")


def _sets(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, int]:
    """Starts of the rows' elements, the elements as numbers from 0, and how many numbers there are."""
    lists = column.combine_chunks()
    starts, values = lists.offsets.to_numpy(), lists.flatten().to_numpy()
    every, codes = np.unique(values, return_inverse=True)
    return starts - starts[0], codes, len(every)


def _compare_cell(hours: float, least: float) -> Callable:
    """Scores of the pairs of a cell: reports of the older titles, some at a time, against all of the newer titles they are paired with."""

    def compare(key: tuple[pa.Scalar, ...], pairs: pa.Table, reports: pa.Table) -> pa.Table:
        found = [(np.array([], np.int64), np.array([], np.int64), np.array([], np.float64))]
        if len(pairs) and len(reports):
            reports = reports.sort_by("node")
            ids, nodes, s, part, incident = (reports[c].to_numpy() for c in ("id", "node", "s", "part", "incident"))
            sets = [_sets(reports[c]) for c in ("lead_tokens", "signals", "numbers")]
            old, new, titles, strong, exact = (pairs[c].to_numpy() for c in ("old", "new", "titles", "strong", "exact"))
            of_old, of_new = (tuple(np.searchsorted(nodes, x, side) for side in ("left", "right")) for x in (old, new))
            rows, asked = ranges(*of_old), np.repeat(np.arange(len(old)), of_old[1] - of_old[0])
            turn = np.flatnonzero(part[rows] == key[1].as_py())
            turn = turn[np.argsort(rows[turn], kind="stable")]
            rows, asked = rows[turn], asked[turn]
            first, last = of_new[0][asked], of_new[1][asked]
            # A batch ends with the rows whose elements are marked at once, or with the elements looked up at once.
            ranks = np.cumsum(np.diff(rows, prepend=-1) != 0) - 1
            most = max(1, min(_ROWS, _MARKS // max(1, *(size for *_, size in sets))))
            cost = np.cumsum(sum(starts[last] - starts[first] for starts, *_ in sets) + last - first)
            cuts = np.flatnonzero((np.diff(ranks // most) != 0) | (np.diff(cost // _LOOKUPS) != 0)) + 1
            marks = [np.zeros((most, size), bool) for *_, size in sets]
            for begin, end in zip([0, *cuts], [*cuts, len(rows)], strict=True):
                if begin == end:
                    continue
                sizes, at = last[begin:end] - first[begin:end], ranks[begin:end] % most
                row, pair, place, other = np.repeat(rows[begin:end], sizes), np.repeat(asked[begin:end], sizes), np.repeat(at, sizes), ranges(first[begin:end], last[begin:end])
                # Of a title with itself each pair of reports counts once.
                fit = np.where(old[pair] == new[pair], ids[row] < ids[other], ids[row] != ids[other])
                fit &= (part[other] == key[2].as_py()) & (np.abs(s[other] - s[row]) / 3600 <= hours)
                row, pair, place, other = row[fit], pair[fit], place[fit], other[fit]
                own, held = np.unique(rows[begin:end]), np.unique(at)
                own_at = at[np.searchsorted(rows[begin:end], own)]
                shares, shared = [], []
                for (starts, codes, _), mark in zip(sets, marks, strict=True):
                    n, m = starts[row + 1] - starts[row], starts[other + 1] - starts[other]
                    mark[np.repeat(own_at, starts[own + 1] - starts[own]), codes[ranges(starts[own], starts[own + 1])]] = True
                    hits = np.concatenate([[0], np.cumsum(mark[np.repeat(place, m), codes[ranges(starts[other], starts[other + 1])]])])
                    mark[held] = False
                    ends = np.cumsum(m)
                    both = hits[ends] - hits[ends - m]
                    shares.append(both / np.maximum(n + m - both, 1)), shared.append(both)
                leads, signals, figures = shares
                score = titles[pair] + WEIGHTS[2] * leads + WEIGHTS[3] * signals + WEIGHTS[4] * figures + EXACT * exact[pair]
                score = np.minimum(score + np.where((incident[other] == incident[row]) & (incident[row] != 0), INCIDENT, 0.0), 1.0)
                fit = (strong[pair] | (shared[1] > 0) | (shared[2] > 0) | (leads >= 0.16)) & (score >= least)
                found.append((np.minimum(ids[row], ids[other])[fit], np.maximum(ids[row], ids[other])[fit], score[fit]))
        return pa.table(dict(zip(("a", "b", "score"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    return compare


def _compared(reports: DataFrame, pairs: DataFrame, hours: float, least: float) -> DataFrame:
    """(a, b, score) of the reports of paired titles that score ``least`` or more.

    A pair is compared in the cell of its category and later bucket. So a report goes to its own bucket's cell and the
    next one's, twice however many pairs it has, and no pair carries leads through a shuffle. Where a bucket holds more
    than BLOCK reports of a category, the reports fall into parts and the cell into one for each two parts.
    """
    incident = F.lit(0).cast("bigint")
    if "incident" in reports.columns:
        incident = F.when(F.col("incident") != "", F.xxhash64("incident")).otherwise(incident)
    matchable = _matchable(reports).where("id is not null")
    per_cell = matchable.groupBy("category", "bucket").agg(F.count("*").alias("held")).groupBy("category").agg(F.ceil(F.max("held") / BLOCK).alias("parts"))
    split = F.broadcast(written(per_cell.where("parts > 1"), "split"))
    parts = F.coalesce("parts", F.lit(1))
    cells = max(1, reports.count() // 1024)
    cell = lambda bucket: F.pmod(F.xxhash64("category", bucket), F.lit(cells)).alias("cell")
    upto = lambda: F.sequence(F.lit(0).cast("bigint"), parts - 1)
    at = lambda bucket, o, w: F.struct(cell(bucket), o.alias("earlier"), w.alias("later"))
    dealt = matchable.join(split, "category", "left").withColumn("part", F.pmod(F.xxhash64("id"), parts))
    places = [F.transform(upto(), f) for f in (lambda i: at(F.col("bucket"), F.col("part"), i), lambda i: at(F.col("bucket"), i, F.col("part")), lambda i: at(F.col("bucket") + 1, F.col("part"), i))]
    held = dealt.select(
        "id", "node", "s", "part", incident.alias("incident"), "lead_tokens", F.transform("signals", lambda x: F.xxhash64(x)).alias("signals"), "numbers", F.explode(F.array_distinct(F.concat(*places))).alias("at")
    ).select("at.*", "id", "node", "s", "part", "incident", "lead_tokens", "signals", "numbers")
    asked = pairs.join(split, "category", "left").withColumn("earlier", F.explode(upto())).withColumn("later", F.explode(upto()))
    asked = asked.select(cell("bucket"), "earlier", "later", "old", "new", "titles", "strong", "exact")
    keys = ["cell", "earlier", "later"]
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(_compare_cell(hours, least), "a bigint, b bigint, score double")


def match_edges(feats: DataFrame, hours: float = HOURS, least: float = LEAST, sure: tuple[Sure, ...] = ()) -> DataFrame:
    """(a, b, score) of all pairs of one category at most ``hours`` apart that score ``least`` or more.

    Copies give all their pairs here, as these are the result; ``group_edges`` joins the same groups without them.
    """
    reports = _reports(feats, hours)
    pairs = _title_pairs(reports, hours)[1]
    if not sure:
        return _compared(reports, pairs, hours, least)
    # Each step a table of its own: the driver plans a step anew whenever a part of it ends, so one large plan is many.
    compared = written(_compared(reports, written(pairs, "title_pairs"), hours, least), "compared")
    certain = written(_sure_pairs(reports, sure), "certain")
    return compared.join(certain, (F.col("a") == F.col("a_id")) & (F.col("b") == F.col("b_id")), "left_anti").unionByName(_scored(certain, reports.select(*feats.columns), least, sure))


def group_edges(feats: DataFrame, hours: float = HOURS, least: float = LEAST, sure: tuple[Sure, ...] = ()) -> DataFrame:
    """(a, b): links that give the same components as ``match_edges``, with reports of one title taken together.

    Reports of one title in one time bucket (as long as ``hours``) match each other if it has three tokens or 18
    characters, so they hang on the least id of them. Two such titles with strong evidence match by all their reports
    within the hours if the titles alone score enough, and some are exactly if the titles' times are. Only for the
    other pairs of titles are leads compared.
    """
    reports = _reports(feats, hours)
    nodes, pairs = _title_pairs(reports, hours)
    pairs = written(pairs, "title_pairs")
    enough = F.col("strong") & (F.col("titles") + EXACT * F.col("exact").cast("double") >= least)
    members = reports.select(F.col("id").alias("a"), "node").join(pairs.where(enough & (F.col("old") == F.col("new"))).select(F.col("old").alias("node"), "b"), "node").select("a", "b")
    links = members.unionAll(pairs.where(enough & (F.col("old") != F.col("new"))).select("a", "b")).unionAll(_compared(reports, pairs.where(~enough), hours, least).select("a", "b"))
    return links.unionAll(_sure_links(reports, sure, least)) if sure else links


def representative_score(source_rank: Column, chars: Column, title_tokens: Column, translated: Column) -> Column:
    return source_rank * 100_000 + chars + 100 * title_tokens + F.when(translated, 5_000).otherwise(0)


def event_groups(articles: DataFrame, edges: DataFrame, score: Column) -> tuple[DataFrame, DataFrame]:
    """(articles with component, representative and counts; one row a group with its id, span and sources).

    A group's id is a hash of all its members' ids in order, so these (and nothing else) meet in one row.
    """
    parts = written(grouped(articles.withColumn("_score", score), edges), "parts")
    groups = parts.groupBy("component").agg(
        F.min_by("id", F.struct((-F.col("_score")).alias("score"), "id")).alias("representative_id"), F.count("*").alias("member_count"), (F.count("*") - 1).alias("duplicate_count"), F.min("published_at").alias("published_from"), F.max("published_at").alias("published_to"),
        group_id(F.collect_list(F.col("id").cast("string"))).alias("group_id"), F.array_sort(F.collect_set("source")).alias("sources"),
    )
    members = parts.drop("_score").join(groups.select("component", "representative_id", "member_count", "duplicate_count"), "component")
    return members.withColumn("is_representative", F.col("id") == F.col("representative_id")), groups
