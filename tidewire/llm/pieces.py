"""SentencePiece encoding and decoding by a streaming Viterbi pass.

The vocabulary is a piece model with byte fallback whose scores are ranks of merges. For such a model the best
segmentation of every prefix ends in exactly one piece: the one that stays next to the last piece of the shorter
prefix when the two are encoded together. The pass goes over the characters, keeps for each position of a window that
piece and where it began (the backpointer), and commits ids as soon as the paths back from all positions that a later
piece could still begin at have met in one boundary. The window holds positions no further back than that boundary or
the longest piece: paths are traced back once it has grown by two longest pieces, and what they share is committed.
Characters that no longer piece holds are boundaries at once, and so is a space after a word. ``ScoredPieces`` is the
pass for models whose scores are log probabilities: the best sum of scores at each position.

Defined results: a null text counts as empty; an empty text has no ids. One space is put before a text and taken off
again by decoding, and spaces are kept as they are, so decoding restores every text exactly. The character that stands
for a space inside the vocabulary is encoded by its bytes when a text itself has it, as decoding could not tell it
from a space otherwise.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.shared import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words up to so many characters are remembered by a worker, and so many of them.
REMEMBERED_LENGTH, REMEMBERED = 40, 500_000
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


@dataclass
class Pieces:
    """A vocabulary: ids and ranks of the pieces (a space for the mark of one), ids of the bytes, bytes of every id."""

    ids: dict[str, int]
    ranks: dict[str, float]
    byte_ids: list[int]
    raw: list[bytes]
    longest: int = 0
    joined: frozenset = frozenset()
    _words: dict = field(default_factory=dict)
    _pairs: dict = field(default_factory=dict)
    _grown: dict = field(default_factory=dict)

    def __post_init__(self):
        self.longest = max(map(len, self.ids), default=1)
        self.joined = frozenset(c for p in self.ids if len(p) > 1 for c in p)
        self.names = {i: p for p, i in self.ids.items()}
        #: Runs of characters that longer pieces hold and that are pieces.
        self.plain = re.compile("[" + re.escape("".join(sorted(c for c in self.joined if c in self.ids))) + "]+" if self.joined else r"(?!)")
        #: The pieces that encoding can give, letter by letter; the id is at "".
        self.tree: dict = {}
        for p, i in self.ids.items():
            if self._growth(p):
                node = self.tree
                for c in p:
                    node = node.setdefault(c, {})
                node[""] = i
        # Without a piece that goes on after a word's space, and none that holds a line end, words stand alone.
        alone = not any(" " in p.lstrip(" ") for p in self.ids) and not self.joined & set("\n\t")
        self.word = re.compile(r" *[^ \n\t]+|[\n\t]| +" if alone else r"(?s).+")

    @classmethod
    def load(cls, path: str = MODEL) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids, ranks, byte_ids, raw = {}, {}, [0] * 256, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                code = int(_BYTE.fullmatch(piece)[1], 16)
                byte_ids[code] = i
                raw.append(bytes([code]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                raw.append(b"")
            else:
                piece = piece.replace("▁", " ")
                ids[piece], ranks[piece] = i, -model.get_score(i)
                raw.append(piece.encode())
        return cls(ids, ranks, byte_ids, raw)

    def __getstate__(self):
        return {**self.__dict__, "_words": {}, "_pairs": {}}

    def _growth(self, piece: str) -> tuple | None:
        """How the piece comes about: its symbols at the left and at the right edge in turn, each with the worst rank
        of the joins from its making to its end; nothing if joining the best-ranked neighbours, leftmost first, doesn't
        make the piece."""
        if piece not in self._grown:
            parts, worst, edges = list(piece), [-np.inf, -np.inf], ([], [])
            while len(parts) > 1:
                best = min(((self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.ranks), default=None)
                if best is None:
                    break
                rank, i = best
                worst = [max(w, rank) for w in worst]
                for side, at in ((0, 0), (1, len(parts) - 2)):
                    if i == at:
                        edges[side].append((parts[i + side], worst[side]))
                        worst[side] = -np.inf
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            for side in edges:
                side.append((piece, np.inf))
            self._grown[piece] = edges if parts == [piece] else None
        return self._grown[piece]

    def _stay(self, a: int, b: int) -> bool:
        """Whether the two, encoded together, stay two: no join of their edges outranks the joins that make them."""
        left, right = self._growth(self.names[a])[1], self._growth(self.names[b])[0]
        i = j = 0
        while True:
            (x, worst_x), (y, worst_y) = left[i], right[j]
            across = self.ranks.get(x + y, np.inf)
            if across < worst_x and across <= worst_y:
                return False
            if worst_x == worst_y == np.inf:
                return True
            if worst_x <= worst_y:
                i += 1
            else:
                j += 1

    def viterbi(self, text: str) -> Iterator[int]:
        """Ids of characters that pieces hold, committed as soon as they are settled."""
        room = 4 * self.longest if len(text) >= 2 * self.longest else len(text) + 1
        # By position of the window, which begins at ``done``: the last piece up to there, and where it began.
        last, begin, done = [-1] + [None] * room, [0] * (room + 1), 0
        pairs, tree, n = self._pairs, self.tree, len(text)
        for start in range(n):
            if start - done >= 2 * self.longest:
                ids, meet = self._settled(last, begin, [i for i in range(start - done, start - done + self.longest) if last[i] is not None])
                yield from ids
                last, begin = last[meet:] + [None] * meet, [i - meet for i in begin[meet:]] + [0] * meet
                last[0], done = last[0] if done + meet else -1, done + meet
            at = start - done
            before, node = last[at], tree
            for end in range(start, n):
                node = node.get(text[end])
                if node is None:
                    break
                piece = node.get("")
                if piece is None or last[end + 1 - done] is not None:
                    continue
                if before >= 0:
                    stay = pairs.get(before << 32 | piece)
                    if stay is None:
                        if len(pairs) >= 4 * REMEMBERED:
                            pairs.clear()
                        stay = pairs[before << 32 | piece] = self._stay(before, piece)
                    if not stay:
                        continue
                last[end + 1 - done], begin[end + 1 - done] = piece, at
        yield from self._settled(last, begin, [n - done])[0]

    @staticmethod
    def _settled(last: list, begin: list, ends: list[int]) -> tuple[list[int], int]:
        """The boundary at which the paths back from all of ``ends`` meet, and the ids from the window's start to there."""
        while len(ends) > 1:
            furthest = max(ends)
            ends = sorted({begin[i] if i == furthest else i for i in ends})
        meet, at, ids = ends[0], ends[0], []
        while at > 0:
            ids.append(last[at])
            at = begin[at]
        return ids[::-1], meet

    def _word(self, word: str) -> bytes:
        if self.plain.fullmatch(word):
            return array("i", self.viterbi(word)).tobytes()
        ids, at = [], 0
        for m in self.plain.finditer(word):
            ids += [*self._single(word[at : m.start()]), *self.viterbi(m[0])]
            at = m.end()
        return array("i", [*ids, *self._single(word[at:])]).tobytes()

    def _single(self, text: str) -> Iterator[int]:
        """Ids of characters that no longer piece holds."""
        for c in text:
            if c in self.ids:
                yield self.ids[c]
            else:
                yield from (self.byte_ids[b] for b in c.encode())

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        words, out = self._words, []
        for word in self.word.findall(" " + text):
            found = words.get(word)
            if found is None:
                found = self._word(word)
                if len(word) <= REMEMBERED_LENGTH:
                    if len(words) >= REMEMBERED:
                        words.clear()
                    words[word] = found
            out.append(found)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that are no UTF-8 become U+FFFD. The space that encoding put first is taken off."""
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class ScoredPieces(Pieces):
    """A unigram vocabulary: the best segmentation has the greatest sum of scores, the negated ``ranks``.

    A character that is no piece costs ``UNKNOWN`` more than the worst piece and is encoded by its bytes. Of equal sums
    the one counts whose last piece begins first.
    """

    UNKNOWN = 10.0

    def __post_init__(self):
        super().__post_init__()
        self.scored: dict = {}
        for p in self.ids:
            node = self.scored
            for c in p:
                node = node.setdefault(c, {})
            node[""] = (self.ids[p], -self.ranks[p])
        self.unknown = -max(self.ranks.values(), default=0.0) - self.UNKNOWN

    def _word(self, word: str) -> bytes:
        return array("i", self.viterbi(word)).tobytes()

    def viterbi(self, text: str) -> Iterator[int]:
        """Ids, committed as soon as the paths back from every position that a later piece could begin at have met."""
        n, longest, done = len(text), max(self.longest, 1), 0
        last, begin, best = [-1], [0], [0.0]
        for start in range(n):
            if start - done >= 2 * longest:
                ids, meet = self._settled(last, begin, [i for i in range(start - done, min(len(last), start - done + longest)) if last[i] is not None])
                yield from self._bytes_of(ids)
                last, begin, best, done = last[meet:], [i - meet for i in begin[meet:]], best[meet:], done + meet
            at, node = start - done, self.scored
            grown = at + longest + 1 - len(last)
            last, begin, best = last + [None] * grown, begin + [0] * grown, best + [-np.inf] * grown
            options, end = [], start
            while end < n and (node := node.get(text[end])) is not None:
                end += 1
                if "" in node:
                    options.append((end, *node[""]))
            if not options or options[0][0] > start + 1:
                options.append((start + 1, -2 - ord(text[start]), self.unknown))
            for end, piece, score in options:
                if best[at] + score > best[end - done]:
                    last[end - done], begin[end - done], best[end - done] = piece, at, best[at] + score
        yield from self._bytes_of(self._settled(last, begin, [n - done])[0])

    def _bytes_of(self, ids: list[int]) -> Iterator[int]:
        for i in ids:
            if i >= 0:
                yield i
            else:
                yield from (self.byte_ids[b] for b in chr(-2 - i).encode())


def encode(df: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_ids, ids, restored) of every row; restored: decoding gives the text again. The vocabulary is broadcast."""
    held = df.sparkSession.sparkContext.broadcast(pieces)
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in slices(batches, 1):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            ids = [own.encode(x) for x in texts]
            restored = [own.decode(i) == x for i, x in zip(ids, texts, strict=True)]
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(i) for i in ids], pa.int64()), lists, pa.array(restored)], ["doc_id", "n_ids", "ids", "restored"])

    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {id_type}, n_ids bigint, ids array<int>, restored boolean")


def decode(df: DataFrame, pieces: Pieces, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows of ids; null ids count as none."""
    held = df.sparkSession.sparkContext.broadcast(pieces)
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [held.value.decode(np.array(x or [], np.int32)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return df.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"doc_id {id_type}, text string")
