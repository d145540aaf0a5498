"""Secret scan: a worklist unwraps URL, Unicode, base64 and compressed layers, and every layer is scanned again.

A layer is a string with, for each of its characters, the span of the original text it came from. Scanning a text
starts with the text itself; each decoder that changes a layer gives a new one, taken at once (depth first, so one
chain of layers is held at a time); a layer whose content and places were seen before is not taken again, so the list
reaches a fixpoint also where decoding runs in a circle. A match in any layer is reported as the span of the original
text that its characters came from.

Decoded bytes become characters of the same number: all patterns are ASCII, so bytes of any encoding, control
characters and binary content are scanned in place; characters that alternate with NUL (UTF-16) are drawn together.
Base64 runs may go on over line ends and are read from each of their first four characters, so what stands before them
in the same run does no harm; a run that decodes to plain text is also put back into its surroundings.

A compressed layer stands at one place, so all that counts is which kinds of secrets it holds. It is read as a stream
in pieces, never as a whole: pieces end at a character that no match and no encoded run can hold; compressed layers
within are streams of their own that go on from piece to piece. Only where ``LONGEST`` characters hold no such place
are pieces cut anyway, with ``OVERLAP`` characters in common: secrets of up to that length are found there too, but of
a compressed layer in a base64 run of that length, itself inside a compressed layer, only the first ``LONGEST``
characters are unpacked. Streams nested over ``DEEPEST`` deep, or for the third time with one beginning, are not followed.
Zstandard windows over 128 MiB (no level but the long mode asks for more) and xz dictionaries that need over 256 MiB (its
highest preset needs 65) are refused, as a task's memory is bounded. Deflate streams are found at every window and level:
wherever their two header bytes and the head of the first block are valid, a stream is tried, a little of it first, so
the work grows with the length of the layer.

Defined results: a null text counts as empty and has no spans. Spans are in code points, end exclusive, without
repeats, by start, then kind as in ``KINDS``, then end.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.shared import slices

KINDS = ("assign", "access", "hex")
PIECE, LONGEST, OVERLAP, DEEPEST = 1 << 20, 1 << 22, 1 << 16, 64

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # same as runs of [0-9a-f]+ that are long enough
_KEYS = (b"password", b"passwd", b"secret", b"token", b"api")

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
_WIDE = re.compile(r"(?:[\t\n\r\x20-\x7e]\x00){6,}|(?:\x00[\t\n\r\x20-\x7e]){6,}")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]{4,})*")
_BREAK = re.compile(r"[\r\n\x20\t]+")
# First characters of gzip, bzip2, xz and Zstandard files.
_MAGIC = re.compile(r"(\x1f\x8b\x08)|(BZh[1-9]1AY&SY)|(\xfd7zXZ\x00)|(\x28\xb5\x2f\xfd)")
_MAGIC_BYTES = re.compile(_MAGIC.pattern.encode("latin-1"), re.DOTALL)
_STARTS, ZLIB, TRIAL = (b"\x1f\x8b", b"BZh", b"\xfd7zXZ", b"\x28\xb5"), 5, 1 << 10
#: Signs of an encoded layer in a text.
_SIGNS, _RUN = ("%", "\\", "\x00", "&#"), re.compile(r"[A-Za-z0-9+/_-]{16}")
#: One of these stands in every layer that holds a match or can be decoded further.
_HINT = re.compile(r"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{24}|%[0-9A-Fa-f]{2}|\\[uUx]|&#|\x00|[A-Za-z0-9+/_-]{16}|" + _MAGIC.pattern)
#: Characters that no match and no encoded run holds.
_APART = re.compile(rb"""[^A-Za-z0-9+/_.=\-"':\x20%\\&#;{}\x00\t\r\n]""")

Spans = list[tuple[str, int, int]]


def base_spans(text: str) -> Spans:
    """Leftmost non-overlapping matches of each kind, without those too short."""
    found: Spans = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(key in low for key in _KEYS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return ordered(found)


def ordered(spans: Spans) -> Spans:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: Spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _one_byte(text: str) -> bytes:
    """A byte for each character, "?" for those that are no byte."""
    return text.encode("latin-1", "replace")


def stream_starts(raw: bytes) -> list[tuple[int, int]]:
    """(place, kind) of all that looks like the beginning of a compressed stream."""
    starts = [(m.start(), m.lastindex) for m in _MAGIC_BYTES.finditer(raw)] if any(start in raw for start in _STARTS) else []
    b = np.frombuffer(raw, np.uint8)
    # Method 8, no preset dictionary, a valid check.
    at = np.flatnonzero(((b[:-1] & 0x8F) == 8) & ((b[1:] & 0x20) == 0)) if len(b) > 2 else np.zeros(0, np.int64)
    at = at[(b[at].astype(np.uint16) * 256 + b[at + 1]) % 31 == 0]
    at = at[at + 2 < len(b)]
    # The head of the first block: stored with its length and complement, or with fixed or with dynamic codes in range.
    head, wide = b[at + 2], np.r_[b, np.zeros(8, np.uint8)].astype(np.int64) if len(at) else b
    kind = head >> 1 & 3
    stored = kind == 0
    stored[stored] = (wide[at[stored] + 3] ^ wide[at[stored] + 5]) & (wide[at[stored] + 4] ^ wide[at[stored] + 6]) == 255
    dynamic = (kind == 2) & (head >> 3 <= 29) & ((wide[at + 3] & 31) <= 29)
    at = at[stored | (kind == 1) | dynamic]
    return sorted([*starts, *((i, ZLIB) for i in at.tolist())])


class Layer:
    """A decoded string and the span of the original text behind each of its characters; without places, its own."""

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text, self.start, self.end = text, start, end

    def places(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The spans behind the stretches from each character of ``first`` to that of ``last``."""
        if self.start is None:
            return first.astype(np.int32), last.astype(np.int32) + 1
        return self.start[first], self.end[last]

    def span(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.start is None else (int(self.start[a:b].min()), int(self.end[a:b].max()))

    def key(self) -> bytes:
        made = hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16)
        for places in () if self.start is None else (self.start, self.end):
            made.update(np.ascontiguousarray(places))
        return made.digest()

    def spans(self) -> Spans:
        return [(kind, *self.span(a, b)) for kind, a, b in base_spans(self.text)]

    def decoded(self) -> Iterator[Layer]:
        if "%" in self.text:
            yield from self._rewritten(_URL, _percent)
        if "\\" in self.text or "&#" in self.text:
            yield from self._rewritten(_UNICODE, _escapes)
        if "\x00" in self.text:
            yield from self._rewritten(_WIDE, _narrow)
        yield from self._rewritten(_BASE64, _plain)
        for m in _BASE64.finditer(self.text):
            at = np.arange(m.start(), m.end())
            run = m[0]
            if "\n" in run:
                kept = np.ones(len(run), bool)
                for gap in _BREAK.finditer(run):
                    kept[gap.start() : gap.end()] = False
                at, run = at[kept], _BREAK.sub("", run)
            for skip in range(min(4, len(run) - 3)):
                raw = _from_base64(run[skip:])
                text = raw.decode("latin-1")
                if _HINT.search(text) or stream_starts(raw):
                    byte = np.arange(len(raw))
                    yield Layer(text, *self.places(at[skip + byte * 4 // 3], at[np.minimum(skip + ((byte + 1) * 4 + 2) // 3 - 1, len(at) - 1)]))

    def _rewritten(self, pattern: re.Pattern, decode: Callable[[str], tuple[str, np.ndarray, np.ndarray] | None]) -> Iterator[Layer]:
        """The whole layer with each encoded run replaced by what it stands for, if there is one."""
        parts, first, last, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            got = decode(m[0])
            if got is None:
                continue
            new, a, b = got
            parts += [self.text[at : m.start()], new]
            before = np.arange(at, m.start())
            first += [before, m.start() + a]
            last += [before, m.start() + b]
            at = m.end()
        if parts:
            rest = np.arange(at, len(self.text))
            yield Layer("".join([*parts, self.text[at:]]), *self.places(np.concatenate([*first, rest]), np.concatenate([*last, rest])))

    def packed(self) -> Spans:
        """The secrets inside compressed layers, each at the place of all of its layer."""
        found: Spans = []
        raw = _one_byte(self.text)
        starts = stream_starts(raw)
        if not starts:
            return found
        wide = np.array([m.start() for m in re.finditer("[^\x00-\xff]", self.text)] + [len(raw)])
        view, upto = memoryview(raw), 0
        for at, kind in starts:
            if at < upto:
                continue  # inside a stream that was read to its end: what is stored there came out of it
            stream = Stream(kind, set(), ())
            stream.feed_all(view[at : wide[np.searchsorted(wide, at)]])
            stream.close()
            upto = at + stream.read if stream.whole else upto
            if stream.kinds:
                start, end = self.span(at, at + max(stream.read, 1))
                found += [(k, start, end) for k in stream.kinds]
        return found


def _percent(run: str):
    raw = bytes.fromhex(run.replace("%", ""))
    at = 3 * np.arange(len(raw))
    return raw.decode("latin-1"), at, at + 2


def _escapes(run: str):
    """Each escape's character, surrogates in pairs; U+FFFD for what is no character."""
    if run.startswith("&#"):
        codes, size = [int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1])], len(run)
    elif run.startswith("\\u{"):
        codes, size = [int(run[3:-1], 16)], len(run)
    else:
        size = {"u": 6, "U": 10, "x": 4}[run[1]]
        codes = [int(run[i + 2 : i + size], 16) for i in range(0, len(run), size)]
    out, first, last, i = [], [], [], 0
    while i < len(codes):
        code, n = codes[i], 1
        if 0xD800 <= code < 0xDC00 and i + 1 < len(codes) and 0xDC00 <= codes[i + 1] < 0xE000:
            code, n = 0x10000 + ((code - 0xD800) << 10) + (codes[i + 1] - 0xDC00), 2
        out.append("\ufffd" if code > 0x10FFFF or 0xD800 <= code < 0xE000 else chr(code))
        first.append(i * size)
        last.append((i + n) * size - 1)
        i += n
    return "".join(out), np.array(first), np.array(last)


def _narrow(run: str):
    at = 2 * np.arange(len(run) // 2)
    return run.replace("\x00", ""), at, at + 1


def _plain(run: str):
    """A base64 run that stands for printable text; nothing for others."""
    if "\n" in run:
        return None
    raw = _from_base64(run)
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    if len(run) % 4 == 1 or not (text.isprintable() or all(c.isprintable() or c in "\t\n\r" for c in text)):
        return None
    byte = np.arange(len(raw))
    return raw.decode("latin-1"), byte * 4 // 3, np.minimum(((byte + 1) * 4 + 2) // 3 - 1, len(run) - 1)


def _from_base64(run: str) -> bytes:
    """The bytes of all the run's whole groups, either alphabet."""
    run = run.replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        run = run[:-1]
    return binascii.a2b_base64(run + "=" * (-len(run) % 4))


class Content:
    """Decompressed bytes as they come: ``kinds`` gathers the kinds of secrets found in them and in what they hold."""

    def __init__(self, kinds: set[str], outer: tuple[bytes, ...]):
        self.kinds, self.outer, self.held, self.seen, self.open = kinds, outer, b"", set(), []

    def feed(self, data: bytes) -> bool:
        """Whether more can matter."""
        if len(self.kinds) == len(KINDS):
            return False
        self.open = [s for s in self.open if s.feed(data)]
        self.held += data
        while len(self.held) >= PIECE:
            cut = next((m.end() for m in _APART.finditer(self.held, PIECE // 2)), 0)
            if not cut:
                if len(self.held) < LONGEST:
                    break
                piece, self.held = self.held[:LONGEST], self.held[LONGEST - OVERLAP :]
            else:
                piece, self.held = self.held[:cut], self.held[cut:]
            self._piece(piece)
        return True

    def close(self) -> None:
        self._piece(self.held)
        self.held = b""
        for stream in self.open:
            stream.close()

    def _piece(self, piece: bytes) -> None:
        key = hashlib.blake2b(piece, digest_size=16).digest()
        if key not in self.seen:
            self.seen.add(key)
            self.kinds.update(kind for kind, _, _ in walk(piece.decode("latin-1"), packed=False)[0])
        # What is held comes after a piece that ended apart, and overlaps with one that did not.
        rest = memoryview(self.held if piece[-OVERLAP:] != self.held[:OVERLAP] else self.held[OVERLAP:])
        view, upto = memoryview(piece), 0
        for at, kind in stream_starts(piece):
            if at < upto:
                continue
            stream = Stream(kind, self.kinds, self.outer)
            if stream.feed_all(view[at:]) and (not len(rest) or stream.feed(rest)):
                self.open.append(stream)
            else:
                stream.close()
                upto = at + stream.read if stream.whole else upto


class Stream:
    """One compressed stream: bytes go in, ``Content`` comes out. ``read``: how many bytes belong to it; ``whole``: its end was met."""

    def __init__(self, kind: int, kinds: set[str], outer: tuple[bytes, ...]):
        made = {1: lambda: zlib.decompressobj(31), 2: bz2.BZ2Decompressor, 3: lambda: lzma.LZMADecompressor(memlimit=1 << 28), 5: zlib.decompressobj}
        self.kind, self.kinds, self.outer, self.read, self.done, self.whole, self.content = kind, kinds, outer, 0, False, False, None
        self.decompressor = zstandard.ZstdDecompressor(max_window_size=1 << 27).decompressobj() if kind == 4 else made[kind]()

    def feed_all(self, data: memoryview) -> bool:
        """``feed`` in pieces. Deflated data that breaks in its first ``TRIAL`` bytes only looked like a stream."""
        self.head = data[:OVERLAP]
        if self.kind == ZLIB:
            try:
                zlib.decompressobj().decompress(data[:TRIAL], PIECE)
            except zlib.error:
                self.done = True
        return not self.done and all(self.feed(data[i : i + PIECE]) for i in range(0, len(data), PIECE))

    def feed(self, data: memoryview | bytes) -> bool:
        """Whether the stream goes on."""
        self.read += len(data)
        while not self.done:
            try:
                out, data = self._next(data)
            except (OSError, EOFError, ValueError, zlib.error, lzma.LZMAError, zstandard.ZstdError):
                self.done = True
                break
            if out and self.content is None:
                key = hashlib.blake2b(self.head, digest_size=16).digest()
                if self.outer.count(key) >= 2 or len(self.outer) >= DEEPEST:
                    self.done = True
                    break
                self.content = Content(self.kinds, (*self.outer, key))
            self.done = bool(out) and not self.content.feed(out) or self._ended()
            if not out and not len(data) or self.done:
                break
        return not self.done

    def _next(self, data: memoryview | bytes) -> tuple[bytes, memoryview | bytes]:
        """At most a piece of what comes out, and what is still to go in."""
        d = self.decompressor
        if self.kind in (1, 5):
            return d.decompress(data, PIECE), d.unconsumed_tail
        if self.kind == 4:
            # A block of this format holds 128 KiB, so a slice of input gives a bounded output only if it is short.
            return d.decompress(data[:512]), data[512:]
        out = d.decompress(data, PIECE)
        return out, b""

    def _ended(self) -> bool:
        d = self.decompressor
        if d.eof:
            self.read -= len(d.unused_data)
            self.whole = True
        return d.eof

    def close(self) -> None:
        if self.content is not None:
            self.content.close()
            self.content = None
            self.done = True


def walk(text: str, packed: bool = True) -> tuple[set[tuple[str, int, int]], int]:
    """(spans of all layers, number of layers); ``packed``: compressed streams that begin in the text itself are read, too."""
    root = Layer(text)
    found, seen, work = set(root.spans()), {root.key()}, [root.decoded()]
    if packed:
        found.update(root.packed())
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
        elif (key := layer.key()) not in seen:
            seen.add(key)
            found.update(layer.spans())
            found.update(layer.packed())
            work.append(layer.decoded())
    return found, len(seen)


def all_spans(text: str) -> tuple[Spans, Spans, int]:
    """(spans of the text itself, spans of all layers, number of layers)."""
    base = base_spans(text)
    if not (any(sign in text for sign in _SIGNS) or _RUN.search(text) or stream_starts(_one_byte(text))):
        return base, base, 1
    found, layers = walk(text)
    return base, ordered(list(found)), layers



def redacted(text: str, spans: Spans, mark: str = "<secret>") -> str:
    """The text with each span, overlapping ones together, replaced by ``mark``."""
    parts, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base_spans, spans, layers): arrays of (kind, start, end) of every row, in one pass without a shuffle."""
    id_type = df.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    row = lambda spans: [dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = [all_spans(x or "") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([row(f[0]) for f in found], pa.list_(span)), pa.array([row(f[1]) for f in found], pa.list_(span)), pa.array([f[2] for f in found], pa.int32())],
                ["doc_id", "base_spans", "spans", "layers"],
            )

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {id_type}, base_spans {spans}, spans {spans}, layers int")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans as text."""
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"), "layers")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with every span of every layer replaced in the text; a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            at = batch.schema.get_field_index(text_col)
            texts = [x and (redacted(x, s) if (s := all_spans(x)[1]) else x) for x in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
