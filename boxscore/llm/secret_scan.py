"""Secret scans by a recursive decoding worklist.

A text is the first layer. A layer is scanned for secrets and then unwrapped:
percent escapes (and the numeric references and backslash escapes of Unicode
characters, full-width and zero-width forms) are replaced by what they stand
for, runs of base64 by the text they hold, also when that text was compressed
(gzip, zlib, zstandard, bzip2, xz). Each result is a new layer that joins the
worklist; a layer whose content was seen before ends there, so cycles end and
the worklist stops at the fixpoint. Every layer keeps the pieces it was made
of, and a match is mapped through them back to code points of the text: the
part that decodes to it.

All kinds of a layer are unwrapped each on its own and in every order, so a
secret is found whatever encoding is outermost. All layers of a document may
take ``GROWTH`` times its length plus ``ROOM`` characters (a guard against
decompression bombs and texts built to decode by a character a layer; escaped
percent signs of any depth unwrap at once). Layers left closed by that are
counted in ``n_closed``.

Null text counts as empty; null and repeated doc_ids pass through as rows of
their own; other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hex_sha256, in_batches, prepare, text_of

GROWTH, ROOM = 20, 16 << 20
KINDS = ("assign", "access", "hex")

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{32}")

ESCAPES = re.compile(r"""(?:%(?:25)*[0-9A-Fa-f]{2})+
    |(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+
    |&\#[0-9]{1,7};|&\#[xX][0-9A-Fa-f]{1,6};|[​-‍⁠﻿­]+|[！-～]""", re.VERBOSE)
DEEP = r"%(?:25)*([0-9A-Fa-f]{2})"  # the percent sign escaped again and again
URL_DEEP = re.compile(f"(?:{DEEP})+")
PERCENT, BACKSLASH_X = re.compile(DEEP), re.compile(r"\\x([0-9A-Fa-f]{2})")
MAYBE_ESCAPED = re.compile("[%\\\\&​-‍⁠﻿­！-～]")
RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
LINE = 60  # a run of at least so many characters goes on after a line break
OPENERS = ((b"\x1f\x8b", lambda: zlib.decompressobj(31)), (b"x\x01", zlib.decompressobj), (b"x\x5e", zlib.decompressobj),
           (b"x\x9c", zlib.decompressobj), (b"x\xda", zlib.decompressobj), (b"BZh", bz2.BZ2Decompressor), (b"\xfd7zXZ", lzma.LZMADecompressor))


def scan(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the secrets of a layer: leftmost, not overlapping per kind, failing matches dropped."""
    found = [(0, *m.span()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    found += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    at = 0
    while (m := LONG_HEX.search(text, at)) is not None:
        # the first 32 of a run from its start: nothing of the run lies before
        at = HEX.match(text, m.start()).end()
        found.append((2, m.start(), at))
    return found


class Layer:
    """A text and the pieces of its parent it was made of.

    Piece k covers [starts[k], starts[k + 1]) and comes from the parent's
    [lows[k], highs[k]); a piece of equal length is mapped character by
    character, any other as a whole unless ``inner`` maps its offsets.
    """

    def __init__(self, text: str, parent: Layer | None = None, starts=(), lows=(), highs=(), inner=None):
        self.text, self.parent, self.starts, self.lows, self.highs, self.inner = text, parent, starts, lows, highs, inner or {}

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The span of the original text that decodes to [start, end) of this layer."""
        layer = self
        while layer.parent is not None:
            start, end = layer._up(start, False), layer._up(end - 1, True)
            layer = layer.parent
        return start, end

    def _up(self, at: int, last: bool) -> int:
        k = bisect_right(self.starts, at) - 1
        first, low, high = self.starts[k], self.lows[k], self.highs[k]
        size = (self.starts[k + 1] if k + 1 < len(self.starts) else len(self.text)) - first
        inner = self.inner.get(k)
        if inner is not None:
            begin, finish = inner(at - first)
            return low + (finish if last else begin)
        if size == high - low:
            return low + at - first + last
        return high if last else low


def rebuilt(parent: Layer, parts: list[tuple]) -> Layer:
    """A layer whose (low, high, text, inner) parts replace those spans of the parent."""
    out, starts, lows, highs, inner, at, length = [], [], [], [], {}, 0, 0

    def put(text, low, high, mapping=None):
        nonlocal length
        if text:
            if mapping is not None:
                inner[len(starts)] = mapping
            starts.append(length)
            lows.append(low)
            highs.append(high)
            out.append(text)
            length += len(text)

    for low, high, text, mapping in parts:
        put(parent.text[at:low], at, low)
        put(text, low, high, mapping)
        at = high
    put(parent.text[at:], at, len(parent.text))
    return Layer("".join(out), parent, starts, lows, highs, inner)


def decoded(data: bytes) -> str | None:
    """UTF-8 text without control characters other than white space."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and not CONTROL.search(text) else None


CONTROL = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x9f]")


def escaped_bytes(run: str, pattern: re.Pattern) -> list[tuple]:
    """(start, end, text, map of offsets) for a run of escaped bytes: one part,
    or one for each plain ASCII byte if they are no UTF-8 text together."""
    found = [(*m.span(), int(m.group(1), 16)) for m in pattern.finditer(run)]
    text = decoded(bytes(b for _, _, b in found))
    if text is None:
        return [(low, high, chr(b), None) for low, high, b in found if 32 <= b < 127]
    ends, at = [0], 0
    for c in text:
        at += len(c.encode())
        ends.append(found[at - 1][1])
    return [(0, len(run), text, lambda i: (ends[i], ends[i + 1]))]


def unescape(run: str) -> list[tuple]:
    """(start, end, text, map of offsets) for the parts of a run of escapes."""
    if run[0] == "%":
        return escaped_bytes(run, PERCENT)
    if run.startswith("\\x"):
        return escaped_bytes(run, BACKSLASH_X)
    if run.startswith("\\u") and run[2] != "{":
        units = bytes.fromhex(run.replace("\\u", "")).decode("utf-16-be", "surrogatepass")
        if any(0xD800 <= ord(c) < 0xE000 for c in units):
            return []
        ends = [0]
        for c in units:
            ends.append(ends[-1] + (12 if ord(c) > 0xFFFF else 6))
        return [(0, len(run), units, lambda i: (ends[i], ends[i + 1]))]
    if run[0] in "\\&":
        digits = re.sub(r"[\\u{}U&#;]", "", run)
        code = int(digits[1:], 16) if digits[0] in "xX" else int(digits, 10 if run[0] == "&" else 16)
        plain = 0x20 <= code < 0x110000 and not 0xD800 <= code < 0xE000 or code in (9, 10, 13)
        return [(0, len(run), chr(code), None)] if plain else []
    if "！" <= run <= "～":
        return [(0, 1, chr(ord(run) - 0xFEE0), None)]
    return [(0, len(run), "", None)]  # zero-width characters


def escapes_gone(layer: Layer, pattern: re.Pattern) -> Layer | None:
    parts = [(m.start() + low, m.start() + high, text, inner)
             for m in pattern.finditer(layer.text) for low, high, text, inner in unescape(m.group())]
    return rebuilt(layer, parts) if parts else None


def url_layer(layer: Layer, room: Room) -> Layer | None:
    return escapes_gone(layer, URL_DEEP) if "%" in layer.text else None


def unicode_layer(layer: Layer, room: Room) -> Layer | None:
    return escapes_gone(layer, ESCAPES) if MAYBE_ESCAPED.search(layer.text) else None


class Room:
    """Characters that the layers of a document may still take."""

    def __init__(self, length: int):
        self.left, self.closed = GROWTH * length + ROOM, 0


def opened(data: bytes, room: Room) -> bytes | None:
    """Decompressed bytes, None if they are not compressed, are broken or would not fit."""
    if data.startswith(b"\x28\xb5\x2f\xfd"):
        import zstandard

        reader = zstandard.ZstdDecompressor().stream_reader(data)
        read, done = (lambda n: reader.read(n)), None
    else:
        make = next((make for magic, make in OPENERS if data.startswith(magic)), None)
        if make is None:
            return None
        machine = make()
        given = [data]

        def read(n):
            if machine.eof:
                return b""
            chunk = machine.decompress(given[0], n)
            given[0] = getattr(machine, "unconsumed_tail", b"")
            return chunk

        done = lambda: machine.eof
    out, size = [], 0
    try:
        while chunk := read(1 << 20):
            out.append(chunk)
            size += len(chunk)
            if size > room.left:
                room.closed += 1
                return None
    except Exception:  # zlib.error, OSError, LZMAError, ZstdError, EOFError: not such data after all
        return None
    if done is not None and not done():
        return None
    room.left -= size
    return b"".join(out)


def base64_runs(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, characters) of runs that may be base64; a long line's run goes on in the next line."""
    held = None  # start, end, characters, complete
    for m in RUN.finditer(text):
        gap = text[held[1]:m.start()] if held and m.start() - held[1] <= 2 else None
        if gap in ("\n", "\r\n") and held[3]:
            held = (held[0], m.end(), held[2] + [m.group()], m.end() - m.start() >= LINE and m.group()[-1] != "=")
            continue
        if held:
            yield held[0], held[1], held[2]
        held = (m.start(), m.end(), [m.group()], m.end() - m.start() >= LINE and m.group()[-1] != "=")
    if held:
        yield held[0], held[1], held[2]


def base64_part(start: int, end: int, lines: list[str], room: Room) -> tuple | None:
    run = "".join(lines).rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    data = base64.b64decode(run + "=" * (-len(run) % 4))
    text = decoded(data)
    if text is not None:
        if len(lines) > 1:
            return start, end, text, None
        ends, at = [0], 0
        for c in text:
            at += len(c.encode())
            ends.append(at)
        size = end - start
        return start, end, text, lambda i: (ends[i] * 4 // 3, min(size, -(-ends[i + 1] * 4 // 3)))
    inner = opened(data, room)
    text = decoded(inner) if inner else None
    return None if text is None else (start, end, text, lambda i: (0, end - start))


def base64_layer(layer: Layer, room: Room) -> Layer | None:
    parts = [p for start, end, lines in base64_runs(layer.text) if (p := base64_part(start, end, lines, room))]
    return rebuilt(layer, parts) if parts else None


DECODERS = (url_layer, unicode_layer, base64_layer)


def secrets(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, int]:
    """Spans of the text itself, all spans, number of layers, layers left closed.

    Spans are (start, kind, end) in code points. A span of a deeper layer is
    added unless a span of its kind already covers just that part.
    """
    base = sorted((start, kind, end) for kind, start, end in scan(text))
    spans, seen, room = set(base), {sha256(text.encode()).digest()}, Room(len(text))
    work, layers = deque([Layer(text)]), 1
    while work:
        layer = work.popleft()
        for decoder in DECODERS:
            inner = decoder(layer, room)
            if inner is None:
                continue
            mark = sha256(inner.text.encode()).digest()
            if mark in seen:
                continue
            seen.add(mark)
            if len(inner.text) > room.left:
                room.closed += 1
                continue
            room.left -= len(inner.text)
            layers += 1
            for kind, start, end in scan(inner.text):
                low, high = inner.source(start, end)
                spans.add((low, kind, high))
            work.append(inner)
    return base, sorted(spans), layers, room.closed


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


RESULT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                    ("base_sha256", pa.string()), ("spans", pa.string()), ("n_layers", pa.int64()), ("n_closed", pa.int64())])
RESULT_DDL = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, n_closed long"


def find(docs: DataFrame) -> DataFrame:
    """Per document the numbers of its own spans by kind, their digest, and all
    spans (``kind:start:end`` by start and kind), decoded layers included."""
    prepare(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    base, spans, layers, closed = secrets(text.as_py())
                    kinds = [kind for _, kind, _ in base]
                    yield (doc, kinds.count(0), kinds.count(1), kinds.count(2), hex_sha256(shown(base).encode()), shown(spans), layers, closed)

        yield from in_batches(rows(), RESULT, size_of=lambda r: len(r[5]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(task, RESULT_DDL)


def redact(docs: DataFrame) -> DataFrame:
    """The rows with every found span of ``text`` replaced by its kind; overlapping spans become one."""
    prepare(docs.sparkSession)
    text_at = docs.columns.index("text")

    def cleaned(text: str) -> str:
        out, at = [], 0
        for start, kind, end in secrets(text)[1]:
            if start >= at:
                out += [text[at:start], f"<{KINDS[kind]}>"]
            at = max(at, end)
        return "".join(out) + text[at:]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else cleaned(t) for t in batch.column(text_at).to_pylist()]
            yield batch.set_column(text_at, batch.schema.field(text_at), pa.array(texts, batch.schema.field(text_at).type))

    return docs.mapInArrow(task, docs.schema)
