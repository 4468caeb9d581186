"""Personal data by a semi-Markov conditional random field.

Candidates are whole segments of up to MAX_TOKENS tokens; features look at a
segment as a whole (its shape, digits, check sum, parts, the characters next
to it). A forward pass over segments normalises the model, a Viterbi pass
with bounded segments jointly chooses boundaries and types. The model is
trained here by stochastic gradient ascent on the likelihood of segmentations
of regions of the corpus, labelled by the base patterns; at most
TRAIN_REGIONS distinct regions, those with the smallest hash.

Base spans (the patterns of the contract, with their checks) always stay. The
model works on the regions around digits and @ signs, where it may add spans
that touch no base span: two numbers that a greedy pattern swallowed as one,
for example. An added span is always a value in the form of its kind's
pattern, with its check.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hex_sha256, prepare, text_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
MAX_TOKENS = 24
TRAIN_REGIONS, EPOCHS, RATE, DECAY, SEED = 1500, 6, 0.3, 1e-5, 5
MARGIN = 1.0  # log-odds a segment needs over staying outside

# fixed patterns of the contract
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match always begins a run of digits
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
EVIDENCE = re.compile(r"[0-9@]")
# words with evidence, next to each other; tried at word starts only and without giving back, so in linear time
REGION = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\s[^\s0-9@]*+[0-9@]\S*+)*+")
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def is_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def is_card(s: str) -> bool:
    d = digits_of(s)
    return 13 <= len(d) <= 19 and luhn(d)


def is_phone(s: str) -> bool:
    return 9 <= len(digits_of(s)) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @ signs so that long words cost linear time."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if EVIDENCE.search(text):
        for kind, pattern, fits in (("ip", IP, is_ip), ("card", CARD, is_card), ("phone", PHONE, is_phone)):
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if fits(m.group())]
    return out


# -- the model ---------------------------------------------------------------


def char_class(c: str) -> str:
    return "9" if "0" <= c <= "9" else "a" if c.isalpha() else "_" if c.isspace() else c


def segment_features(text: str, s: int, e: int) -> list[str]:
    """Features of the whole segment text[s:e]."""
    span = text[s:e]
    left, right = (char_class(text[s - 1]) if s else "^"), (char_class(text[e]) if e < len(text) else "$")
    d = len(digits_of(span))
    shape = re.sub(r"9+", "9", re.sub(r"a+", "a", "".join(map(char_class, span[:64]))))
    out = [f"shape {shape[:20]}", f"left {left}", f"right {right}", f"first {char_class(span[0])}", f"last {char_class(span[-1])}",
           f"digits {min(d, 20)}", f"inside {left in '9a' or right in '9a'}"]
    if "@" in span:
        found = DOMAIN.match(span, span.index("@"))
        whole = bool(found) and found.end() == len(span) and span.index("@") > 0 and all(c in LOCAL for c in span[:span.index("@")])
        out.append(f"address {whole}")
    elif d:
        card, phone, ip = CARD.fullmatch(span), PHONE.fullmatch(span), IP.fullmatch(span)
        out += [f"card {bool(card) and is_card(span)}", f"phone {bool(phone) and is_phone(span)}", f"ip {bool(ip) and is_ip(span)}"]
    return out


MOST_DIGITS = 19
NUMBER_MARKS = frozenset(" -.+()")


class Tokens:
    """Bounds of a region's tokens and which stretches of them could be an entity."""

    def __init__(self, text: str):
        self.text = text
        self.starts, self.ends, self.digits, self.kinds = array("q"), array("q"), array("q"), bytearray()
        self.signs = array("q")  # tokens that are @ signs
        for m in TOKEN.finditer(text):
            token = m.group()
            number = "0" <= token[0] <= "9"
            if token == "@":
                self.signs.append(len(self.starts))
            self.starts.append(m.start())
            self.ends.append(m.end())
            self.digits.append(len(token) if number else 0)
            self.kinds.append(ord("9") if number else ord("@") if token == "@" else ord("-") if token in NUMBER_MARKS else ord("_") if token[0].isspace() else ord("a"))

    def __len__(self) -> int:
        return len(self.starts)

    def candidates(self, i: int) -> Iterator[int]:
        """Ends j of segments [i, j) that could be an address (one @ sign, no white
        space) or a number (4 to MOST_DIGITS digits and marks), with ends that fit."""
        text, at = self.text, self.starts[i]
        if not (text[at].isalnum() or text[at] == "+"):
            return
        following = bisect_left(self.signs, i)
        address = following < len(self.signs) and self.signs[following] < i + MAX_TOKENS
        number, signs, digits = True, 0, 0
        for j in range(i, min(len(self), i + MAX_TOKENS)):
            kind = self.kinds[j]
            signs += kind == 64
            digits += self.digits[j]
            number = number and kind in b"9-"
            address = address and signs <= 1 and kind != 95 and text[self.starts[j]] != " "
            if digits > MOST_DIGITS:
                number = False
            if not (number or address):
                return
            if text[self.ends[j] - 1].isalnum() and ((address and signs) or (number and digits >= 4)):
                yield j + 1


class SemiCRF:
    """Labelled segments of a token sequence; O segments are single tokens."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        self.weights = weights or {}

    def lattice(self, text: str):
        """Tokens and, in the order of their first one, candidate segments (first token, one past last, features, labels allowed)."""
        tokens = Tokens(text)
        return tokens, self.arcs(text, tokens)

    def arcs(self, text: str, tokens: Tokens) -> Iterator[tuple]:
        seen: dict[tuple, tuple] = {}
        for i in range(len(tokens)):
            s = tokens.starts[i]
            token = text[s:min(tokens.ends[i], s + 40)]
            yield i, i + 1, ("token " + char_class(token[0]), f"token digits {min(len(token), 20) if token.isdigit() else 0}"), (0,)
            for j in tokens.candidates(i):
                e = tokens.ends[j - 1]
                around = text[max(0, s - 1):e + 1], s == 0, e == len(text)  # all that the features look at
                features = seen.get(around)
                if features is None:
                    if len(seen) > 50_000:
                        seen.clear()
                    features = seen[around] = tuple(segment_features(text, s, e))
                yield i, j, features, (1, 2, 3, 4)

    def scores(self, features: list[str]) -> np.ndarray:
        total = np.zeros(len(LABELS))
        for f in features:
            w = self.weights.get(f)
            if w is not None:
                total += w
        return total

    def step(self, n: int, arcs, gold: set[tuple[int, int, int]], rate: float) -> None:
        """One ascent step: expected feature counts by forward and backward sums over segments."""
        scored = [self.scores(a[2]) for a in arcs]
        forward, backward = np.full(n + 1, -math.inf), np.full(n + 1, -math.inf)
        forward[0] = backward[n] = 0.0
        for (i, j, _, allowed), sc in zip(arcs, scored):  # arcs are in the order of their first token
            forward[j] = np.logaddexp(forward[j], forward[i] + np.logaddexp.reduce(sc[list(allowed)]))
        for (i, j, _, allowed), sc in zip(reversed(arcs), reversed(scored)):
            backward[i] = np.logaddexp(backward[i], backward[j] + np.logaddexp.reduce(sc[list(allowed)]))
        total = forward[n]
        for (i, j, features, allowed), sc in zip(arcs, scored):
            change = np.zeros(len(LABELS))
            for y in allowed:
                change[y] = ((i, j, y) in gold) - math.exp(min(0.0, forward[i] + sc[y] + backward[j] - total))
            if np.abs(change).max() > 1e-4:
                for f in features:
                    w = self.weights.setdefault(f, np.zeros(len(LABELS)))
                    w += rate * (change - DECAY * w)

    def fit(self, regions: list[str]) -> "SemiCRF":
        rng = np.random.default_rng(SEED)
        prepared = []
        for text in regions:
            if any(len(digits_of(m.group())) > most for p, most in ((CARD, 19), (PHONE, 15)) for m in p.finditer(text)):
                continue  # a pattern swallowed several numbers here: its silence is no label
            bounds, arcs = self.lattice(text)
            arcs = list(arcs)
            starts, ends = {s: i for i, s in enumerate(bounds.starts)}, {e: i + 1 for i, e in enumerate(bounds.ends)}
            gold, inside = set(), set()
            for kind, s, e in sorted(base_spans(text), key=lambda x: x[1] - x[2]):  # of overlapping ones the longest
                i, j = starts.get(s), ends.get(e)
                if i is not None and j is not None and j - i <= MAX_TOKENS and inside.isdisjoint(range(i, j)):
                    gold.add((i, j, LABELS.index(kind)))
                    inside.update(range(i, j))
            gold.update((i, i + 1, 0) for i in range(len(bounds)) if i not in inside)
            prepared.append((len(bounds), arcs, gold))
        for epoch in range(EPOCHS):
            for k in rng.permutation(len(prepared)):
                self.step(*prepared[k], RATE / (1 + epoch))
        return self

    def segments(self, text: str) -> list[tuple[str, int, int]]:
        """The best segmentation's entities; each must beat the outside labelling by MARGIN.

        Arcs come in the order of their first token and reach MAX_TOKENS far,
        so the pass keeps one number and one pointer per token and no arcs.
        """
        tokens, arcs = self.lattice(text)
        n = len(tokens)
        best, back = array("d", [0.0]) + array("d", [-math.inf]) * n, array("q", [0]) * (n + 1)
        known: dict[tuple, np.ndarray] = {}  # scores by features: single tokens have few, and tables repeat
        for i, j, features, allowed in arcs:
            sc = known.get(features)
            if sc is None:
                if len(known) > 50_000:
                    known.clear()
                sc = known[features] = self.scores(features)
            y = max(allowed, key=lambda a: sc[a])
            value = best[i] + sc[y] - (MARGIN if y else 0.0)
            if value > best[j]:
                best[j], back[j] = value, i * len(LABELS) + y
        out, j = [], n
        while j:
            i, y = divmod(back[j], len(LABELS))
            if y:
                out.append((LABELS[y], tokens.starts[i], tokens.ends[j - 1]))
            j = i
        return out[::-1]


def checked(kind: str, span: str) -> bool:
    """An added span must be a value of its kind."""
    if kind == "email":
        return any(s == 0 and e == len(span) for s, e in emails(span))
    pattern, fits = {"ip": (IP, is_ip), "card": (CARD, is_card), "phone": (PHONE, is_phone)}[kind]
    return bool(pattern.fullmatch(span)) and fits(span)


def all_spans(text: str, base: list[tuple[str, int, int]], model: SemiCRF) -> list[tuple[str, int, int]]:
    """Base spans and the model's additions, by kind, then start."""
    if not EVIDENCE.search(text):
        return base
    taken = sorted((s, e) for _, s, e in base)
    added = []
    for region in REGION.finditer(text):
        s, e = region.span()
        if sum("0" <= c <= "9" for c in region.group()) < 4 and "@" not in region.group():
            continue
        for kind, a, b in model.segments(region.group()):
            if not any(x < s + b and s + a < y for x, y in taken) and checked(kind, text[s + a:s + b]):
                added.append((kind, s + a, s + b))
    return sorted(base + added, key=lambda x: (KINDS.index(x[0]), x[1], x[2])) if added else base


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


# -- DataFrames --------------------------------------------------------------


def fit(docs: DataFrame) -> SemiCRF:
    """A model from regions of the corpus (bounded, see TRAIN_REGIONS)."""
    prepare(docs.sparkSession)
    schema = pa.schema([("region", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {m.group() for t in batch.column(0).to_pylist() if EVIDENCE.search(t) for m in REGION.finditer(t) if len(m.group()) <= 200}
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string())], schema=schema)

    regions = docs.select(text_of(docs).alias("text")).mapInArrow(task, "region string")
    key = F.xxhash64("region")
    chosen = regions.groupBy("region").agg(F.first(key).alias("key")).orderBy("key", "region").limit(TRAIN_REGIONS)
    return SemiCRF().fit([r["region"] for r in chosen.collect()])


def find(docs: DataFrame, model: SemiCRF | None = None) -> DataFrame:
    """doc_id, counts per kind, base_sha256 and spans of every row of ``docs``.

    Null text is empty and has no spans; null and repeated doc_ids pass
    through; other columns are not read; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    weights = (model or fit(docs)).weights
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = SemiCRF(weights)
        for batch in batches:
            counts, digests, out = {k: [] for k in KINDS}, [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                spans = all_spans(text, base, crf)
                for k in KINDS:
                    counts[k].append(sum(x[0] == k for x in base))
                digests.append(hex_sha256(joined(base).encode()))
                out.append(joined(spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(digests, pa.string()), pa.array(out, pa.string())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(task, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span (overlapping ones together) replaced by its kind in brackets."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: SemiCRF | None = None) -> DataFrame:
    """The rows of ``docs`` with personal data in ``text`` replaced; n_chars, where there is one, follows. Null text stays null."""
    prepare(docs.sparkSession)
    weights = (model or fit(docs)).weights
    names = docs.columns
    at, count = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = SemiCRF(weights)
        for batch in batches:
            texts = [None if t is None else redacted(t, all_spans(t, base_spans(t), crf)) for t in batch.column(at).to_pylist()]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            if count is not None:
                old = batch.column(count).to_pylist()
                sizes = [o if t is None else len(t) for t, o in zip(texts, old)]
                batch = batch.set_column(count, batch.schema.field(count), pa.array(sizes, batch.schema.field(count).type))
            yield batch

    return docs.mapInArrow(task, docs.schema)
