"""Substring deduplication over a compacted de Bruijn graph of words.

A window is ``WINDOW`` consecutive words. Its node is its minimal k-mer (by a
mixed hash, leftmost on ties), so equal windows have equal nodes. The windows
of a document that follow one another through the same occurrence of a node
form an edge: a path of the word graph without a branch inside the document,
stored as one row (node, content hash of all its words, source coordinates)
instead of one row per window.

1. Each task compacts its own edges: of equal edges only those of the
   smallest document travel on, the others are repeated spans already.
2. Nodes that only one document visits drop out in an aggregate that is
   combined before its shuffle; the remaining edges join their node's counts.
3. An edge whose content also starts in a smaller document is a repeated span
   as a whole. A node with one content left does not branch and is done.
4. Nodes that branch are opened: their remaining edges go back to their
   source coordinates in the documents, where every single window is hashed
   from the words and compared across documents.
5. All spans of a document meet its text, which is where words are removed.

Contents are compared by two independent 64-bit hashes (128 bits together).
Groups of copies never meet in one task: every grouping is an aggregate with
map-side combine or a join whose large keys Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hex_sha256, prepare, stored, text_of

WINDOW = 50
KMER = 12
FLUSH = 1_500_000  # edges a task holds before it compacts them
NO_ID = (1 << 63) - 1  # a null doc_id sorts behind every id

EDGES = "kind int, node long, content long, doc long, tag long, s int, e int"
EDGES_ARROW = pa.schema([("kind", pa.int32()), ("node", pa.int64()), ("content", pa.int64()), ("doc", pa.int64()),
                         ("tag", pa.int64()), ("s", pa.int32()), ("e", pa.int32())])
EDGE, SPAN = 0, 1


class Hasher:
    """Polynomial hashes of word ranges, modulo 2**64, from prefix sums."""

    BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd

    def __init__(self):
        self.up = [np.ones(1, np.uint64) for _ in self.BASES]
        self.down = [np.ones(1, np.uint64) for _ in self.BASES]

    def reach(self, n: int) -> None:
        """Powers of the bases and of their inverses up to n."""
        if len(self.up[0]) <= n:
            n = 2 * n
            for i, base in enumerate(self.BASES):
                for table, factor in ((self.up, base), (self.down, pow(base, -1, 1 << 64))):
                    powers = np.full(n + 1, factor, np.uint64)
                    powers[0] = 1
                    table[i] = np.multiply.accumulate(powers)

    def sums(self, words: list[bytes]) -> list[np.ndarray]:
        from xxhash import xxh64_digest

        n = len(words)
        self.reach(n)
        x = np.frombuffer(b"".join([xxh64_digest(w) for w in words]), "<u8")
        out = []
        for up in self.up:
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(x * up[:n], out=total[1:])
            out.append(total)
        return out

    def ranges(self, sums: list[np.ndarray], which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[which][end] - sums[which][start]) * self.down[which][start])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a hash."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least value of every run of ``width`` values."""
    best, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        best = np.where(values[left] <= values[right], left, right)
        have += step
    return best


def edges_of(words: list[bytes], hasher: Hasher, window: int, kmer: int):
    """(node, content, first window, last window) of every edge of a text."""
    n = len(words)
    if n < window:
        return None
    sums = hasher.sums(words)
    at = np.arange(n - kmer + 1)
    kmers = hasher.ranges(sums, 0, at, at + kmer)
    least = sliding_argmin(kmers, window - kmer + 1)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    last = np.r_[first[1:], len(least)] - 1
    content = hasher.ranges(sums, 1, first, last + window) ^ mixed((least[first] - first + 1).astype(np.uint64))
    return kmers[least[first]].view(np.int64), content.view(np.int64), first, last


def merged_spans(doc: np.ndarray, tag: np.ndarray, s: np.ndarray, e: np.ndarray):
    """Spans [s, e) of documents with touching and overlapping ones joined."""
    order = np.lexsort((e, s, tag, doc))
    doc, tag, s, e = doc[order], tag[order], s[order], e[order]
    same = np.r_[False, (doc[1:] == doc[:-1]) & (tag[1:] == tag[:-1])]
    group = np.cumsum(~same)
    reach = np.maximum.accumulate(e + group * (1 << 33)) - group * (1 << 33)  # furthest end so far in the document
    new = ~same
    new[1:] |= s[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return doc[first], tag[first], s[first], reach[np.r_[first[1:], len(s)] - 1] if len(s) else e


def compacted(parts: list[tuple], window: int) -> Iterator[pa.RecordBatch]:
    """Edges of a task: those of the smallest document of each content, and spans for the rest."""
    if not parts:
        return
    node, content, doc, tag, s, e = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((doc, content, node))
    node, content, doc, tag, s, e = (c[order] for c in (node, content, doc, tag, s, e))
    first = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (content[1:] != content[:-1])])
    owner = np.repeat(doc[first], np.diff(np.r_[first, len(doc)]))
    own = doc == owner
    yield batch(EDGE, node[own], content[own], doc[own], tag[own], s[own], e[own])
    if not own.all():
        d, t, a, b = merged_spans(doc[~own], tag[~own], s[~own].astype(np.int64), e[~own].astype(np.int64) + window)
        zero = np.zeros(len(d), np.int64)
        yield batch(SPAN, zero, zero, d, t, a, b)


def batch(kind, node, content, doc, tag, s, e) -> pa.RecordBatch:
    columns = [np.full(len(doc), kind, np.int32), node, content, doc, tag, s.astype(np.int32), e.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=EDGES_ARROW)


def edge_task(batches: Iterator[pa.RecordBatch], window: int, kmer: int) -> Iterator[pa.RecordBatch]:
    hasher, parts, held = Hasher(), [], 0
    for b in batches:
        for doc, tag, text in zip(*(c.to_pylist() for c in b.columns)):
            found = edges_of(text.encode().split(), hasher, window, kmer)
            if found is None:
                continue
            node, content, first, last = found
            n = len(node)
            parts.append((node, content, np.full(n, doc, np.int64), np.full(n, tag, np.int64), first.astype(np.int32), last.astype(np.int32)))
            held += n
            if held >= FLUSH:
                yield from compacted(parts, window)
                parts, held = [], 0
    yield from compacted(parts, window)


WINDOWS = "h1 long, h2 long, doc long, tag long, s int"
WINDOWS_ARROW = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("s", pa.int32())])


def window_task(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Documents with their opened edges (doc, tag, text, firsts, lasts) -> their windows."""
    hasher = Hasher()
    for b in batches:
        parts = []
        for doc, tag, text, firsts, lasts in zip(*(c.to_pylist() for c in b.columns)):
            words = text.encode().split()
            sums = hasher.sums(words)
            firsts, lasts = np.array(firsts, np.int64), np.array(lasts, np.int64)
            sizes = lasts - firsts + 1
            s = np.repeat(firsts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            h = [hasher.ranges(sums, i, s, s + window).view(np.int64) for i in (0, 1)]
            parts.append((*h, np.full(len(s), doc, np.int64), np.full(len(s), tag, np.int64), s.astype(np.int32)))
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=WINDOWS_ARROW)


def covered(n: int, starts: list[int], ends: list[int]) -> np.ndarray:
    """Which of n words some span covers."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n]) > 0


def keyed(docs: DataFrame) -> DataFrame:
    """doc (null ids behind all others), tag and text. Where a doc_id repeats, the
    tag (a hash of the text) tells its texts apart; equal texts share their spans anyway."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), text_of(docs).alias("text"))
    repeats = not rows.groupBy("doc").count().where("count > 1").limit(1).isEmpty()
    return rows.select("doc", (F.xxhash64("text") if repeats else F.lit(0).cast("long")).alias("tag"), "text")


def repeated_spans(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """(doc, tag, starts, ends): per document the word spans [start, end) whose
    every word lies in a window that also starts in a document with a smaller id."""
    prepare(docs.sparkSession)
    rows = keyed(docs)
    found = stored(rows.select("doc", "tag", "text").mapInArrow(lambda b: edge_task(b, window, kmer), EDGES))
    edges = found.where(F.col("kind") == EDGE).select("node", "content", "doc", "tag", "s", "e")
    spans = found.where(F.col("kind") == SPAN).select("doc", "tag", "s", "e")
    # nodes of two documents or more, and the edges through them
    nodes = edges.groupBy("node").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("node")
    # stored first: Spark splits a hot key only in a join of plain exchanges
    shared = stored(edges.join(stored(nodes), "node"))
    owners = stored(shared.groupBy("node", "content").agg(F.min("doc").alias("owner")))
    owned = stored(shared.join(owners, ["node", "content"]).select("node", "content", "doc", "tag", "s", "e", "owner"))
    whole = owned.where("doc > owner").select("doc", "tag", "s", (F.col("e") + window).alias("e"))
    # nodes with several contents, of several documents, are opened
    branching = (owned.groupBy("node").agg(F.min("content").alias("c0"), F.max("content").alias("c1"),
                                           F.min("owner").alias("d0"), F.max("owner").alias("d1"))
                 .where("c0 < c1 and d0 < d1").select("node"))
    opened = (owned.where("doc = owner").join(stored(branching), "node")
              .groupBy("doc", "tag").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("edges")))
    sources = rows.join(opened, ["doc", "tag"]).select("doc", "tag", "text", F.col("edges.s").alias("firsts"), F.col("edges.e").alias("lasts"))
    windows = stored(sources.mapInArrow(lambda b: window_task(b, window), WINDOWS))
    lowest = windows.groupBy("h1", "h2").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("h1", "h2", "low")
    single = windows.join(stored(lowest), ["h1", "h2"]).where("doc > low").select("doc", "tag", "s", (F.col("s") + window).alias("e"))
    every = spans.unionByName(whole).unionByName(single)
    return (every.groupBy("doc", "tag").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
            .select("doc", "tag", F.col("spans.s").alias("starts"), F.col("spans.e").alias("ends")))


KEPT = "doc_id long, n_words long, n_removed long, kept_text string"


def remove_repeats(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (the kept words joined by one blank) of every row.

    Null text has no words. A null doc_id counts as larger than every id, and
    rows that repeat a doc_id do not remove words from each other. Other
    columns are not read; an empty table gives an empty result.
    """
    return digested(docs, window, kmer, False)


def digested(docs: DataFrame, window: int, kmer: int, digest: bool) -> DataFrame:
    spans = repeated_spans(docs, window, kmer)
    rows = keyed(docs).join(spans, ["doc", "tag"], "left").select("doc", "text", "starts", "ends")
    name = "kept_sha256" if digest else "kept_text"
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), (name, pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, counts, gone, out = [], [], [], []
            for doc, text, starts, ends in zip(*(c.to_pylist() for c in b.columns)):
                words = text.encode().split()
                ids.append(None if doc == NO_ID else doc)
                counts.append(len(words))
                removed = 0
                if starts:
                    hit = covered(len(words), starts, ends)
                    removed = int(hit.sum())
                    words = [w for w, h in zip(words, hit.tolist()) if not h]
                gone.append(removed)
                kept = b" ".join(words)
                out.append(hex_sha256(kept) if digest else kept.decode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.string())], schema=schema)

    return rows.mapInArrow(task, KEPT.replace("kept_text", name))


def removal_digests(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """Like :func:`remove_repeats`, with the sha256 of the kept text in its place."""
    return digested(docs, window, kmer, True)
