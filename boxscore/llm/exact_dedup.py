"""Exact deduplication with Patricia-trie owners.

Texts count as equal when they are identical after every run of ASCII white
space became one space. Each map task first inserts its texts into a
compressed radix trie whose keys are content hash, length and the full byte
string, so copies inside a task meet before anything is shuffled; a trie over
its byte budget spills its largest subtree, which only means that this
subtree's copies meet one step later. The distinct texts are then partitioned
by (content hash, length) and sorted, inserted into a second trie, and each
subtree is closed as soon as the order has passed it. Terminal nodes hold the
smallest identifier and the number of rows.

Bytes are compared in full, so equal hashes of different texts stay apart.
A hot text reaches the second trie at most once per map task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, in_batches, prepare, text_of

SPILL_BYTES = 64 << 20
NO_ID = (1 << 63) - 1

REPS = "hash binary, bytes long, text binary, has_no_id int, id long, row long, size long, ties long"
OWNERS = "sha256 string, keep_id long, keep_row long, group_size long, ties long"


class Node:
    __slots__ = ("label", "children", "terminal")

    def __init__(self, label: bytes, terminal=None):
        self.label, self.children, self.terminal = label, {}, terminal


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by bisection on slices."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def merged(a, b):
    """Terminal payload (has_no_id, id, row, size, ties) of two groups of equal texts."""
    if a is None:
        return b
    first, size = min(a[:3], b[:3]), a[3] + b[3]
    ties = (a[4] if a[:2] == first[:2] else 0) + (b[4] if b[:2] == first[:2] else 0)
    return (*first, size, ties)


class PatriciaTrie:
    """Byte-string trie with path compression; every edge label is a byte string."""

    def __init__(self):
        self.root = Node(b"")
        self.held: dict[int, int] = {}  # bytes by the first byte of the key
        self.total = 0

    def insert(self, key: bytes, payload) -> None:
        node, at = self.root, 0
        while True:
            child = node.children.get(key[at]) if at < len(key) else None
            if at == len(key):
                node.terminal = merged(node.terminal, payload)
                return
            if child is None:
                node.children[key[at]] = Node(key[at:], payload)
                self._grow(key[0], len(key) - at)
                return
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            cut = common_prefix(child.label, key[at:])
            fork = Node(child.label[:cut])
            child.label = child.label[cut:]
            fork.children[child.label[0]] = child
            node.children[key[at]] = fork
            node, at = fork, at + cut

    def _grow(self, first: int, size: int) -> None:
        size += 200  # the node itself
        self.held[first] = self.held.get(first, 0) + size
        self.total += size

    def spill_largest(self) -> Iterator[tuple[bytes, tuple]]:
        first = max(self.held, key=self.held.get)
        return self.spill(first)

    def spill(self, first: int) -> Iterator[tuple[bytes, tuple]]:
        """Remove the subtree under a first byte and yield its terminals."""
        self.total -= self.held.pop(first, 0)
        yield from terminals(self.root.children.pop(first), b"")

    def drain(self) -> Iterator[tuple[bytes, tuple]]:
        for first in sorted(self.root.children):
            yield from self.spill(first)
        if self.root.terminal is not None:
            yield b"", self.root.terminal


def terminals(node: Node, prefix: bytes) -> Iterator[tuple[bytes, tuple]]:
    stack = [(node, prefix)]
    while stack:
        node, prefix = stack.pop()
        key = prefix + node.label
        if node.terminal is not None:
            yield key, node.terminal
        stack.extend((node.children[b], key) for b in sorted(node.children, reverse=True))


REPS_ARROW = pa.schema([("hash", pa.binary()), ("bytes", pa.int64()), ("text", pa.binary()), ("has_no_id", pa.int32()),
                        ("id", pa.int64()), ("row", pa.int64()), ("size", pa.int64()), ("ties", pa.int64())])
OWNERS_ARROW = pa.schema([("sha256", pa.string()), ("keep_id", pa.int64()), ("keep_row", pa.int64()),
                          ("group_size", pa.int64()), ("ties", pa.int64())])
KEY = 16  # hash and length in front of the text


def local_tries(batches: Iterator[pa.RecordBatch], spill_bytes: int) -> Iterator[pa.RecordBatch]:
    """Columns id, row, hash, text of one task -> its distinct texts."""
    trie = PatriciaTrie()

    def rows():
        for batch in batches:
            ids, row_ids, hashes, texts = (batch.column(i).to_pylist() for i in range(4))
            for doc, row, h, text in zip(ids, row_ids, hashes, texts):
                key = h.to_bytes(8, "big", signed=True) + len(text).to_bytes(8, "big") + text
                trie.insert(key, (0 if doc is not None else 1, doc if doc is not None else NO_ID, row, 1, 1))
                while trie.total > spill_bytes:
                    yield from trie.spill_largest()
        yield from trie.drain()

    flat = ((k[:8], len(k) - KEY, k[KEY:], *p) for k, p in rows())
    yield from in_batches(flat, REPS_ARROW, size_of=lambda r: len(r[2]))


def owner_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of local_tries in the order of (hash, bytes) -> one row per distinct text."""
    from hashlib import sha256

    def rows():
        trie, current = PatriciaTrie(), None
        for batch in batches:
            for h, n, text, *payload in zip(*(c.to_pylist() for c in batch.columns)):
                if (h, n) != current:
                    yield from trie.drain()
                    trie, current = PatriciaTrie(), (h, n)
                trie.insert(h + n.to_bytes(8, "big") + text, tuple(payload))
        yield from trie.drain()

    flat = ((sha256(k[KEY:]).hexdigest(), None if none else doc, row, size, ties) for k, (none, doc, row, size, ties) in rows())
    yield from in_batches(flat, OWNERS_ARROW)


def normalised(docs: DataFrame):
    return F.regexp_replace(text_of(docs), SPACE_CLASS + "+", " ")


def grouped(docs: DataFrame, spill_bytes: int) -> DataFrame:
    """(doc, keep_id, group_size, kept, text_sha256), doc being the whole input row."""
    prepare(docs.sparkSession)
    norm = normalised(docs)
    own = docs["doc_id"].cast("long")
    row = F.monotonically_increasing_id()
    flat = docs.select(own.alias("id"), row.alias("row"), F.xxhash64(norm).alias("hash"), norm.cast("binary").alias("text"))
    reps = flat.mapInArrow(lambda b: local_tries(b, spill_bytes), REPS)
    owners = (reps.repartition("hash", "bytes").sortWithinPartitions("hash", "bytes")
              .mapInArrow(owner_tries, OWNERS)
              .where("group_size > 1"))
    rows = docs.select(F.struct("*").alias("doc"), own.alias("own"), F.sha2(norm.cast("binary"), 256).alias("text_sha256"), row.alias("row"))
    joined = rows.join(owners, rows["text_sha256"] == owners["sha256"], "left")
    alone = F.col("sha256").isNull()
    first = F.col("own").eqNullSafe(F.col("keep_id")) & ((F.col("ties") == 1) | (F.col("row") == F.col("keep_row")))
    return joined.select("doc", F.when(alone, F.col("own")).otherwise(F.col("keep_id")).alias("keep_id"),
                         F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                         (alone | first).alias("kept"), "text_sha256")


def exact_groups(docs: DataFrame, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """Every row of ``docs`` with the owner of its text.

    Adds keep_id, group_size, kept and text_sha256 (columns of these names in
    the input are replaced). Null text counts as empty, a null doc_id sorts
    after every id. Of rows that repeat the smallest doc_id, the first in
    file order stays. An empty table gives an empty result.
    """
    added = ("keep_id", "group_size", "kept", "text_sha256")
    return grouped(docs, spill_bytes).select(*(F.col("doc")[c].alias(c) for c in docs.columns if c not in added), *added)


def dedup(docs: DataFrame, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """The rows that own their text, with the columns of ``docs``."""
    return grouped(docs, spill_bytes).where("kept").select("doc.*")
