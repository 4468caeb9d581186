"""SimHash near-duplicates through pivot distance tables.

Every fingerprint gets a row of Hamming distances to fixed reference
fingerprints (pivots): the zero word, one word per pair of neighbouring bits
and a few scattered ones. By the triangle inequality two fingerprints within
r bits differ by at most r in every coordinate. Distances to the zero word
and to a bit pair together say how many of the pair's bits are set, so for
each of r + 2 groups of bit pairs the coordinates of two such fingerprints
agree entirely in at least two groups. Fingerprints are therefore joined on
the coordinates of every two groups, a candidate is discarded when any
coordinate differs by more than r, and the survivors are verified bit by bit.
Inside a bucket only a spanning forest of the links is kept, so a group of
copies never turns into all its pairs.

Equal fingerprints are joined before all that. A bucket of more than
``HEAVY`` distinct fingerprints is not opened in one task: its members are
listed under every word within r/2 bits instead, where all members of one
word are within r bits of each other, and a word has at most 65 of them for
r = 2. Both ways are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, text_of
from .graph import components

SHINGLE = 3
MAX_BITS = 2
HEAVY = 1024
SEED = 42
PAIRS = 32  # neighbouring bit pairs of a fingerprint


def pivots() -> np.ndarray:
    """The reference fingerprints: zero, the 32 bit pairs, 8 scattered words from a fixed seed."""
    scattered = np.random.default_rng(SEED).integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return np.concatenate([np.zeros(1, np.uint64), np.uint64(3) << (np.uint64(2) * np.arange(PAIRS, dtype=np.uint64)), scattered])


def distance_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distances, one row per fingerprint and one column per pivot."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :])


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits: set where more than half of the shingles' XXH64 have the bit; no word: zero."""
    from xxhash import xxh64_digest

    words = text.encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = xxh64_digest(joined, SEED)
    else:
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = [0, *(blanks[: len(words) - shingle] + 1).tolist()]
        ends = [*blanks[shingle - 1:].tolist(), len(joined)]
        digests = b"".join([xxh64_digest(joined[s:e], SEED) for s, e in zip(starts, ends)])
    bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(bits)).tobytes(), "big", signed=True)


def row_text_key(docs: DataFrame):
    """Digest of a row's text; with the doc_id it names the row (null text is empty)."""
    return F.sha2(text_of(docs).cast("binary"), 256)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, copy (digest of the text) and fp (the 64 bits as a long) of every row; null text is empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("copy", pa.string()), ("fp", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps, pa.int64())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"), row_text_key(docs).alias("copy"))
    return rows.mapInArrow(task, "doc_id long, copy string, fp long")


def bucket_keys(table: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """One key per two coordinate groups; fingerprints within max_bits share at least one."""
    zero, pairs = table[:, :1].astype(np.int64), table[:, 1: 1 + PAIRS].astype(np.int64)
    counts = (zero - pairs + 2) // 2  # set bits of each pair: 0, 1 or 2
    groups = np.array_split(np.arange(PAIRS), max_bits + 2)
    codes = []
    for g in groups:
        code = np.zeros(len(table), np.int64)
        for column in g:
            code = code * 3 + counts[:, column]
        codes.append(code)
    width = 3 ** max(map(len, groups))
    choices = list(combinations(range(len(groups)), 2))
    return [(codes[i] * width + codes[j]) * len(choices) + n for n, (i, j) in enumerate(choices)]


def keyed(fps: DataFrame, max_bits: int) -> DataFrame:
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots()
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            keys = bucket_keys(distance_table(own.view(np.uint64), refs), max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.tile(own, len(keys)))], schema=schema)

    return fps.select("fp").mapInArrow(task, "key long, fp long")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for links a-b, without the roots."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def verified(keys: np.ndarray, fps: np.ndarray, refs: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of sorted buckets: coordinates first, then the bits, then a spanning forest."""
    table = distance_table(fps.view(np.uint64), refs).astype(np.int8)
    left, right = [], []
    at, step = np.arange(len(keys)), 0
    while len(at):
        step += 1
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        near = at[np.abs(table[at] - table[at + step]).max(axis=1, initial=0) <= max_bits]
        near = near[np.bitwise_count(fps[near].view(np.uint64) ^ fps[near + step].view(np.uint64)) <= max_bits]
        left.append(fps[near])
        right.append(fps[near + step])
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(np.concatenate(left), np.concatenate(right))


def bucket_links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Key rows in key order -> links; a bucket cut by a batch waits for the next one."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    refs = pivots()
    keys = fps = np.empty(0, np.int64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
        fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False)])
        whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        a, b = verified(keys[:whole], fps[:whole], refs, max_bits)
        keys, fps = keys[whole:], fps[whole:]
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)
    a, b = verified(keys, fps, refs, max_bits)
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)


def ball(max_bits: int) -> np.ndarray:
    """All words with at most max_bits / 2 bits set."""
    bits = [np.uint64(1) << np.uint64(i) for i in range(64)]
    out = [np.uint64(0)]
    for n in range(1, max_bits // 2 + 1):
        out += [np.bitwise_or.reduce(c) for c in combinations(bits, n)]
    return np.array(out, np.uint64)


def centre_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links of fingerprints through the words within max_bits / 2 bits of them."""
    schema = pa.schema([("centre", pa.int64()), ("fp", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = ball(max_bits)
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for part in np.array_split(own, 1 + len(own) * len(masks) // 500_000):
                centres = (part.view(np.uint64)[:, None] ^ masks[None, :]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(centres.ravel()), pa.array(np.repeat(part, len(masks)))], schema=schema)

    members = fps.mapInArrow(task, "centre long, fp long").groupBy("centre").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    return members.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a <> b").distinct()


def linked_fingerprints(rows: DataFrame, max_bits: int, heavy: int) -> DataFrame:
    """fp and root (smallest fingerprint of its component) of the fingerprints that several rows or a link share."""
    fps = rows.groupBy("fp").agg(F.count("*").alias("n")).checkpoint()
    keys = keyed(fps, max_bits)
    crowded = keys.groupBy("key").count().where(F.col("count") > heavy).select("key").checkpoint()
    if crowded.isEmpty():
        light, extra = keys, None
    else:
        light = keys.join(crowded, "key", "left_anti")
        extra = centre_links(keys.join(crowded, "key", "left_semi").select("fp").distinct(), max_bits)
    links = (light.repartition("key").sortWithinPartitions("key", "fp")
             .mapInArrow(lambda b: bucket_links(b, max_bits), "a long, b long"))
    if extra is not None:
        links = links.unionByName(extra)
    roots = components(links, "a", "b")
    named = fps.join(roots, fps["fp"] == roots["node"], "left").where("n > 1 or node is not null")
    return named.select(F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("root"))


def check_bits(max_bits: int) -> None:
    if max_bits < 2 or max_bits % 2:
        raise ValueError("max_bits must be even and at least 2")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, heavy: int = HEAVY) -> DataFrame:
    """doc_id, fp and component_id of every row of ``docs``.

    Fingerprints link at ``max_bits`` or fewer differing bits (an even number);
    component_id is the smallest doc_id reachable over links. Null text is
    empty (fingerprint zero, linked like any other); a null doc_id never names
    a component unless no member has an id, then component_id is null;
    repeated rows stay. Other columns are not read; an empty table gives none.
    """
    check_bits(max_bits)
    prepare(docs.sparkSession)
    rows = fingerprints(docs, shingle).select("doc_id", "fp").checkpoint()
    named = linked_fingerprints(rows, max_bits, heavy)
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = named.join(firsts, named["_fp"] == firsts["fp"]).select("_fp", "root", "first")
    lowest = named.groupBy("root").agg(F.min("first").alias("lowest"))
    # only fingerprints with company need a look-up
    lookup = named.join(lowest, "root").select("_fp", "lowest", F.lit(True).alias("_found"))
    return (rows.join(lookup, rows["fp"] == lookup["_fp"], "left")
            .select("doc_id", "fp", F.when(F.col("_found"), F.col("lowest")).otherwise(F.col("doc_id")).alias("component_id")))


def as_hex(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, heavy: int = HEAVY) -> DataFrame:
    """One row of each group, with the columns of ``docs``: the one with the
    smallest doc_id, of several such rows the one whose text has the smallest
    digest, of rows that repeat it whole any one.

    Rows are told apart by doc_id and text, so a doc_id that several texts
    share loses only the rows that are copies. Rows without doc_id stay.
    """
    check_bits(max_bits)
    prepare(docs.sparkSession)
    rows = fingerprints(docs, shingle).checkpoint()
    named = linked_fingerprints(rows, max_bits, heavy)
    members = (rows.where("doc_id is not null").join(named, rows["fp"] == named["_fp"])
               .groupBy("root", "doc_id", "copy").agg(F.count("*").alias("times")).checkpoint())
    kept = members.groupBy("root").agg(F.min(F.struct("doc_id", "copy")).alias("kept"))
    is_kept = (F.col("doc_id") == F.col("kept.doc_id")) & (F.col("copy") == F.col("kept.copy"))
    odd = members.join(kept, "root").where(~is_kept | (F.col("times") > 1))
    odd = odd.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), is_kept.alias("_kept")).checkpoint()
    own, text_key = docs["doc_id"].cast("long"), row_text_key(docs)
    gone, twice = odd.where("not _kept"), odd.where("_kept")
    rest = docs.withColumn("_row_key", text_key).withColumn("_row_id", own)
    rest = rest.join(gone, (rest["_row_id"] == gone["_id"]) & (rest["_row_key"] == gone["_copy"]), "left_anti")
    if not twice.isEmpty():
        is_twice = (rest["_row_id"] == twice["_id"]) & (rest["_row_key"] == twice["_copy"])
        once = rest.join(twice, is_twice, "left_semi").dropDuplicates(["_row_id", "_row_key"])
        rest = rest.join(twice, is_twice, "left_anti").unionByName(once)
    return rest.drop("_row_key", "_row_id")
