"""Prefix trie of conversations by time-forward processing.

Every conversation is rebuilt (its first turns come from the first of its
block of ``BLOCK`` conversations), and each distinct sequence of first turns
is a node. A node is named by its depth and 120 bits: the xor of digests of
(depth, role and text) along its path, so that a prefix's name follows from
sums over blocks of a long conversation and a parent's name from its child's.

Totals of subtrees come from time-forward processing. The values of a node are
held by the smallest conversation through it. Conversations, cut into stretches
of ``STRETCH`` turns, are dealt to shards by hash. A shard sorts the nodes on
its paths by reverse level order (Spark's external sort), and each node, after
taking its messages from a priority queue that spills sorted runs, passes its
total to its parent through that queue. Across shards, the root of a stretch
passes the stretch's sum on to the stretch above it, and the totals of a node
that several shards hold are added up. A common first turn or a frequent
conversation is thus one row per shard there, and no shard grows with it.

Rows without conv_id belong to no conversation and are left out. Null role and
text are empty, a null turn comes first; rows of the same turn are ordered by
the digest of role and text, rows equal in all of it are separate turns. Other
columns are not read. An empty table gives an empty result (no root either).
"""

from __future__ import annotations

import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, prepare, stored

BLOCK, HEADS = 5, 9      # conversation c borrows crc32(c) % HEADS turns of c - c % BLOCK
STRETCH = 4096           # turns of a conversation that stay together
ID_RANGE = 13            # ids of a node are joined in ranges of 2 ** 13
QUEUED = 200_000         # messages a queue holds in memory
KEY = ["depth", "k1", "k2"]


def words(name: str, *parts: Column) -> list[Column]:
    """Two 60-bit numbers of a SHA-256 digest of the parts."""
    digest = F.sha2(F.concat_ws(":", *parts).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("long").alias(f"{name}{i + 1}") for i in (0, 1)]


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, part, pos, w1, w2, bytes): each turn with its place in its conversation;
    and (conv, part, n): the runs of sorted partitions that make up a conversation.

    Rows are sorted across partitions, so that a conversation of any length is
    numbered by runs; ``spread`` lets equal rows lie in several partitions.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                        *words("w", F.char_length(role).cast("string"), role, text),
                        F.octet_length(text).cast("long").alias("bytes"),
                        F.monotonically_increasing_id().alias("spread")).where("conv is not null")
    order = [F.col("turn").asc_nulls_first(), "w1", "w2"]
    ranged = stored(rows.repartitionByRange("conv", *order, "spread").drop("spread").withColumn("part", F.spark_partition_id()))
    runs = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = runs.withColumn("before", F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    # at most one run of each partition goes on from an earlier partition
    went_on = before.where("before > 0").select("conv", "part", "before")
    place = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    out = (ranged.withColumn("place", place).join(F.broadcast(went_on), ["conv", "part"], "left")
           .select("conv", "part", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "w1", "w2", "bytes"))
    return out, runs


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, depth, w1, w2, bytes, is_end): the turns of every rebuilt conversation, its end and, at depth 0, itself."""
    own, runs = numbered(turns)
    base = (own.where((F.col("conv") % BLOCK == 0) & (F.col("pos") < HEADS)).groupBy("conv")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "w1", "w2", "bytes"))).alias("first"))
            .select(F.col("conv").alias("base"), "first"))
    conv = F.col("conv")
    convs = (runs.groupBy("conv").agg(F.sum("n").alias("n"))
             .withColumn("h", (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int"))
             .withColumn("base", conv - conv % BLOCK).join(base, "base", "left")
             .withColumn("taken", F.when(F.col("first").isNull() | (F.col("h") == 0), F.lit(None)).otherwise(F.slice("first", 1, F.greatest("h", F.lit(1)))))
             .withColumn("n_taken", F.coalesce(F.size("taken"), F.lit(0)))
             .withColumn("n_taken", F.greatest("n_taken", F.lit(0)))
             .withColumn("length", F.col("n_taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    at = {"depth": F.col("depth").cast("long"), "is_end": F.col("depth") == F.col("length")}
    columns = ["conv", at["depth"].alias("depth"), "w1", "w2", "bytes", at["is_end"].alias("is_end")]
    zero = F.lit(0).cast("long")
    tops = (convs.withColumn("depth", zero)
            .select("conv", "depth", zero.alias("w1"), zero.alias("w2"), zero.alias("bytes"), at["is_end"].alias("is_end")))
    borrowed = (convs.select("conv", "length", F.explode("taken").alias("t"))
                .select("conv", "length", F.col("t.pos").alias("depth"), "t.w1", "t.w2", "t.bytes").select(*columns))
    shift = runs.drop("n").join(convs.select("conv", "h", "n_taken", "length"), "conv")
    rest = (own.join(shift, ["conv", "part"]).where("pos > h")
            .withColumn("depth", F.col("n_taken") + F.col("pos") - F.col("h")).select(*columns))
    return tops.unionByName(borrowed).unionByName(rest)


def paths(turns: DataFrame) -> DataFrame:
    """(conv, depth, stretch, k1, k2, p1, p2, bytes, is_end): the node of every prefix and its parent's name."""
    rows = rebuilt(turns).withColumn("stretch", F.expr(f"(depth - 1) div {STRETCH}"))
    step = rows.where("depth > 0").select("*", *words("m", *(F.col(c).cast("string") for c in ("depth", "w1", "w2"))))
    along = Window.partitionBy("conv", "stretch").orderBy("depth")
    step = step.withColumns({f"x{i}": F.bit_xor(f"m{i}").over(along) for i in (1, 2)})
    ends = step.where(F.col("depth") % STRETCH == 0)  # last turns of full stretches: a few in very long conversations only
    earlier = Window.partitionBy("conv").orderBy("stretch")
    offsets = ends.select("conv", (F.col("stretch") + 1).alias("stretch"), *(F.bit_xor(f"x{i}").over(earlier).alias(f"o{i}") for i in (1, 2)))
    named = (step.join(offsets, ["conv", "stretch"], "left")
             .withColumns({f"k{i}": F.col(f"x{i}").bitwiseXOR(F.coalesce(f"o{i}", F.lit(0).cast("long"))) for i in (1, 2)})
             .withColumns({f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"m{i}")) for i in (1, 2)}))
    columns = ["conv", "depth", "stretch", "k1", "k2", "p1", "p2", "bytes", "is_end"]
    zero = F.lit(0).cast("long")
    top = rows.where("depth = 0").withColumns({c: zero for c in ("k1", "k2", "p1", "p2")})
    return named.select(*columns).unionByName(top.select(*columns))


class SpillingQueue:
    """Messages (level, k1, k2, leaves, saved) in ascending order; beyond ``limit`` of them, sorted runs go to a file.

    The file is scratch of the running task, as Spark's own spills are, and goes with it.
    """

    RECORD, SIZE = "<5q", 40
    READ = 4096

    def __init__(self, limit: int = QUEUED):
        self.limit, self.heap, self.spills = limit, [], 0
        self.runs: list[Iterator[tuple]] = []
        self.heads: list[tuple] = []  # (first message, number of its run)

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        for message in sorted(self.heap):
            file.write(struct.pack(self.RECORD, *message))
        file.seek(0)
        self.heap, self.spills = [], self.spills + 1
        self.runs.append(self._read(file))
        heapq.heappush(self.heads, (next(self.runs[-1]), len(self.runs) - 1))

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while data := file.read(self.SIZE * self.READ):
                yield from struct.iter_unpack(self.RECORD, data)

    def take(self, key: tuple) -> tuple[int, int]:
        """Sum of the messages for a node."""
        leaves = saved = 0
        while True:
            if self.heap and self.heap[0][:3] == key:
                message = heapq.heappop(self.heap)
            elif self.heads and self.heads[0][0][:3] == key:
                message, run = self.heads[0]
                following = next(self.runs[run], None)
                if following is None:
                    heapq.heappop(self.heads)
                else:
                    heapq.heapreplace(self.heads, (following, run))
            else:
                return leaves, saved
            leaves += message[3]
            saved += message[4]


TOTALS = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64())])
TOTALS_DDL = "depth long, k1 long, k2 long, leaves long, saved long"


def time_forward(batches: Iterator[pa.RecordBatch], limit: int = QUEUED) -> Iterator[pa.RecordBatch]:
    """Rows (depth, k1, k2, p1, p2, leaves, saved) in reverse level order -> the shard's total of each node."""
    queue = SpillingQueue(limit)

    def nodes():
        """One tuple per node of the shard: several of its conversations may pass through it."""
        held = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None and held[:3] == row[:3]:
                    held = (*held[:5], held[5] + row[5], held[6] + row[6])
                    continue
                if held is not None:
                    yield held
                held = row
        if held is not None:
            yield held

    def rows():
        for depth, k1, k2, p1, p2, leaves, saved in nodes():
            got = queue.take((-depth, k1, k2))
            leaves, saved = leaves + got[0], saved + got[1]
            yield depth, k1, k2, leaves, saved
            first_of_stretch = depth % STRETCH == 1 and depth > 1
            if depth and not first_of_stretch and (leaves or saved):
                queue.push((1 - depth, p1, p2, leaves, saved))

    yield from in_batches(rows(), TOTALS)


def subtree_totals(path_rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(depth, k1, k2, leaves, saved) of every node's subtree, itself included."""
    values = nodes.select(F.col("conv_id").alias("conv"), "depth", (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    zero = F.lit(0).cast("long")
    owned = (path_rows.select("conv", "stretch", *KEY, "p1", "p2").join(values, ["conv", "depth"], "left")
             .withColumns({c: F.coalesce(c, zero) for c in ("leaves", "saved")}))
    # across the roots of a conversation's stretches: what lies below the last turn of a stretch
    sums = owned.groupBy("conv", "stretch").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    below = Window.partitionBy("conv").orderBy(F.col("stretch").desc()).rowsBetween(Window.unboundedPreceding, -1)
    inflow = (sums.withColumns({c: F.sum(c).over(below) for c in ("leaves", "saved")}).where("leaves is not null")
              .select("conv", ((F.col("stretch") + 1) * STRETCH).alias("depth"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved")))
    fed = (owned.join(inflow, ["conv", "depth"], "left")
           .select("conv", "stretch", *KEY, "p1", "p2", *((F.col(c) + F.coalesce(f"more_{c}", zero)).alias(c) for c in ("leaves", "saved"))))
    shards = (fed.repartition("conv", "stretch").drop("conv", "stretch")
              .sortWithinPartitions(F.col("depth").desc(), "k1", "k2"))
    partial = shards.mapInArrow(lambda b: time_forward(b), TOTALS_DDL)
    return partial.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


ENDS = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])


def end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, k1, k2, range, ids) in order -> one digest per node, read as a stream."""
    from hashlib import sha256

    def rows():
        current = digest = None
        for batch in batches:
            for depth, k1, k2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, k1, k2) == current:
                    digest.update(b"," + ids.encode())
                    continue
                if current is not None:
                    yield *current, digest.hexdigest()
                current, digest = (depth, k1, k2), sha256(ids.encode())
        if current is not None:
            yield *current, digest.hexdigest()

    yield from in_batches(rows(), ENDS)


def ends(path_rows: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the nodes at which conversations end.

    A digest reads its ids one after the other; they come in joined ranges,
    so the node at which a third of all conversations end reads few rows.
    """
    ranges = (path_rows.where("is_end").groupBy(*KEY, F.shiftright("conv", ID_RANGE).alias("range"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids")))
    return (ranges.repartition(*KEY).sortWithinPartitions(*KEY, "range")
            .mapInArrow(end_digests, "depth long, k1 long, k2 long, ends_sha256 string"))


def trie(turns: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256."""
    prepare(turns.sparkSession)
    path_rows = stored(paths(turns))
    nodes = stored(path_rows.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("is_end").cast("long")).alias("n_ends"),
        F.min("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2")))
    children = (nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
                .agg(F.count("*").alias("n_children")))
    full = (nodes.join(children, KEY, "left").join(subtree_totals(path_rows, nodes), KEY).join(ends(path_rows), KEY, "left")
            .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("above"))
    # the many children of one node are the larger side, which Spark splits where it is skewed
    return (full.join(parents, ["depth", "p1", "p2"], "left")
            .select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("above")).alias("parent_conv_id"), "n_convs", "n_children",
                    F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256"))
