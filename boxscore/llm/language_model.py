"""Log-bilinear language model, trained in numpy by noise-contrastive estimation.

Every word with at least MIN_COUNT occurrences (and a share MIN_SHARE of the
training tokens, which bounds their number by 1 / MIN_SHARE at any size) has
vectors of its own: one as a context word, one as a predicted word. The model
predicts a token in two steps that are both softmaxes over bounded sets, so
its probabilities are exactly normalised by batched matrix products: first the
class of the word, ``r . q + b``, then the word among the at most GROUP words
of its class, ``r . u + b``, with ``r = C1 e1 + C2 e2`` from the two tokens
before it. The TOP most frequent words and the end of a text are classes of
their own, the other words with vectors are grouped by their endings. A rarer
word falls into one of SHAPES classes by its last two characters; inside it,
words share the probability by their training counts plus one, with one more
unit for all unseen words.

Training covers all training documents: in each of ROUNDS rounds, every task
trains on every token of its documents of that round from the same parameters
(steps of BATCH tokens, of more in a large corpus); the changes are averaged row by row, weighted by how often a task has
used the row, in groups of bounded fan-in.

Counts come from all training rows. Each stretch of documents (a chunk of
about CHUNK_BYTES of text) lists its distinct words once; word counts are
summed over chunks, and every chunk gets the counts of its own words back where
other chunks add to them, so neither the vocabulary nor the texts of a hot word
are ever whole in one place.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_fold, in_batches, prepare, stored, text_of, worker_cache

FOLDS, HELD_OUT = 7, 2
TOP, GROUP, SHAPES = 95, 128, 32
MIN_COUNT, MIN_SHARE = 20, 1e-5
DIMENSIONS, ROUNDS, BATCH, NOISE, NEAR_NOISE, RATE, SEED = 24, 2, 256, 32, 4, 0.15, 11
WINDOW = 128
LARGEST_BATCH, STEPS = 8192, 16_000  # a step has BATCH tokens, and more from BATCH * STEPS tokens of a corpus on
BLOCK_ROWS = 4096
FAN_IN = (64, 1)
CHUNK_BYTES = 24 << 20
LONG, LENGTHS = 4, 16

VOCABULARY = "chunk long, word string, n long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


@dataclass
class Words:
    """The words with vectors, their classes, and the counts that do not need them."""

    words: list[str]        # most frequent first
    counts: np.ndarray
    log_mass: np.ndarray    # log10 of each shape class's counts plus one per word plus one
    shape_counts: np.ndarray
    tokens: int
    distinct: int
    texts: int

    def __post_init__(self):
        n = len(self.words)
        self.single = min(TOP, n)
        others = sorted(range(self.single, n), key=lambda i: (shape(self.words[i]), i))
        self.n_groups = -(-len(others) // GROUP)
        self.first_group, self.first_shape = self.single, self.single + self.n_groups
        self.end_class = self.first_shape + SHAPES
        self.classes = self.end_class + 1
        self.class_of, self.place = np.arange(n), np.zeros(n, np.int64)
        self.members = np.full((self.n_groups, GROUP), -1)
        for k, i in enumerate(others):
            self.class_of[i], self.place[i] = self.first_group + k // GROUP, k % GROUP
            self.members[k // GROUP, k % GROUP] = i
        self.sizes = (self.members >= 0).sum(axis=1)
        self.end = n + SHAPES  # as a context; shapes are n, n + 1, ...

    def batch(self) -> int:
        """Tokens of a training step: more of them where the corpus gives many steps anyway."""
        return int(min(LARGEST_BATCH, max(BATCH, self.tokens // STEPS)))

    def plain(self) -> tuple:
        return self.words, self.counts, self.log_mass, self.shape_counts, self.tokens, self.distinct, self.texts

    def classes_at(self, contexts: np.ndarray) -> np.ndarray:
        return np.concatenate([self.class_of, np.arange(self.first_shape, self.end_class), [self.end_class]]).astype(np.int64)[contexts]


class Parameters:
    """All rows of the model in one matrix; the last column holds the biases.

    Rows: context vectors, class vectors, word vectors, the two context matrices.
    """

    def __init__(self, words: Words, rows: np.ndarray | None = None):
        d = DIMENSIONS
        n_context, n_class, n_word = words.end + 1, words.classes, len(words.words)
        self.bounds = np.cumsum([0, n_context, n_class, n_word, d, d])
        if rows is None:
            rng = np.random.default_rng(SEED)
            rows = np.zeros((self.bounds[-1], d + 1), np.float32)
            rows[: self.bounds[3], :d] = rng.normal(0, 0.1, (self.bounds[3], d))
            rows[self.bounds[3] : self.bounds[4], :d] = 0.5 * np.eye(d)
            rows[self.bounds[4] :, :d] = 0.3 * np.eye(d)
            rows[self.bounds[1] : self.bounds[2], d] = np.log(self.class_shares(words))
            rows[self.bounds[2] : self.bounds[3], d] = np.log(words.counts + 1.0)
        self.rows = rows
        parts = [rows[a:b] for a, b in zip(self.bounds[:-1], self.bounds[1:])]
        self.e, self.c1, self.c2 = parts[0][:, :d], parts[3][:, :d], parts[4][:, :d]
        self.q, self.b = parts[1][:, :d], parts[1][:, d]
        self.u, self.bu = parts[2][:, :d], parts[2][:, d]

    @staticmethod
    def class_shares(words: Words) -> np.ndarray:
        """Training share of each class, every class with something."""
        mass = np.zeros(words.classes)
        np.add.at(mass, words.class_of, words.counts)
        mass[words.first_shape : words.end_class] += words.shape_counts
        mass[words.end_class] += words.texts
        mass = mass / max(mass.sum(), 1.0)
        return 0.98 * mass + 0.02 / words.classes if mass.sum() else np.full(words.classes, 1 / words.classes)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts (A-Z lowered, ASCII white space splits) and how many each text has."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    full = pc.greater(pc.binary_length(flat), 0)  # white space at either end leaves an empty part
    counts = np.bincount(np.repeat(np.arange(len(texts)), sizes)[full.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return flat.filter(full), counts


def shape(word: str) -> int:
    import zlib

    return zlib.crc32(word[-2:].encode()) % SHAPES


def contexts_of(flat: pa.Array, known: dict[str, int]) -> np.ndarray:
    """Context numbers of words; ``known`` holds those of the words with vectors, and the others follow by shape."""
    at = pc.index_in(flat, value_set=pa.array(list(known), pa.string()))
    rare = at.is_null()
    numbers = np.append(np.fromiter(known.values(), np.int64, len(known)), 0)[at.fill_null(len(known)).to_numpy(zero_copy_only=False)]
    endings = pc.utf8_slice_codeunits(flat.filter(rare), -2).dictionary_encode()
    shapes = np.array([shape(e) for e in endings.dictionary.to_pylist()], np.int64)
    if len(shapes):
        numbers[rare.to_numpy(zero_copy_only=False)] = len(known) + shapes[endings.indices.to_numpy()]
    return numbers


def chunked(docs: DataFrame) -> DataFrame:
    """doc_id, text, held_out and the chunk: consecutive rows of a partition, as many as
    CHUNK_BYTES hold at the mean text length. Texts of over LONG times the mean
    have chunks of their own (negative numbers), by length: those of up to LONG
    times the one before, from as many rows as CHUNK_BYTES hold of the longest.
    So no chunk has more than LONG times CHUNK_BYTES, or one text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    mean = max(rows.agg(F.avg(F.octet_length("text"))).first()[0] or 0.0, 16.0)
    per_chunk = max(1, int(CHUNK_BYTES / mean))
    row, size, longest = F.monotonically_increasing_id(), F.octet_length("text"), int(LONG * mean) + 1000
    chunk = F.when(size <= longest, F.floor(row / per_chunk))
    for k in range(LENGTHS):
        longest *= LONG
        span = CHUNK_BYTES // longest
        if span <= 1 or k == LENGTHS - 1:
            chunk = chunk.otherwise(-1 - (row * LENGTHS + k))
            break
        chunk = chunk.when(size <= longest, -1 - (F.floor(row / span) * LENGTHS + k))
    return rows.select("doc_id", "text", (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), chunk.alias("chunk"))


def vocabulary_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each chunk with their training counts (0 for words of held-out rows only)."""
    schema = pa.schema([("chunk", pa.int64()), ("word", pa.string()), ("n", pa.int64())])

    def summed_up(parts):
        found = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return pa.table({"word": found.column("word"), "n": found.column("n_sum")})

    def listed(chunk, parts):
        if parts:
            found = summed_up(parts)
            for part in found.to_batches(max_chunksize=100_000):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, chunk)), part.column("word"), part.column("n")], schema=schema)

    unfinished = {}  # chunk and tables of the chunk begun last, for each length of texts
    for batch in batches:
        held_out, own, texts = batch.columns
        own = own.to_numpy(zero_copy_only=False)
        flat, counts = words_of(texts)
        ends = np.r_[0, np.cumsum(counts)]
        learned = np.repeat(1 - held_out.to_numpy(zero_copy_only=False).astype(np.int64), counts)
        heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else []
        for i, j in zip(heads, [*heads[1:], len(own)]):
            a, b = int(ends[i]), int(ends[j])
            found = summed_up([pa.table({"word": flat.slice(a, b - a), "n": learned[a:b]})])
            length = (-1 - int(own[i])) % LENGTHS if own[i] < 0 else -1
            chunk, parts = unfinished.get(length, (None, []))
            if own[i] != chunk:
                yield from listed(chunk, parts)
                chunk, parts = int(own[i]), []
                unfinished[length] = chunk, parts
            parts.append(found)
    for chunk, parts in unfinished.values():
        yield from listed(chunk, parts)


# -- training ----------------------------------------------------------------


class Trainer:
    """Steps of noise-contrastive estimation from given parameters; remembers how often a row was used."""

    def __init__(self, words: Words, rows: np.ndarray, seed: int):
        self.words, self.p = words, Parameters(words, rows.copy())
        self.start = rows
        self.squares = np.full(rows.shape, 1e-3, np.float32)
        self.used = np.zeros(len(rows), np.float32)
        self.rng = np.random.default_rng(seed)
        shares = Parameters.class_shares(words)
        self.noise_cdf, self.log_noise = shares.cumsum(), np.log(NOISE * shares).astype(np.float32)
        self.class_at = words.classes_at(np.arange(words.end + 1))
        self.log_near = np.log(NEAR_NOISE / np.maximum(words.sizes, 1)).astype(np.float32)
        self.place = np.empty(words.end + 1, np.int64)
        self.batch = words.batch()

    def _ascend(self, rows: np.ndarray, grads: np.ndarray, uses: np.ndarray) -> None:
        """Adagrad on the given rows, by their summed gradients (one column per row)."""
        total = (grads.T / BATCH).astype(np.float32)
        squares = self.squares.take(rows, axis=0)
        squares += total * total
        self.squares[rows] = squares
        total *= RATE
        total /= np.sqrt(squares)
        self.p.rows[rows] += total
        self.used[rows] += uses

    def step(self, w2: np.ndarray, w1: np.ndarray, w: np.ndarray) -> None:
        """One batch of contexts and tokens (context numbers); gradients are summed by row, coordinate by coordinate.

        Tokens are columns, and only the rows that the batch uses are touched.
        """
        p, words, bounds, rng, d = self.p, self.words, self.p.bounds, self.rng, DIMENSIONS
        n_class = words.classes
        cls = self.class_at[w]
        contexts, at = self.numbered(np.concatenate([w1, w2]))
        at1, at2 = at[: len(w)], at[len(w) :]
        e = p.e[contexts]
        r = (p.c1 @ e.T).take(at1, axis=1)
        r += (p.c2 @ e.T).take(at2, axis=1)
        noise = np.minimum(np.searchsorted(self.noise_cdf, rng.random(NOISE)), n_class - 1)
        bias = p.b - self.log_noise
        dr = np.ascontiguousarray(p.q.T).take(cls, axis=1)
        up = sigmoid(-(np.einsum("dn,dn->n", r, dr) + bias[cls]))  # 1 - sigmoid for data
        against = np.ascontiguousarray(p.q[noise])
        down = against @ r
        down += bias[noise][:, None]
        down = sigmoid(down)  # sigmoid for noise
        dr *= up
        dr -= against.T @ down
        by_class, class_uses = summed(cls, up * r, up, n_class), np.bincount(cls, minlength=n_class)
        np.subtract.at(by_class, (slice(None), noise), np.vstack([r @ down.T, down.sum(axis=1)]))
        np.add.at(class_uses, noise, 1)
        # among the words of a class: a few words of the same class, drawn evenly, are the noise
        grouped = np.flatnonzero((cls >= words.first_group) & (cls < words.first_shape))
        if len(grouped):
            rg, wg, group = r.take(grouped, axis=1), w[grouped], cls[grouped] - words.first_group
            log_near = self.log_near[group]
            drawn = words.members[group[:, None], (rng.random((len(grouped), NEAR_NOISE)) * words.sizes[group][:, None]).astype(int)]
            chosen, at = self.numbered(np.concatenate([wg, drawn.T.ravel()]))
            u, bu = np.ascontiguousarray(p.u[chosen].T), p.bu[chosen]
            weights, moved = np.empty((1 + NEAR_NOISE, len(wg)), np.float32), np.empty((d, 1 + NEAR_NOISE, len(wg)), np.float32)
            dg = np.zeros((d, len(wg)), np.float32)
            for k, own_at in enumerate(at.reshape(1 + NEAR_NOISE, len(wg))):
                own = u.take(own_at, axis=1)
                logit = np.einsum("dn,dn->n", rg, own) + bu[own_at] - log_near
                weights[k] = -sigmoid(logit) if k else sigmoid(-logit)
                own *= weights[k]
                dg += own
                np.multiply(rg, weights[k], out=moved[:, k])
            by_word = summed(at, moved.reshape(d, -1), weights.ravel(), len(chosen))
            word_uses = np.bincount(at, minlength=len(chosen))
            dr[:, grouped] += dg
        g1, g2 = (summed(x, dr, None, len(contexts))[:d] for x in (at1, at2))  # of each context word at either place
        context = np.vstack([p.c1.T @ g1 + p.c2.T @ g2, np.zeros((1, len(contexts)))])
        context_uses = np.bincount(at1, minlength=len(contexts)) + np.bincount(at2, minlength=len(contexts))
        matrices = np.vstack([(np.vstack([g1, g2]) @ e).T, np.zeros((1, 2 * d))])
        classes = np.flatnonzero(class_uses)
        self._ascend(bounds[0] + contexts, context, context_uses)
        self._ascend(bounds[1] + classes, by_class[:, classes], class_uses[classes])
        if len(grouped):
            self._ascend(bounds[2] + chosen, by_word, word_uses)
        self._ascend(np.arange(bounds[3], bounds[5]), matrices, np.ones(2 * d))

    def numbered(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return numbered(ids, self.place)

    def learn(self, stream: np.ndarray, tokens: np.ndarray) -> None:
        """Steps over the tokens at the given places of a stream, every one of them."""
        for at in range(0, len(tokens), self.batch):
            t = tokens[at : at + self.batch]
            self.step(stream[t - 2], stream[t - 1], stream[t])


def sigmoid(logits: np.ndarray) -> np.ndarray:
    """In place."""
    np.clip(logits, -30, 30, out=logits)
    np.negative(logits, out=logits)
    np.exp(logits, out=logits)
    logits += 1
    return np.divide(1, logits, out=logits)


def numbered(ids: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids and each id's number among them; ``place`` has room for every id and needs no content."""
    every = np.arange(len(ids))
    place[ids] = every
    distinct = ids[place[ids] == every]
    place[distinct] = every[: len(distinct)]
    return distinct, place[ids]


def summed(ids: np.ndarray, vectors: np.ndarray, bias: np.ndarray | None, n: int) -> np.ndarray:
    """Sums of vectors (columns; and of a bias below them) by id: one column for each of n ids."""
    out = np.empty((len(vectors) + 1, n))
    for k, line in enumerate(vectors):
        out[k] = np.bincount(ids, weights=line, minlength=n)
    out[-1] = 0 if bias is None else np.bincount(ids, weights=bias, minlength=n)
    return out


def streamed(texts: list[str], words: Words, known: dict[str, int], share: float = 1.0, rng=None) -> tuple[np.ndarray, np.ndarray]:
    """Context numbers of texts, each with two ends before and one behind, and the places of all their tokens.

    With a share below one (training has none), every text gives as many
    windows of WINDOW tokens, at random places, as its length times the share
    amounts to on average.
    """
    flat, counts = words_of(pa.array(texts, pa.string()))
    ids = contexts_of(flat, known)
    if share == 1:
        return laid_out(ids, counts, words.end)
    stream, tokens, at, ends = [], [], 0, np.cumsum(counts)
    for found, n in zip(np.split(ids, ends[:-1]), (counts + 1).tolist()):
        for x in rng.integers(0, n, rng.poisson(share * n / min(n, WINDOW))).tolist():
            start = max(0, min(x, n - WINDOW))
            stop = min(n, start + WINDOW)
            before = max(0, start - 2)
            stream.append([words.end] * (2 - (start - before)) + found[before:stop].tolist() + [words.end] * (stop == n))
            tokens.append(np.arange(at + 2, at + 2 + stop - start))
            at += len(stream[-1])
    return np.array([i for part in stream for i in part], np.int64), np.concatenate([*tokens, np.empty(0, np.int64)])


def laid_out(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Context numbers of whole texts, each with two ends before and one behind, and the places of all their tokens."""
    starts = np.r_[0, np.cumsum(counts + 3)]
    stream = np.full(starts[-1], end, np.int64)
    stream[np.arange(len(ids)) + np.repeat(3 * np.arange(len(counts)) + 2, counts)] = ids
    is_token = np.ones(len(stream), bool)
    is_token[starts[:-1]] = is_token[starts[:-1] + 1] = False
    return stream, np.flatnonzero(is_token)


BLOCKS = pa.schema([("block", pa.int32()), ("salt", pa.int64()), ("used", pa.binary()), ("moved", pa.binary())])
BLOCKS_DDL = "block int, salt long, used binary, moved binary"


def training_task(batches: Iterator[pa.RecordBatch], words: Words, rows: np.ndarray, round_: int) -> Iterator[pa.RecordBatch]:
    """Texts of a task -> for blocks of parameter rows, how often each row was used and its change times that."""
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    trainer = Trainer(words, rows, SEED + 1000 * round_ + task)
    known = {w: i for i, w in enumerate(words.words)}
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for at in range(0, len(texts), 500):
            trainer.learn(*streamed(texts[at : at + 500], words, known))

    def found():
        for k, at in enumerate(range(0, len(rows), BLOCK_ROWS)):
            used = trainer.used[at : at + BLOCK_ROWS]
            if used.any():
                moved = (trainer.p.rows[at : at + BLOCK_ROWS] - rows[at : at + BLOCK_ROWS]) * used[:, None]
                yield k, task, used.tobytes(), moved.astype(np.float32).tobytes()

    yield from in_batches(found(), BLOCKS, size_of=lambda r: len(r[3]))


def added(group: pa.Table) -> pa.Table:
    """Sums of a group of tasks' changes to one block."""
    used, moved = (sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in group.column(c)) for c in ("used", "moved"))
    return pa.Table.from_arrays([group.column("block")[:1], pa.array([group.column("salt")[0].as_py()], pa.int64()),
                                 pa.array([used.astype(np.float32).tobytes()]), pa.array([moved.astype(np.float32).tobytes()])], schema=BLOCKS)


def trained(rows: DataFrame, words: Words) -> np.ndarray:
    """Parameter rows after ROUNDS rounds over the training rows; their number is bounded by 1 / MIN_SHARE."""
    spark = rows.sparkSession
    current = Parameters(words).rows
    d = DIMENSIONS
    for round_ in range(ROUNDS):
        shared = spark.sparkContext.broadcast((words.plain(), current))
        own = rows.where(~F.col("held_out") & (F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == round_)).select("text")
        moved = own.mapInArrow(lambda b, r=round_, s=shared: training_task(b, Words(*s.value[0]), s.value[1], r), BLOCKS_DDL)
        for fan_in in FAN_IN:
            moved = moved.withColumn("salt", F.floor(F.col("salt") / 64) if fan_in > 1 else F.lit(0).cast("long")).groupBy("block", "salt").applyInArrow(added, BLOCKS_DDL)
        current = current.copy()
        for r in moved.collect():
            used = np.frombuffer(bytes(r["used"]), np.float32)
            change = np.frombuffer(bytes(r["moved"]), np.float32).reshape(-1, d + 1)
            at = r["block"] * BLOCK_ROWS
            current[at : at + len(used)] += change / np.maximum(used, 1.0)[:, None]
    return current


def known_words(totals: DataFrame, texts: int) -> Words:
    """The vocabulary from (word, c) totals and the number of training texts."""
    seen = totals.where("c > 0")
    whole = seen.agg(F.sum("c").alias("c"), F.count("*").alias("v")).first()
    tokens, distinct = (whole["c"] or 0) + texts, whole["v"] + (texts > 0)
    least = max(MIN_COUNT, int(MIN_SHARE * tokens) + 1)
    frequent = seen.where(F.col("c") >= least).orderBy(F.col("c").desc(), "word").collect()  # at most 1 / MIN_SHARE words
    spec = (F.crc32(F.substring("word", -2, 2).cast("binary")) % SHAPES).cast("int")
    mass, log_mass = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in seen.where(F.col("c") < least).groupBy(spec.alias("shape")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        mass[r["shape"]], log_mass[r["shape"]] = r["c"], np.log10(r["c"] + r["v"] + 1.0)
    return Words([r["word"] for r in frequent], np.array([r["c"] for r in frequent], float), log_mass, mass, tokens, distinct, texts)


# -- scoring -----------------------------------------------------------------


def log_sums(logits: np.ndarray, largest: float) -> np.ndarray:
    """Logarithm of each row's sum of exponentials; ``logits`` are overwritten. None of them is beyond ``largest``."""
    if largest < 80:  # within the range of float32 as they are
        np.exp(logits, out=logits)
        return np.log(logits.sum(axis=1))
    top = logits.max(axis=1, keepdims=True)
    logits -= top
    np.exp(logits, out=logits)
    return top[:, 0] + np.log(logits.sum(axis=1))


class Scorer:
    """log10 probabilities of tokens with a vector or of shape classes, from the two contexts before them."""

    ROWS, SLAB = 4096, 1 << 19
    TABLE, BLOCK = 1 << 22, 1 << 16  # numbers in a table of exponentials, and in a block of its rows
    FLOOR, LEAST = -42.0, 1e-9

    def __init__(self, words: Words, rows: np.ndarray):
        p = Parameters(words, rows)
        self.words = words
        self.a1, self.a2 = p.e @ p.c1.T, p.e @ p.c2.T
        self.q, self.b, self.u, self.bu = (np.ascontiguousarray(x) for x in (p.q, p.b, p.u, p.bu))
        self.place = np.empty(words.end + 1, np.int64)
        self.known = {w: i for i, w in enumerate(words.words)}

    def log_probabilities(self, w2: np.ndarray, w1: np.ndarray, w: np.ndarray) -> np.ndarray:
        """A context that many tokens share is normalised once per slab of tokens."""
        out = np.empty(len(w))
        for at in range(0, len(w), self.SLAB):
            part = slice(at, at + self.SLAB)
            out[part] = self._slab(w2[part], w1[part], w[part])
        return out / np.log(10)

    def _slab(self, w2: np.ndarray, w1: np.ndarray, w: np.ndarray) -> np.ndarray:
        words, n = self.words, self.words.end + 1
        contexts = w2 * n + w1
        order = np.argsort(contexts)
        contexts, w2, w1, w = contexts[order], w2[order], w1[order], w[order]
        cls = words.classes_at(w)
        heads = np.r_[True, contexts[1:] != contexts[:-1]]
        first = np.flatnonzero(heads)
        found = self.logits(w2, w1, self.q, self.b, cls)  # the class, normalised once for every context
        found -= self.log_normalisers(w2[first], w1[first], self.q, self.b)[np.cumsum(heads) - 1]
        grouped = np.flatnonzero((cls >= words.first_group) & (cls < words.first_shape))
        grouped = grouped[np.argsort(cls[grouped].astype(np.int16), kind="stable")]
        ends = np.r_[0, np.cumsum(np.bincount(cls[grouped] - words.first_group, minlength=words.n_groups))]
        w2, w1 = w2[grouped], w1[grouped]
        within = self.logits(w2, w1, self.u, self.bu, w[grouped])
        for group in np.flatnonzero(np.diff(ends)):  # the words of one class at a time
            members, at = words.members[group, : words.sizes[group]], slice(ends[group], ends[group + 1])
            within[at] -= self.log_normalisers(w2[at], w1[at], self.u[members], self.bu[members])
        found[grouped] += within
        out = np.empty(len(w))
        out[order] = found
        return out

    def logits(self, w2: np.ndarray, w1: np.ndarray, vectors: np.ndarray, biases: np.ndarray, own: np.ndarray) -> np.ndarray:
        """``r . v + b`` of every pair of contexts with its own vector and bias."""
        found = np.empty(len(own))
        first, second, last = np.empty((3, self.ROWS, DIMENSIONS), np.float32)
        for a in range(0, len(own), self.ROWS):
            part, m = slice(a, a + self.ROWS), min(self.ROWS, len(own) - a)
            r = self.a1.take(w1[part], axis=0, out=first[:m], mode="clip")
            r += self.a2.take(w2[part], axis=0, out=second[:m], mode="clip")
            found[part] = np.einsum("nd,nd->n", r, vectors.take(own[part], axis=0, out=last[:m], mode="clip"))
        found += biases[own]
        return found

    def log_normalisers(self, w2: np.ndarray, w1: np.ndarray, vectors: np.ndarray, biases: np.ndarray) -> np.ndarray:
        """Logarithm of the sum of ``exp(r . v + b)`` over all vectors, for pairs of contexts.

        As ``r`` is a sum of two, ``exp(r . v + b)`` is a product of one number
        of each context. Where pairs have contexts in common, these are taken
        once per context, scaled to a largest of 1 and to none below
        exp(FLOOR). A sum of their products of LEAST and more is as exact as
        float32 is; the others are taken from the logits.
        """
        (used1, at1), (used2, at2) = numbered(w1, self.place), numbered(w2, self.place)
        total, width = None, max(1, self.TABLE // max(len(used1), len(used2), 1))
        for k in range(0, len(vectors), width):
            v, b = vectors[k : k + width], biases[k : k + width]
            rows = max(1, self.BLOCK // len(v))
            left, right = np.empty((2, min(rows, len(w1)), len(v)), np.float32)
            found, direct = np.empty(len(w1)), np.arange(len(w1))
            if len(used1) + len(used2) <= len(w1):
                e1, top1 = self.exponentials(self.a1[used1], v, b)
                e2, top2 = self.exponentials(self.a2[used2], v, None)
                for a in range(0, len(w1), rows):
                    part, m = slice(a, a + rows), min(rows, len(w1) - a)
                    x = e1.take(at1[part], axis=0, out=left[:m], mode="clip")
                    found[part] = np.einsum("nd,nd->n", x, e2.take(at2[part], axis=0, out=right[:m], mode="clip"))
                direct = np.flatnonzero(found < self.LEAST)
                found[direct] = 1
                found = np.log(found)
                found += top1[at1]
                found += top2[at2]
            if len(direct):
                v_norm, b_most = float(np.sqrt((v * v).sum(axis=1).max())), float(np.abs(b).max())
            for a in range(0, len(direct), rows):
                at = direct[a : a + rows]
                r = self.a1[w1[at]] + self.a2[w2[at]]
                logits = np.matmul(r, v.T, out=left[: len(at)])
                logits += b
                found[at] = log_sums(logits, self.largest(r, v_norm, b_most))
            total = found if total is None else np.logaddexp(total, found)
        return total

    def exponentials(self, halves: np.ndarray, vectors: np.ndarray, biases: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """exp of each row's logits, relative to the row's largest, and that largest."""
        logits = halves @ vectors.T
        if biases is not None:
            logits += biases
        top = logits.max(axis=1)
        logits -= top[:, None]
        np.maximum(logits, self.FLOOR, out=logits)
        return np.exp(logits, out=logits), top

    @staticmethod
    def largest(r: np.ndarray, norm: float, bias: float) -> float:
        """A bound of the logits of contexts ``r`` under vectors and biases no longer than these."""
        return float(np.sqrt(np.einsum("nd,nd->n", r, r).max())) * norm + bias


def score_chunk(docs: pa.Table, others: pa.Table, words: Words, rows: np.ndarray) -> pa.Table:
    """Scores of a chunk's texts; ``others`` has the training counts of its words that differ from those within the chunk."""
    return scored_chunk(docs, others, Scorer(words, rows))


def scored_chunk(docs: pa.Table, others: pa.Table, scorer: Scorer) -> pa.Table:
    """``score_chunk`` with the scorer at hand, which takes as long to make as many short chunks take."""
    words, n = scorer.words, docs.num_rows
    flat, counts = words_of(docs.column("text").combine_chunks())
    flat = flat.dictionary_encode()
    ids, listed = flat.indices.to_numpy(), flat.dictionary
    pa.default_memory_pool().release_unused()  # the words of all texts are large
    learned = ~docs.column("held_out").to_numpy().astype(bool)
    c = np.bincount(ids[np.repeat(learned, counts)], minlength=len(listed))
    c[pc.index_in(others.column("word").combine_chunks(), value_set=listed).to_numpy(zero_copy_only=False)] = others.column("c").to_numpy()
    contexts = contexts_of(listed, scorer.known)
    smooth = np.log10(words.tokens + words.distinct + 1.0)
    base = np.log10(c + 1.0) - smooth
    rare = contexts >= len(words.words)
    inside = np.zeros(len(listed))
    inside[rare] = np.log10(c[rare] + 1.0) - words.log_mass[contexts[rare] - len(words.words)]
    ends = np.r_[0, np.cumsum(counts)]
    n_known, base_score, score = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    i = 0
    while i < n:  # texts of about SLAB words together
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + scorer.SLAB, "right")) - 1)
        used, sizes = ids[ends[i] : ends[j]], counts[i:j]
        of_text = np.repeat(np.arange(j - i), sizes)
        n_known[i:j] = np.bincount(of_text, c[used] > 0, j - i)
        base_score[i:j] = np.bincount(of_text, base[used], j - i)
        stream, t = laid_out(contexts[used], sizes, words.end)
        scored = scorer.log_probabilities(stream[t - 2], stream[t - 1], stream[t])
        score[i:j] = np.bincount(np.repeat(np.arange(j - i), sizes + 1), scored, j - i) + np.bincount(of_text, inside[used], j - i)
        i = j
    n_known += words.texts > 0
    base_score += float(np.log10(words.texts + 1.0) - smooth)
    return pa.table({"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(counts + 1, pa.int64()),
                     "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array([words.tokens] * n, pa.int64()),
                     "base_score": pa.array(base_score, pa.float64()), "score": pa.array(score, pa.float64())})


def score_texts(docs: DataFrame) -> DataFrame:
    """Token counts, the smoothed unigram score and the model's score (both log10) of every row.

    Rows of the held-out fold are scored but not learned from. Null text is
    empty: its only token is the end. A null doc_id counts as the empty text
    for its fold; repeated rows are all scored and all learned from. Other
    columns are not read. An empty table gives an empty result; without
    training rows all classes are equally likely.
    """
    prepare(docs.sparkSession)
    rows = chunked(docs)
    vocabulary = rows.select("held_out", "chunk", "text").mapInArrow(vocabulary_task, VOCABULARY)
    # a word has at most one row per chunk; a chunk knows the counts of words that only it learns from
    by_word = Window.partitionBy("word")
    listed = stored(vocabulary.select("chunk", "word", "n", (F.row_number().over(by_word.orderBy("chunk")) == 1).alias("first"), F.sum("n").over(by_word).alias("c"))
                    .where("first or c <> n").select("chunk", "word", "first", "c", (F.col("c") != F.col("n")).alias("more")))
    words = known_words(listed.where("first").select("word", "c"), rows.where(~F.col("held_out")).count())
    parameters = trained(rows, words)
    counted = listed.where("more").select("chunk", "word", "c")
    # plain values, which a worker reads without this package; their size is bounded by 1 / MIN_SHARE
    shared = docs.sparkSession.sparkContext.broadcast((words.plain(), parameters))
    name = f"lm:{uuid.uuid4().hex}"

    def scored(left, right):
        return scored_chunk(left, right, worker_cache(name, lambda: Scorer(Words(*shared.value[0]), shared.value[1])))

    return rows.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(scored, SCORES)
