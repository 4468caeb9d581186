"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary text, one
on that and the strings that set toxic text apart: strings of any length
around byte n-grams, far more frequent among the windows of toxic than of
ordinary training documents, so that a stem counts though ordinary documents
have it now and then. A window is one word with its blanks, followed by a
fixed carrier that both dictionaries contain, so that even a short word is
compressed rather than stored. What the toxic dictionary saves over the
ordinary one, in bytes, is evidence: the log of how many times as frequent so
much saving is in toxic as in ordinary calibration documents, by the window's
length, from RATIO times on. A document's score is a logistic function of how
many of its windows save and by how much.

Training reads a bounded sample of labelled rows: at most SAMPLE_TOXIC and
SAMPLE_ORDINARY documents by hash of their id, whole texts, at most
SAMPLE_BYTES together (a text that does not fit is left out of training).
Two thirds train the dictionaries, one third calibrates. Scoring reads every
text whole. Labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, prepare, text_of, worker_cache

SAMPLE_TOXIC, SAMPLE_ORDINARY, SAMPLE_BYTES = 3000, 6000, 64 << 20
FOLDS, HELD_OUT = 4, 2
CUTOFF = 0.3
RATIO = 10.0  # single windows tell little at this bar; a document's windows are weighed together
GRAM = 5  # bytes of the n-grams that choose the toxic dictionary's strings
CONTRAST, SEED_CONTRAST = 20.0, 5.0  # of the dictionary's strings, and of grams that longer strings are tried around
ORDINARY_BYTES, TOXIC_BYTES = 12_000, 5_000
LONGEST = 24  # longer windows share a threshold
CARRIER = b"0123456789abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MAX_CACHED = 500_000


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    evidence: dict[int, list[float]]  # by window length and saving: log of how many times as frequent in toxic text, 0 below the bar
    weights: list[float]


def windows(text: str | None) -> list[bytes]:
    return [b" " + w + b" " for w in (text or "").lower().encode("utf-8", "replace").split()]


def compressor(content: bytes):
    import zstandard as z

    params = z.ZstdCompressionParameters(window_log=17, hash_log=15, chain_log=16, search_log=6, min_match=3, target_length=64,
                                         strategy=z.STRATEGY_BTOPT, write_content_size=False, write_checksum=False, write_dict_id=False)
    dictionary = z.ZstdCompressionDict(content + b"\n" * 8 + CARRIER, dict_type=z.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=params)
    return z.ZstdCompressor(dict_data=dictionary, compression_params=params)


class Saver:
    """Bytes that the toxic dictionary saves on a window over the ordinary one."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        # ordinary strings in both, so that a common ending does not hide a toxic stem
        self.a, self.b = compressor(ordinary), compressor(ordinary + b"\n" * 8 + toxic)

    def __call__(self, window: bytes) -> int:
        data = window + CARRIER
        return len(self.a.compress(data)) - len(self.b.compress(data))


def dictionary_content(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; the samples themselves where there are too few to train on."""
    import zstandard as z

    if sum(map(len, samples)) >= 8 * size and len(samples) >= 50:
        try:
            return z.train_dictionary(size, samples).as_bytes()[-size:]
        except z.ZstdError:
            pass  # too uniform for the trainer
    return b"".join(samples)[-size:]


def grams(window: bytes) -> set[bytes]:
    return {window[i:i + GRAM] for i in range(max(1, len(window) - GRAM + 1))}


def extensions(window: bytes, marked: set[bytes]) -> set[bytes]:
    """Strings of a window, of LONGEST bytes at most, that hold a marked gram."""
    at = [i for i in range(max(1, len(window) - GRAM + 1)) if window[i:i + GRAM] in marked]
    return {window[i:j] for k in at for i in range(max(0, k + GRAM - LONGEST), k + 1) for j in range(min(len(window), k + GRAM), min(len(window), i + LONGEST) + 1)}


def without_near_copies(texts: list[str]) -> list[str]:
    """Texts that do not share half of their bottom-8 shingle sketch with earlier ones."""
    from xxhash import xxh64_intdigest

    seen, out = set(), []
    for t in texts:
        ws = windows(t)
        sketch = sorted({xxh64_intdigest(b"".join(ws[i:i + 3])) for i in range(max(1, len(ws) - 2))})[:8]
        if 2 * len(seen.intersection(sketch)) < len(sketch):
            out.append(t)
        seen.update(sketch)
    return out


def train_dictionaries(toxic: list[str], ordinary: list[str], seed: int = 7) -> tuple[bytes, bytes]:
    toxic, ordinary = without_near_copies(toxic), without_near_copies(ordinary)
    # a string is told by its share of all windows: one that ordinary documents have once and toxic ones often is a marker too
    in_toxic, all_toxic, in_ordinary = Counter(), Counter(), Counter()
    for t in toxic:
        ws = windows(t)
        all_toxic.update(ws)
        in_toxic.update(set(ws))
    for t in ordinary:
        in_ordinary.update(windows(t))
    n_toxic, n_ordinary = max(1, all_toxic.total()), max(1, in_ordinary.total())
    g_documents, g_toxic, g_ordinary = Counter(), Counter(), Counter()
    for w, c in all_toxic.items():
        for g in grams(w):
            g_toxic[g] += c
            g_documents[g] += in_toxic[w]
    for w, c in in_ordinary.items():
        for g in grams(w):
            if g in g_toxic:
                g_ordinary[g] += c
    least = max(3, len(toxic) // 100)
    marked = {g for g, c in g_toxic.items()
              if g_documents[g] >= least and (c + 0.5) / n_toxic >= SEED_CONTRAST * (g_ordinary[g] + 0.5) / n_ordinary}
    # markers may be longer than a gram: a stem that many words continue is told from common grams by its whole length;
    # of so many strings some are frequent by chance, so counts are taken two standard deviations low,
    # and by windows as well as by documents, as a document repeats its own strings
    stems, in_stems, ordinary_stems = Counter(), Counter(), Counter()
    for w, c in all_toxic.items():
        for x in extensions(w, marked):
            stems[x] += c
            in_stems[x] += in_toxic[w]
    for w, c in in_ordinary.items():
        for x in extensions(w, marked):
            if x in stems:
                ordinary_stems[x] += c
    good = {x for x, c in stems.items() if in_stems[x] >= least and (c - 2 * c ** 0.5) / n_toxic >= CONTRAST * (ordinary_stems[x] + 0.5) / n_ordinary
            and (in_stems[x] - 2 * in_stems[x] ** 0.5) / len(toxic) >= (ordinary_stems[x] + 0.5) / len(ordinary)}
    strings = []
    for w, c in sorted(in_toxic.items()):
        if found := [x for x in extensions(w, marked) if x in good]:
            strings += [max(found, key=lambda x: (len(x), stems[x], x))] * c
    rng = random.Random(seed)
    rng.shuffle(strings)
    runs = [b"\n".join(strings[i:i + 8]) for i in range(0, len(strings), 8)]
    # every string once behind the trained part, so that none is missing by chance
    alone = b"\n".join(s for s, _ in Counter(strings).most_common(TOXIC_BYTES // 16))[:TOXIC_BYTES // 2]
    chosen = dictionary_content(runs, TOXIC_BYTES - len(alone)) + alone
    plain = [x for t in ordinary for ws in [windows(t)] for x in (b"".join(ws[i:i + 8]) for i in range(0, len(ws), 8))]
    if len(plain) > 100_000:
        plain = rng.sample(plain, 100_000)
    return dictionary_content(plain, ORDINARY_BYTES), chosen


def calibrated(save, toxic: list[str], ordinary: list[str]) -> dict[int, list[float]]:
    """Evidence of each saving per window length: log of the ratio of the shares of windows that save at least so much.

    Lengths borrow from their neighbours; evidence never falls with the saving.
    """
    tables = []
    for texts in (toxic, ordinary):
        counts = np.zeros((LONGEST + 2, 64))
        for w, c in Counter(w for t in texts for w in windows(t)).items():
            counts[min(len(w), LONGEST), max(0, min(63, save(w)))] += c
        counts[1:-1] += counts[:-2] / 4 + counts[2:] / 4
        tables.append(counts[:, ::-1].cumsum(axis=1)[:, ::-1])  # windows that save at least so much
    t, o = tables
    n_t, n_o = max(1.0, t[:, 0].sum()), max(1.0, o[:, 0].sum())
    out = {}
    for length in range(1, LONGEST + 1):
        ratio = np.where(t[length] >= 3, (t[length] / n_t) / ((o[length] + 0.5) / n_o), 0.0)
        ratio[0] = 0.0
        if ratio.max() >= RATIO:
            out[length] = np.log(np.maximum.accumulate(np.where(ratio >= RATIO, ratio, 1.0))).tolist()
    return out


class Scorer:
    def __init__(self, model: Model):
        self.save, self.model = Saver(model.ordinary, model.toxic), model
        self.known: set[bytes] = set()
        self.over: dict[bytes, float] = {}

    def told(self, text: str | None) -> tuple[list[float], int]:
        """Evidence of the windows that have any; the number of windows."""
        ws = windows(text)
        if len(self.known) > MAX_CACHED:
            self.known.clear()
            self.over.clear()
        for w in set(ws).difference(self.known):
            by_saving = self.model.evidence.get(min(len(w), LONGEST))
            if by_saving is not None:
                found = by_saving[max(0, min(63, self.save(w)))]
                if found > 0:
                    self.over[w] = found
            self.known.add(w)
        return [self.over[w] for w in ws if w in self.over], len(ws)

    def features(self, text: str | None) -> list[float]:
        over, n = self.told(text)
        most = sorted(over, reverse=True)
        return [1.0, math.log1p(len(over)), sum(most[:1]), sum(most[1:2]), sum(most[2:3]), math.log1p(1000 * len(over) / (n + 50)),
                math.log1p(sum(over))]

    def score(self, text: str | None) -> float:
        z = sum(a * b for a, b in zip(self.model.weights, self.features(text)))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5) -> list[float]:
    """Weighted logistic regression by Newton's method; the intercept is not shrunk."""
    beta, shrink = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    shrink[0] = 1e-3
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(shrink), x.T @ (weight * (y - p)) - shrink * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta.tolist()


def train_model(toxic: list[str], ordinary: list[str], share: float) -> Model:
    """A model from toxic and ordinary texts; ``share`` is the share of toxic rows among all labelled ones."""
    cut_t, cut_o = max(1, 2 * len(toxic) // 3), max(1, 2 * len(ordinary) // 3)
    plain, marked = train_dictionaries(toxic[:cut_t], ordinary[:cut_o])
    rest_t, rest_o = toxic[cut_t:] or toxic, ordinary[cut_o:] or ordinary
    model = Model(plain, marked, calibrated(Saver(plain, marked), rest_t, rest_o), [0.0] * 7)
    scorer = Scorer(model)
    x = np.array([scorer.features(t) for t in rest_t + rest_o])
    y = np.array([1.0] * len(rest_t) + [0.0] * len(rest_o))
    weight = np.where(y == 1, share / len(rest_t), (1 - share) / len(rest_o)) * len(y)
    model.weights = logistic(x, y, weight)
    return model


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from the labelled rows outside the held-out fold; None without both classes."""
    prepare(docs.sparkSession)
    known = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
             .where((crc_fold(F.col("_id"), FOLDS) != HELD_OUT) & F.col("_toxic").isin(0, 1) & F.col("_id").isNotNull())
             .groupBy("_id").agg(F.max("_toxic").alias("_toxic")))
    counts = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    order = F.xxhash64("_id")
    chosen = [known.where(F.col("_toxic") == c).orderBy(order, "_id").limit(n) for c, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY))]
    ids = chosen[0].unionByName(chosen[1]).withColumn("_order", order)
    # at most SAMPLE_TOXIC + SAMPLE_ORDINARY ids: a proven bound
    found = docs.select(F.col("doc_id").cast("long").alias("_id"), text_of(docs).alias("text")).join(F.broadcast(ids), "_id").checkpoint()
    sizes = found.select("_id", "_order", "_toxic", F.octet_length("text").alias("n"), F.xxhash64("text").alias("h")).collect()
    room, taken = SAMPLE_BYTES, {}
    for r in sorted(sizes, key=lambda r: (r["_order"], r["_id"], r["h"])):
        if r["_id"] not in taken and r["n"] <= room:
            taken[r["_id"]] = r["h"]
            room -= r["n"]
    kept = {}
    for r in found.where(F.octet_length("text") <= SAMPLE_BYTES).toLocalIterator():
        if r["_id"] in taken and r["_id"] not in kept:
            kept[r["_id"]] = (r["_order"], r["_toxic"], r["text"])
    ordered = [v for _, v in sorted(kept.items(), key=lambda kv: (kv[1][0], kv[0]))]
    distinct = list({t: c for _, c, t in ordered}.items())  # copies teach nothing new
    toxic, ordinary = [t for t, c in distinct if c == 1], [t for t, c in distinct if c == 0]
    if not toxic or not ordinary:
        return None
    return train_model(toxic, ordinary, counts[1] / (counts[0] + counts[1]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``docs``.

    Null text is empty; empty texts get the score of a text without a marked
    window. Without a model (no labelled rows of both classes) every score is
    0. Null and repeated doc_ids pass through, other columns are not read.
    """
    prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None if model is None else worker_cache(f"toxicity:{hash((model.toxic, model.ordinary, *model.weights))}", lambda: Scorer(model))
        for batch in batches:
            scores = [0.0 if scorer is None else scorer.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(task, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score stays below the cutoff, with their columns."""
    model = fit(docs, labels)
    prepare(docs.sparkSession)
    at = docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None if model is None else worker_cache(f"toxicity:{hash((model.toxic, model.ordinary, *model.weights))}", lambda: Scorer(model))
        for batch in batches:
            keep = [scorer is None or scorer.score(t) < CUTOFF for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(task, docs.schema)
