"""Cross-tokenizer alignment by token spans.

Two tokenizers encode the same text. Their spans are the coarse cuts: the
tokenizers library gives character offsets, sentencepiece gives the byte spans
of its offset mapping. Where tokens split a character (byte-level tokens inside a
multibyte character, byte-fallback tokens) the spans only name the whole
character, and the cuts inside are refined with the bytes the tokens decode
to; every coarse cut must meet a refined one. Byte offsets at which tokens of
both end cut the tokens into groups, and tokens that end together are links.

A single blank between two other characters starts a new piece in both
vocabularies, so a text is aligned in stretches cut there and equal stretches
share their alignment within a worker.

The corpus-wide count of an id pair needs a second look at every document.
The first pass keeps, per chunk of documents, the distinct stretches with
their id pairs, and per document the numbers of its stretches only. Pairs are
counted per chunk before they are shuffled, counts go back to each chunk's
distinct pairs, and documents add up what their stretches gather. Vocabulary
sizes bound the only broadcast (highest count per second id).

A null or empty text, or one that does not equal the joined bytes of its
tokens, has no tokens. Null and repeated doc_ids pass through as rows of
their own; other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_alphabet, hex_sha256, in_batches, prepare, stored, text_of, worker_cache

CHUNK_BYTES = 32 << 20      # text of a chunk
CHUNK_STRETCHES = 400_000   # distinct stretches of a chunk
CACHED_UNITS = 100_000
CACHED_LENGTH = 64          # longer units are aligned anew each time
UNIT_BATCH = 5000
RUN = 64                    # units of a run that both libraries encode as one text
BATCH_DOCS_BYTES = 4 << 20


class Aligner:
    """Alignments of units under a byte-level BPE file and a sentencepiece model.

    A stretch is cut further, between a Latin letter and an ASCII mark or line
    break, where neither vocabulary joins two pieces; those units repeat much
    more often and are aligned many at a time.
    """

    FRONT = "\n"  # before a unit without a blank, so that sentencepiece adds its blank there: two tokens that belong to no unit

    def __init__(self, first: str, second: str):
        import os
        import re

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        letters = byte_alphabet()
        self.a_bytes = [b""] * (1 + max(self.a.get_vocab().values()))
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(letters[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        self.b_bytes, mixed = [], False
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            plain = piece.lstrip("▁")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
            mixed |= not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)) and any(map(str.isalpha, plain)) and not plain.isalpha()
        self.lengths = [np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes)]
        self.front = len(self.b.encode(self.FRONT))
        decimal = list(map(str, range(max(map(len, self.lengths)))))
        self.digits = np.array(list(map(len, decimal)))
        self.shown = np.array([d + sign for d in decimal for sign in ",|;"], object)
        # a blank between two characters that no definition counts as white space
        self.split = re.compile(r"(?<=\S) (?=\S)").split
        letter, mark = "[A-Za-zÀ-ÖØ-öø-ſ]", r"[!-&(-/:-@\[-`{-~]"  # no apostrophe: it begins contractions
        self.cut = None if mixed else re.compile(rf"(?<={letter})(?={mark}|\n)|(?<={mark})(?={letter})|(?<=\S\n)(?={letter})").split
        self.units: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def stretches(self, new: list[str]) -> list[tuple]:
        """(tokens of A, tokens of B, groups, groups as text, link codes as bytes) of each stretch, None if bytes differ."""
        # most stretches are one word, which no cut can divide
        cut = [[" " + s] if self.cut is None or s.isalpha() else self.cut(" " + s) for s in new]
        if len(self.units) > CACHED_UNITS:  # units that go on being used move over
            self.older, self.units = self.units, {}
        known = {}
        for u in {u for c in cut for u in c}:
            entry = self.units.get(u, 0)
            known[u] = self.older.get(u, 0) if entry == 0 else entry
        wanted = [u for u, entry in known.items() if entry == 0]
        for at in range(0, len(wanted), UNIT_BATCH):
            part = wanted[at:at + UNIT_BATCH]
            known.update(zip(part, self.align(part)))
        self.units.update((u, e) for u, e in known.items() if len(u) <= CACHED_LENGTH)
        out = []
        for units in cut:
            entries = [known[u] for u in units]
            if len(entries) == 1:
                out.append(entries[0])
            elif None in entries:
                out.append(None)
            else:
                n_a, n_b, groups, shown, codes = zip(*entries)
                out.append((sum(n_a), sum(n_b), sum(groups), ";".join(shown), b"".join(codes)))
        return out

    def align(self, units: list[str]) -> list[tuple]:
        """Alignment of every unit by itself, None where the bytes of tokens are not those of the unit.

        Short units that begin with a blank are encoded in runs, since neither
        vocabulary joins them. A run whose tokens do not give its bytes or do
        not end where its units do is encoded again in eighths, down to single units.
        """
        plain, other = [], []
        for u in units:
            (plain if self.joins(u) else other).append(u)
        runs = [plain[at:at + RUN] for at in range(0, len(plain), RUN)] + [[u] for u in other]
        found: dict[str, tuple] = {}
        while runs:
            broken = [r for r in self._align_runs(runs, found) if len(r) > 1]
            runs = [r[k * len(r) // 8:(k + 1) * len(r) // 8] for r in broken for k in range(8)]
            runs = [r for r in runs if r]
        return [found.get(u) for u in units]

    @staticmethod
    def joins(unit: str) -> bool:
        """Whether the unit is cut off by its blank wherever it stands between units of this kind."""
        return 1 < len(unit) <= CACHED_LENGTH and unit[0] == " " and not unit[1].isspace() and not unit[-1].isspace()

    def _align_runs(self, runs: list[list[str]], found: dict[str, tuple]) -> list[list[str]]:
        """Adds the alignments of all units of the runs to ``found``; returns the runs whose tokens do not fit."""
        texts = ["".join(r) for r in runs]
        firsts = self.a.encode_batch(texts, add_special_tokens=False)
        # sentencepiece adds the blank of a text that begins with one
        seconds = self.b.encode([t[1:] if t[0] == " " else self.FRONT + t for t in texts], return_type="offset_mapping", return_bytes=True, num_threads=1)
        skipped = [0 if t[0] == " " else self.front for t in texts]
        ids = [[f.ids for f in firsts], [x["ids"][k:] for x, k in zip(seconds, skipped)]]
        spans = [[f.offsets for f in firsts], [x["offsets"][k:] for x, k in zip(seconds, skipped)]]
        broken = []
        if not self._fits(runs, texts, *ids):
            right = [self._fits([r], [t], [x], [y]) for r, t, x, y in zip(runs, texts, *ids)]
            broken = [r for ok, r in zip(right, runs) if not ok]
            runs, texts, *lists = ([x for ok, x in zip(right, those) if ok] for those in (runs, texts, *ids, *spans))
            ids, spans = lists[:2], lists[2:]
        if runs:
            units = list(chain.from_iterable(runs))
            found.update(zip(units, self._aligned(units, texts, ids, spans)))
        return broken

    def _fits(self, runs: list[list[str]], texts: list[str], *id_lists: list[list[int]]) -> bool:
        """Whether the tokens give the bytes of the texts and end where texts and units do."""
        whole = "".join(texts).encode()
        if any(b"".join(map(known.__getitem__, chain.from_iterable(lists))) != whole for known, lists in zip((self.a_bytes, self.b_bytes), id_lists)):
            return False
        if len(runs) == len(runs[0]) == 1:
            return True
        text_ends = np.cumsum([len(t.encode()) for t in texts])
        unit_ends = np.cumsum([len(u.encode()) for r in runs for u in r])
        fit = True
        for lengths, lists in zip(self.lengths, id_lists):
            ends = np.cumsum(lengths[np.fromiter(chain.from_iterable(lists), np.int64)])
            fit = (fit and all(lists) and bool((ends[np.cumsum(list(map(len, lists))) - 1] == text_ends).all())
                   and bool((ends[np.searchsorted(ends, unit_ends)] == unit_ends).all()))
        return fit

    def _aligned(self, units: list[str], texts: list[str], id_lists: list, spans: list) -> list[tuple]:
        """All units as one row of bytes: the ends of tokens are cut out of it together."""
        whole = "".join(texts).encode()
        data = np.append(np.frombuffer(whole, np.uint8), 0) & 0xC0
        counts = [np.fromiter(map(len, x), np.int64, len(texts)) for x in id_lists]
        ids = [np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in zip(id_lists, counts)]
        stops = [np.fromiter(chain.from_iterable(chain.from_iterable(x)), np.int64, 2 * int(n.sum()))[1::2] for x, n in zip(spans, counts)]
        # coarse cuts: ends of characters from the first library, bytes from the second
        char_ends = np.flatnonzero(data != 0x80)[1:]
        chars_before = np.cumsum([0] + [len(t) for t in texts[:-1]])
        bytes_before = np.cumsum([0] + [len(t.encode()) for t in texts[:-1]]) + [1 if t[0] == " " else -len(self.FRONT) for t in texts]
        coarse = [char_ends[stops[0] + np.repeat(chars_before, counts[0]) - 1], stops[1] + np.repeat(bytes_before, counts[1])]
        cuts = []
        for k in (0, 1):
            refined = np.cumsum(self.lengths[k][ids[k]])  # bytes of the tokens, also inside characters
            if (refined != coarse[k])[data[refined] != 0x80].any():
                raise AssertionError("spans and bytes of tokens disagree")
            cuts.append(refined)
        ends = np.intersect1d(*cuts, assume_unique=True)
        i, j = (np.searchsorted(c, ends) for c in cuts)
        codes = (ids[0][i] << 32 | ids[1][j]).tobytes()
        # all tokens by group, those of A first; the sign behind a token tells what ends with it
        last = [np.zeros(len(x), np.int64) for x in ids]
        last[0][i], last[1][j] = 1, 2
        groups = np.concatenate([2 * (np.cumsum(last[0]) - last[0]), np.cumsum(last[1]) - last[1] + 1])
        order = np.argsort(groups, kind="stable")
        number, sign = np.concatenate(ids)[order], np.concatenate(last)[order]
        shown = "".join(self.shown[number * 3 + sign].tolist())
        shown_ends = np.cumsum(self.digits[number] + 1)[np.flatnonzero(sign == 2)]
        unit_ends = np.cumsum(np.fromiter((len(u.encode()) for u in units), np.int64, len(units)))
        n_a, n_b = (np.diff(np.searchsorted(c, unit_ends, "right"), prepend=0).tolist() for c in cuts)
        groups = np.searchsorted(ends, unit_ends, "right")
        out, at, shown_at = [], 0, 0
        for a, b, to, shown_to in zip(n_a, n_b, groups.tolist(), shown_ends[groups - 1].tolist()):
            out.append((a, b, to - at, shown[shown_at:shown_to - 1], codes[8 * at:8 * to]))
            at, shown_at = to, shown_to
        return out


FIRST = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                   ("groups_sha256", pa.string()), ("stretches", pa.list_(pa.int32())),
                   ("codes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                   ("starts", pa.list_(pa.int32())), ("members", pa.list_(pa.int32()))])
FIRST_DDL = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, stretches array<int>, "
             "codes array<long>, counts array<long>, starts array<int>, members array<int>")


class Chunk:
    """Distinct stretches of some documents and how often they occur."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.index: dict[str, int] = {}
        self.entries: list[tuple] = []
        self.uses = np.zeros(0, np.int64)
        self.all_fit = True

    def learn(self, texts: list[list[str]], aligner: Aligner) -> None:
        """Number and align every stretch that is new to the chunk."""
        new = list({s for t in texts for s in t}.difference(self.index))
        self.index.update(zip(new, range(len(self.entries), len(self.entries) + len(new))))
        self.entries += (found := aligner.stretches(new))
        self.all_fit &= None not in found

    def use(self, numbers: Iterator[int]) -> None:
        """Count these stretches as used once more each time they occur."""
        more = np.bincount(np.fromiter(numbers, np.int64), minlength=len(self.entries))
        more[: len(self.uses)] += self.uses
        self.uses = more

    def dictionary(self) -> tuple:
        """The row that holds the chunk's distinct pairs, their counts and each stretch's pairs."""
        lists = [e[4] if e else b"" for e in self.entries]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists)) // 8
        flat = np.frombuffer(b"".join(lists), np.int64)
        codes, members = np.unique(flat, return_inverse=True)
        counts = np.bincount(members, np.repeat(self.uses, lengths), len(codes)).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        return (self.number, None, None, None, None, None, None, codes, counts, starts.astype(np.int32), members.astype(np.int32))


def first_pass(batches: Iterator[pa.RecordBatch], first: str, second: str) -> Iterator[pa.RecordBatch]:
    import gc

    from pyspark import TaskContext

    aligner = worker_cache(f"align:{first}:{second}", lambda: Aligner(first, second))

    def numbers():
        n = TaskContext.get().partitionId() << 24
        while True:
            yield n
            n += 1

    number = numbers()

    def some(batch):
        """Rows of a batch in groups of bounded text."""
        ids, texts, held, at = batch.column(0).to_pylist(), batch.column(1), 0, 0
        for i in range(len(ids)):
            held += texts[i].as_buffer().size
            if held >= BATCH_DOCS_BYTES:
                yield ids[at:i + 1], texts.slice(at, i + 1 - at).to_pylist(), held
                at, held = i + 1, 0
        if at < len(ids):
            yield ids[at:], texts.slice(at).to_pylist(), held

    def rows():
        chunk = Chunk(next(number))
        for batch in batches:
            for ids, texts, held in some(batch):
                split = [aligner.split(t) if t else [] for t in texts]
                chunk.learn(split, aligner)
                index, entries, used = chunk.index, chunk.entries, []
                for doc, stretches in zip(ids, split):
                    at = list(map(index.__getitem__, stretches))
                    own = list(map(entries.__getitem__, at))
                    if not own or not chunk.all_fit and None in own:
                        yield (chunk.number, doc, 0, 0, 0, "", [], None, None, None, None)
                        continue
                    used.append(at)
                    n_a, n_b, n_groups, shown, _ = zip(*own)
                    yield (chunk.number, doc, sum(n_a), sum(n_b), sum(n_groups), hex_sha256(";".join(shown).encode()), at, None, None, None, None)
                chunk.use(chain.from_iterable(used))
                chunk.bytes += held
                if chunk.bytes >= CHUNK_BYTES or len(chunk.entries) >= CHUNK_STRETCHES:
                    yield chunk.dictionary()
                    chunk = Chunk(next(number))
        if chunk.entries:
            yield chunk.dictionary()

    collects = gc.isenabled()
    gc.disable()  # the many small tuples held here form no cycles, and walking them all took a sixth of the time
    try:
        yield from in_batches(rows(), FIRST, size_of=lambda r: 4 * len(r[6]) if r[6] is not None else 20 * len(r[7]) + 8 * len(r[9]))
    finally:
        if collects:
            gc.enable()


RESULT = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])
RESULT_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def gather(docs: pa.Table, marks: pa.Table) -> pa.Table:
    """Documents of a chunk with the sums of their stretches' pairs."""
    is_dictionary = docs.column("codes").is_valid().to_numpy()
    n_best = count_sum = np.zeros(1, np.int64)
    for at in np.flatnonzero(is_dictionary):
        starts, members = (np.asarray(docs.column(c)[int(at)].values) for c in ("starts", "members"))
        place = marks.column("pair").to_numpy()
        per_pair = {c: np.zeros(len(place), np.int64) for c in ("total", "best")}
        for c, values in per_pair.items():
            values[place] = marks.column(c).to_numpy()
        added = [np.concatenate([[0], np.cumsum(per_pair[c][members])]) for c in ("best", "total")]
        n_best, count_sum = (x[starts[1:]] - x[starts[:-1]] for x in added)
    rows = docs.filter(pa.array(~is_dictionary))
    sums = []
    for stretches in rows.column("stretches"):
        used = np.asarray(stretches.values)
        sums.append((int(n_best[used].sum()), int(count_sum[used].sum())) if len(used) else (0, 0))
    best, total = zip(*sums) if sums else ((), ())
    return pa.Table.from_arrays([*(rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")), rows.column("n_groups"),
                                 pa.array(best, pa.int64()), pa.array(total, pa.int64()), rows.column("groups_sha256")], schema=RESULT)


def pair_counts(first: DataFrame) -> DataFrame:
    """(code, total, b) of every id pair: its links in the corpus and its second id."""
    used = first.where("codes is not null").select("chunk", F.posexplode(F.arrays_zip("codes", "counts")).alias("pair", "x"))
    totals = used.groupBy(F.col("x.codes").alias("code")).agg(F.sum("x.counts").alias("total"))
    return totals.withColumn("b", F.col("code").bitwiseAND(F.lit((1 << 32) - 1)))


def align(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """Per document the numbers of tokens, groups and links, the links whose
    pair is the most frequent of its second id, the sum of the links' corpus
    counts, and a digest of the groups. ``first`` is a byte-level BPE file of
    the tokenizers library, ``second`` a sentencepiece model that adds a blank.
    """
    import public_tokenizers

    first = first or public_tokenizers.path("byte_bpe_50k.json")
    second = second or public_tokenizers.path("piece_bpe_32k.model")
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    passed = stored(rows.mapInArrow(lambda batches: first_pass(batches, first, second), FIRST_DDL))
    totals = pair_counts(passed)
    # one row per id of the second vocabulary
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    used = (passed.where("codes is not null")
            .select(F.col("chunk").alias("of_chunk"), F.posexplode("codes").alias("pair", "code")))
    marks = (used.join(totals, "code").join(F.broadcast(highest), "b")
             .select("of_chunk", "pair", "total", (F.col("total") == F.col("highest")).cast("long").alias("best")))
    return (passed.groupBy("chunk").cogroup(marks.groupBy("of_chunk")).applyInArrow(lambda d, m: gather(d, m), RESULT_DDL))
