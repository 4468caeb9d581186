"""Harmonic packing of token sequences.

A document's ids are cut into pieces, every piece belongs to the class k of
its length (k pieces of the class fit one sequence: capacity // length) and a
class's bins are filled with exactly k pieces. Each task packs its own
documents, so nothing is shuffled and a hot source or a very long document
changes nothing. Cutting is free, so the cuts go where classes waste nothing:
full sequences first (class 1), then capacity/2, /4, /8 and /16 (classes 2 to
16, whose bins fill to the last token), and a tail shorter than capacity/16,
whose class is capacity // length. At the end of a task the pieces of bins
that did not fill are strung together: full sequences, then sequences whose
lengths are powers of two, which need no padding.

Ids come from the named tokenizer file. Words repeat, so each distinct word
is encoded once for every worker; words of plain Latin letters, digits and
punctuation go through the file's own merges as byte ranks, any other word
through the tokenizers library itself (the same ids, see the tests).
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_alphabet, in_batches, prepare, text_of, worker_cache

CAPACITY = 2048
END_ID = 1
TAIL_CLASS = 16  # shorter pieces than capacity / 16 are tails
MAX_CACHED = 400_000

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
PIECES_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                          ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


class WordEncoder:
    """Ids of a word-end BPE file (lower case, white space dropped) as little-endian uint32 bytes."""

    # fixed pattern of the tokenizer file, for the letters of SAFE in lower case
    PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
    SAFE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    # white space that str.split and the tokenizer may see differently
    # fixed code points
    ODD_SPACE = re.compile("[%s]" % "".join(map(chr, [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])))
    WORD_END = b"\xff"  # never a byte of UTF-8

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, suffix = byte_alphabet(), model["end_of_word_suffix"]

        def as_bytes(token: str) -> bytes:
            end = token.endswith(suffix)
            return bytes(letters[c] for c in (token[: -len(suffix)] if end else token)) + (self.WORD_END if end else b"")

        # single bytes, then the join of a last byte with its word end (always first), then the merges in order
        order = [bytes([b]) for b in range(256)] + [bytes([b]) + self.WORD_END for b in range(255)]
        order += [as_bytes("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        ranks = {token: rank for rank, token in enumerate(dict.fromkeys(order))}
        self.id_of = [-1] * len(ranks)
        for token, i in model["vocab"].items():
            rank = ranks.get(as_bytes(token))
            if rank is not None:
                self.id_of[rank] = i
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words; they also join the cache, which starts anew when it is full."""
        if len(self.words) + len(words) > MAX_CACHED:
            self.words.clear()
        if len(self.pieces) > MAX_CACHED:
            self.pieces.clear()
        found: dict[str, bytes] = {}
        other = []
        for word in words:
            if "<|" in word or not self.SAFE.fullmatch(word):
                other.append(word)
                continue
            parts = []
            for piece in self.PIECE.findall(word.lower()):
                ids = self.pieces.get(piece)
                if ids is None:
                    ids = array("I", [self.id_of[r] for r in self.merge(piece.encode() + self.WORD_END)]).tobytes()
                    self.pieces[piece] = ids
                parts.append(ids)
            found[word] = b"".join(parts)
        if other:
            for word, encoded in zip(other, self.tokenizer.encode_batch(other, add_special_tokens=False)):
                found[word] = array("I", encoded.ids).tobytes()
        if len(found) <= MAX_CACHED:
            self.words.update(found)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = []
        for text in texts:
            if self.ODD_SPACE.search(text):
                out.append(array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes())
                continue
            words = text.split()
            distinct = set(words)
            missing = distinct.difference(self.words)
            known = self.words
            if missing:
                known = {w: self.words[w] for w in distinct.difference(missing)}  # the cache may be emptied
                known.update(self._learn(missing))
            out.append(b"".join(map(known.__getitem__, words)))
        return out


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of a document's pieces in order: full ones, halves down to capacity/16, a tail."""
    out = [capacity] * (n // capacity)
    rest, size = n % capacity, capacity // 2
    while size * TAIL_CLASS >= capacity:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out + [rest] * (rest > 0)


class HarmonicPacker:
    """Bins of one task. A piece is [doc_id, start, ids, doc_tokens]; placed pieces get a sequence and an offset."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY):
        self.next, self.capacity, self.open = first_sequence, capacity, {}

    def add(self, doc, start: int, ids: bytes, total: int) -> Iterator[tuple]:
        k = self.capacity // (len(ids) // 4)
        bin_ = self.open.setdefault(k, [])
        bin_.append((doc, start, ids, total))
        if len(bin_) == k:
            yield from self._close(self.open.pop(k))

    def _close(self, pieces) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            yield doc, start, n, ids, total, self.next, offset
            offset += n
        self.next += 1

    def finish(self) -> Iterator[tuple]:
        """String together what is left; the last tokens go to sequences of power-of-two lengths."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        tokens = sum(len(p[2]) // 4 for p in left)
        sizes = [self.capacity] * (tokens // self.capacity)
        rest = tokens % self.capacity
        sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        at = 0
        for size in sizes:
            members, room = [], size
            while room:
                doc, start, ids, total = left[at]
                take = min(room, len(ids) // 4)
                members.append((doc, start, ids[: 4 * take], total))
                if 4 * take == len(ids):
                    at += 1
                else:
                    left[at] = (doc, start + take, ids[4 * take :], total)
                room -= take
            yield from self._close(members)


def pack_task(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    encoder = worker_cache(f"words:{path}", lambda: WordEncoder(path))
    packer = HarmonicPacker(TaskContext.get().partitionId() << 40, capacity)
    end = array("I", [end_id]).tobytes()

    def rows():
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, ids in zip(docs, encoder.encode(texts)):
                ids += end
                total, start = len(ids) // 4, 0
                for n in cut_lengths(total, capacity):
                    yield from packer.add(doc, start, ids[4 * start : 4 * (start + n)], total)
                    start += n
        yield from packer.finish()

    yield from in_batches(rows(), PIECES_ARROW, size_of=lambda r: len(r[3]))


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): where it starts, its ids
    (little-endian uint32), its sequence and its offset there.

    ``capacity`` must be a power of two of at least 16. A null text is empty
    (its only id is the end id), null and repeated doc_ids keep their own
    pieces, other columns are not read. ``sequence_id`` is unique over the
    result and not dense. An empty table gives no pieces.
    """
    if capacity < TAIL_CLASS or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two of at least 16")
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(lambda b: pack_task(b, tokenizer_path, capacity, end_id), PIECES)


def with_checksum(pieces: DataFrame) -> DataFrame:
    """Pieces with the crc32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
