"""Byte-level BPE by speculation and verification.

A greedy longest match proposes the tokens of a word. A proposal is the BPE
result exactly when every token is its own encoding and every adjacent pair
of tokens encodes to just that pair, so all adjacent pairs of all new words
of a batch are tested at once against the pairs whose answer is known
(a sorted array); unknown pairs are decided once by merging their bytes
exactly. Only words with a failing pair are merged from bytes.

Words are the tokenizer's own pieces (contractions, letters, digits, other
characters, white space). A blank or newline after another character always
starts a new piece, so texts are cut there first and equal stretches share
their result within a worker.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_alphabet, hex_sha256, prepare, text_of, worker_cache

MAX_CACHED = 400_000
MAX_PAIRS = 4_000_000
LONG_PIECE = 2000  # bytes


def settled_characters() -> str:
    """Ranges, for a character class, of the characters assigned since Unicode
    3.2 whose kind (letter, number, white space, other) is the same today, so
    that no two libraries differ on them."""
    from unicodedata import category, ucd_3_2_0

    def kind(c):
        c = c[0] if c[0] in "LNZ" else "other" if c != "Cn" else None
        return c

    ranges, start = [], None
    for i in range(0x30000):  # beyond, nothing was assigned then
        c = chr(i)
        old = ucd_3_2_0.category(c)
        same = old not in ("Cn", "Cs", "Co") and kind(old) == kind(category(c))
        if same and start is None:
            start = i
        elif not same and start is not None:
            ranges.append((start, i - 1))
            start = None
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


class SpeculativeBPE:
    """Encoder and decoder for a byte-level BPE file without prefix space."""

    # fixed pattern of byte-level pre-tokenisation
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import json
        import re

        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        vocab = spec["model"]["vocab"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        self.ids = {b: i for i, b in enumerate(self.token_bytes) if b}
        self.longest = max(map(len, self.ids))
        self.size = size
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.special.items():
            self.token_bytes[i] = text.encode()
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            self.ranks[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.byte_ids = [self.ids[bytes([b])] for b in range(256)]
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pieces = regex.compile(self.PATTERN).findall
        self.unsettled = re.compile(f"[^{settled_characters()}]").search
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.stretches = re.compile(r"[ \n]*[^ \n]+|[ \n]+").findall
        self.odd_space = re.compile(r"[^\S \n]").search
        self.stretch_ids: dict[str, bytes] = {}
        self.word_ids: dict[str, bytes] = {}
        self.pair_codes = np.empty(0, np.int64)  # sorted, with their answers
        self.pair_fits = np.empty(0, bool)
        self.decimal = [str(i) for i in range(size)]

    # -- exact merging ------------------------------------------------------

    def merge(self, data: bytes) -> list[int]:
        """The merges of the file applied in order of rank, leftmost first.

        Tokens are a linked list, possible merges a heap, so a piece of any
        length takes n log n steps.
        """
        ids = [self.byte_ids[b] for b in data]
        n, ranks = len(ids), self.ranks
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            found = ranks.get((ids[i], ids[i + 1]))
            if found is not None:
                heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapify(heap)
        while heap:
            _, i, left, right, joined = heappop(heap)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue  # one of the two has been merged since
            ids[i], ids[j] = joined, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = ranks.get((joined, ids[k]))
                if found is not None:
                    heappush(heap, (found[0], i, joined, ids[k], found[1]))
            h = before[i]
            if h >= 0:
                found = ranks.get((ids[h], joined))
                if found is not None:
                    heappush(heap, (found[0], h, ids[h], joined, found[1]))
        return [t for t in ids if t >= 0]

    # -- speculation --------------------------------------------------------

    def propose(self, data: bytes) -> list[int]:
        """Greedy longest match from the left."""
        whole = self.ids.get(data)
        if whole is not None:
            return [whole]
        out, at, n, ids = [], 0, len(data), self.ids
        while at < n:
            end = min(n, at + self.longest)
            while True:
                token = ids.get(data[at:end])
                if token is not None:
                    break
                end -= 1
            out.append(token)
            at = end
        return out

    def fits(self, codes: np.ndarray) -> np.ndarray:
        """For each code left * size + right (or -1 - token for a single token): does it encode to itself?"""
        wanted = np.unique(codes)
        at = np.searchsorted(self.pair_codes, wanted)
        known = np.zeros(len(wanted), bool)
        inside = at < len(self.pair_codes)
        known[inside] = self.pair_codes[at[inside]] == wanted[inside]
        new = wanted[~known]
        if len(new):
            answers = np.fromiter((self._decide(int(c)) for c in new), bool, len(new))
            all_codes = np.concatenate([self.pair_codes, new])
            order = np.argsort(all_codes, kind="stable")
            self.pair_codes = all_codes[order]
            self.pair_fits = np.concatenate([self.pair_fits, answers])[order]
        return self.pair_fits[np.searchsorted(self.pair_codes, codes)]

    def _decide(self, code: int) -> bool:
        tokens = [-1 - code] if code < 0 else list(divmod(code, self.size))
        return self.merge(b"".join(self.token_bytes[t] for t in tokens)) == tokens

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (uint32 bytes) of distinct pieces: propose all, verify all pairs at once, merge what failed."""
        data = [w.encode() for w in words]
        # a proposal of hundreds of tokens fails somewhere: such pieces are merged at once
        proposals = [self.propose(d) if len(d) <= LONG_PIECE else self.merge(d) for d in data]
        lengths = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((t for p in proposals for t in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(proposals)), lengths)
        bad = np.zeros(len(proposals), bool)
        settled = np.fromiter((len(d) > LONG_PIECE for d in data), bool, len(data))
        flat, owner = flat[~settled[owner]], owner[~settled[owner]]
        bad[owner[~self.fits(-1 - flat)]] = True
        inner = owner[:-1] == owner[1:]
        pairs = (flat[:-1] * self.size + flat[1:])[inner]
        if len(pairs):
            bad[owner[:-1][inner][~self.fits(pairs)]] = True
        for i in np.flatnonzero(bad):
            proposals[i] = self.merge(data[i])
        return [array("I", p).tobytes() for p in proposals]

    # -- texts ----------------------------------------------------------------

    def library_pieces(self, stretch: str) -> list[str]:
        """The library's own pieces, for characters that Unicode versions class differently."""
        return [stretch[a:b] for _, (a, b) in self.library.pre_tokenize_str(stretch)]

    def _learn(self, new: list[str]) -> None:
        """Ids of stretches that were not seen before."""
        split = [self.library_pieces(s) if self.unsettled(s) else self.pieces(s) for s in new]
        words = list({w for p in split for w in p}.difference(self.word_ids))
        self.word_ids.update(zip(words, self.encode_words(words)))
        for s, p in zip(new, split):
            self.stretch_ids[s] = b"".join(map(self.word_ids.__getitem__, p))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as uint32 arrays."""
        if len(self.stretch_ids) > MAX_CACHED:
            self.stretch_ids.clear()
            self.word_ids.clear()
        if len(self.pair_codes) > MAX_PAIRS:
            self.pair_codes, self.pair_fits = self.pair_codes[:0], self.pair_fits[:0]
        cut_texts = []
        for text in texts:
            parts = []
            for part in self.cut.split(text) if self.cut and "<|" in text else [text]:
                if part in self.special:
                    parts.append(self.special[part])
                elif part:
                    parts.append([part] if self.odd_space(part) else self.stretches(part))
            cut_texts.append(parts)
        new = {s for parts in cut_texts for p in parts if isinstance(p, list) for s in p}.difference(self.stretch_ids)
        if new:
            self._learn(list(new))
        out = []
        for parts in cut_texts:
            ids = b"".join(array("I", [p]).tobytes() if isinstance(p, int) else b"".join(map(self.stretch_ids.__getitem__, p)) for p in parts)
            out.append(np.frombuffer(ids, np.uint32))
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def encoder(path: str) -> SpeculativeBPE:
    return worker_cache(f"bpe:{path}", lambda: SpeculativeBPE(path))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array<int>) of every text. A null text is empty and has
    no ids; null and repeated doc_ids pass through; other columns are not read."""
    path = path or default_path()
    prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            ids = bpe.encode(batch.column(1).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate([*ids, np.empty(0, np.uint32)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(task, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows with ids (null ids: null text)."""
    path = path or default_path()
    prepare(encoded.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            texts = [None if ids is None else bpe.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema=schema)

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(task, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them, in one pass."""
    path = path or default_path()
    prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            counts, ids_digest, text_digest = [], [], []
            for ids in bpe.encode(batch.column(1).to_pylist()):
                ids = ids.tolist()
                counts.append(len(ids))
                ids_digest.append(hex_sha256(",".join(map(bpe.decimal.__getitem__, ids)).encode()))
                text_digest.append(hex_sha256(bpe.decode(ids).encode()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digest), pa.array(text_digest)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(task, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
