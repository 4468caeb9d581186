"""Prefix trie, secret scan and token alignment against brute force and round trips."""

import base64
import bz2
import collections
import gzip
import hashlib
import lzma
import random
import re
import time
import urllib.parse
import zlib

import pytest

from boxscore.llm import prefix_trie, secret_scan, token_alignment
from boxscore.llm.common import byte_alphabet

TURNS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, sha(f"{len(role)}:{role}:{text}"), role, text))
    turns = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    members = collections.defaultdict(list)
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = turns.get(base, [])[:h] + turns[c][h:]
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += not children[k]
    return [(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
             sha(",".join(map(str, sorted(c for c in m if len(built[c]) == len(k))))))
            for k, m in members.items()]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(1)
    rows = []
    for c in range(-7, 45):
        if c % 10 == 5 and c % 3:  # some first conversations of a block are absent
            continue
        for t in range(rng.choice([1, 2, 3, 12])):
            rows.append((c, rng.choice([t, t, None, 0]), rng.choice(["user", "bot", None]), rng.choice(["a", "b", "é", None, "long text"])))
    rows += [(100 + i, t, "u", f"same{t}") for i in range(40) for t in range(3)]  # frequent conversation
    rows += [(None, 1, "x", "y")] + [(7777, 1, "u", "dup")] * 3
    return rows + [(500 + i, t, "u", f"t{t % 7}") for i, n in enumerate((95, 60)) for t in range(n)]  # longer than a stretch below


@pytest.mark.parametrize("stretch", [4096, 10])
def test_trie(spark, turns, stretch, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", stretch)
    df = spark.createDataFrame([(*r, "extra") for r in turns], TURNS + ", depth string").repartition(7)
    assert ordered(prefix_trie.trie(df).collect()) == ordered(brute_trie(turns))


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "u", "x")], TURNS)).count() == 0


def test_trie_turnless(spark):
    # a conversation that borrows from an absent one and is shorter than its own skipped turns: only the root
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    got = prefix_trie.trie(spark.createDataFrame([(c, 0, "u", "x")], TURNS)).collect()
    assert ordered(got) == [(c, 0, None, 1, 0, 1, 0, sha(str(c)))]


def test_spilling_queue():
    rng = random.Random(3)
    queue, want = prefix_trie.SpillingQueue(limit=10), collections.Counter()
    messages = [(-rng.randrange(4), rng.randrange(5), rng.randrange(5), 1, rng.randrange(100)) for _ in range(500)]
    for m in messages:
        queue.push(m)
        want[m[:3]] += m[4]
    assert queue.spills > 10
    for key in sorted(want):
        assert queue.take(key)[1] == want[key]
    assert queue.take((9, 9, 9)) == (0, 0)


# -- secrets ------------------------------------------------------------------

SECRET = 'password = "hunter2hunter2'
VALUE = SECRET + '"'


def texts_of(text):
    base, spans, layers, closed = secret_scan.secrets(text)
    return [text[a:b] for a, _, b in base], [text[a:b] for a, k, b in spans if (a, k, b) not in base]


def test_base_spans_as_stated():
    rng = random.Random(5)
    pieces = ["token", "Secret", "api_key", "APIKEY", "toKen", " ", "  ", "=", ":", '"', "'", "abcdefgh", "x", "AKIA", "ABCDEFGHIJKL", "0123456789abcdef", "é", "\n", "."]
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(20)))
        want = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 8]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
        base, spans, _, _ = secret_scan.secrets(text)
        assert base == sorted(want) and set(base) <= set(spans)


def b64(data):
    return base64.b64encode(data).decode()


def zstd(data):
    import zstandard

    return zstandard.ZstdCompressor().compress(data)


@pytest.mark.parametrize("wrap", [
    lambda s: urllib.parse.quote(s), lambda s: urllib.parse.quote(urllib.parse.quote(s, safe="")),
    lambda s: "".join(f"\\u{ord(c):04x}" for c in s), lambda s: "".join(f"&#{ord(c)};" for c in s), lambda s: "".join(f"\\x{ord(c):02x}" for c in s),
    lambda s: b64(s.encode()), lambda s: b64(b64(s.encode()).encode()), lambda s: b64(s.encode()).replace("+", "-").rstrip("="),
    *(lambda s, f=f: b64(f(s.encode())) for f in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstd)),
    lambda s: urllib.parse.quote(b64(gzip.compress(urllib.parse.quote(s).encode())), safe=""),
    lambda s: b64("".join(f"\\u{ord(c):04x}" for c in s).encode()),
    lambda s: base64.encodebytes(("no secret here, " * 20 + s + " and more" * 9).encode()).decode()])
def test_wrapped_secrets(wrap):
    inner = wrap(VALUE)
    text = f"é before {inner} after"
    base, added = texts_of(text)
    assert not base and len(added) == 1 and added[0] in inner


def test_spans_map_to_what_decodes_to_them():
    text = "x %70assword%20%3D%20hunter2%68unter2 y " + "".join(f"\\u{ord(c):04x}" for c in "token:abcdefghi") + " z"
    assert texts_of(text) == ([], ["%70assword%20%3D%20hunter2%68unter2", "".join(f"\\u{ord(c):04x}" for c in "token:abcdefghi")])
    blob = b64(b"some words, then token=abcdefgh1 and others")
    (found,) = texts_of("k " + blob + " k")[1]
    low, high = blob.index(found), blob.index(found) + len(found)
    assert b"token=abcdefgh1" in base64.b64decode(blob[low // 4 * 4:-(-high // 4) * 4]) and len(found) < len(blob) - 20


def test_cycles_and_bombs_end():
    assert secret_scan.secrets(b64(gzip.compress(b"a" * (100 << 20))))[3] == 1
    for text in ("%" + "25" * 100_000 + "41", "%41" * 100_000, "0123456789abcdef" * 30_000, "token " * 100_000, "A1b2" * 100_000, "%%%&&&\\\\", ""):
        t0 = time.monotonic()
        secret_scan.secrets(text)
        assert time.monotonic() - t0 < 10


def test_secret_rows(spark):
    rows = [(1, VALUE), (1, VALUE), (None, "token=abcdefgh"), (2, None), (3, ""), (4, "AKIA" + "A" * 12 + " " + "ab" * 16)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, spans string")
    got = sorted(secret_scan.find(df).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"]))
    assert [(r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"]) for r in got] == [(None, 1, 0, 0), (1, 1, 0, 0), (1, 1, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0), (4, 0, 1, 1)]
    assert got[1]["spans"] == f"assign:0:{len(SECRET)}" and got[1]["base_sha256"] == sha(f"assign:0:{len(SECRET)}")
    assert got[3]["base_sha256"] == sha("") and got[3]["spans"] == ""
    assert [r["text"] for r in secret_scan.redact(df).where("doc_id = 1 or doc_id = 2").collect()] == ['<assign>"', '<assign>"', None]
    assert secret_scan.find(df.where("false")).count() == 0


# -- token alignment ------------------------------------------------------------

def brute_alignment(texts):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    letters = byte_alphabet()
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def ends(ids, data):
        at, out = 0, {}
        for n, i in enumerate(ids):
            at += len(data(i))
            out[at] = n
        return out

    found, counts = [], collections.Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        x, y = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        if not text or b"".join(map(a_bytes.get, x)) != whole or b"".join(map(b_bytes, y)) != whole:
            found.append(None)
            continue
        x_ends, y_ends = ends(x, a_bytes.get), ends(y, b_bytes)
        links, groups, i, j = [], [], 0, 0
        for e in sorted(x_ends.keys() & y_ends.keys()):
            links.append((x[x_ends[e]], y[y_ends[e]]))
            groups.append(",".join(map(str, x[i:x_ends[e] + 1])) + "|" + ",".join(map(str, y[j:y_ends[e] + 1])))
            i, j = x_ends[e] + 1, y_ends[e] + 1
        counts.update(links)
        found.append((len(x), len(y), links, groups))
    best = collections.Counter()
    for (_, second), n in counts.items():
        best[second] = max(best[second], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (f[0], f[1], len(f[3]), len(f[2]), sum(counts[p] == best[p[1]] for p in f[2]), sum(counts[p] for p in f[2]), sha(";".join(f[3]))) for f in found]


def test_alignment(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNK_STRETCHES", 40)
    monkeypatch.setattr(token_alignment, "BATCH_DOCS_BYTES", 2000)
    rng = random.Random(7)
    odd = ["Hello wörld 日本語 𐍈 a▁b  x\n y\x00z ࢏", " lead", "trail ", "<0x41> <s> <|endoftext|> [UNK]", "", " ", "  ", "\n", "日本語 " * 50, "x" * 20_000,
           "é" * 300 + " ½ 🙂👍🏽 \x85 \x1c a\x1c b \xa0 c", None, "a▁b", "\r\n {\r\n}\r", "é áé", "1 2 3,4.5 12345 don't I'll"]
    odd += ["".join(rng.choice(["a", "é", "語", " ", "  ", "\n", "🙂", "der ", "tion", ".", "​", "\xa0", "7"]) for _ in range(rng.randrange(60))) for _ in range(150)]
    rows = [(None if i == 9 else i, t) for i, t in enumerate(odd)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, chunk string").repartition(5)
    got = {r["doc_id"]: tuple(r)[1:] for r in token_alignment.align(df).collect()}
    assert got == dict(zip([i for i, _ in rows], brute_alignment(odd)))


def test_alignment_of_nothing(spark):
    schema = "doc_id long, text string"
    assert token_alignment.align(spark.createDataFrame([], schema)).count() == 0
    assert [tuple(r) for r in token_alignment.align(spark.createDataFrame([(1, None), (1, "")], schema)).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")] * 2


def test_units_are_encoded_in_runs(monkeypatch):
    """Each library sees few texts, and a unit's alignment does not depend on its neighbours."""
    import public_tokenizers

    paths = [public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    aligner = token_alignment.Aligner(*paths)
    rng = random.Random(11)
    units = list({" " + "".join(rng.choice(["on", "th", "é", "語", "s", "###", "'s", "7"]) for _ in range(rng.randrange(1, 8))) for _ in range(640)})
    odd = [" a▁b", " \u200b", "語", "###", "  two", " end ", " " + "x" * 500, " \u1680a", " a\x1c"]
    seen, encode = [], aligner.b.encode
    with monkeypatch.context() as m:
        m.setattr(aligner.b, "encode", lambda texts, **k: seen.append(len(texts)) or encode(texts, **k), raising=False)
        plain = aligner.align(units)
    assert sum(seen) <= len(units) / 20
    mixed = units[:100] + odd + units[100:]
    rng.shuffle(mixed)
    alone = [aligner.align([u])[0] for u in mixed]
    assert aligner.align(mixed) == alone and None in alone and plain == [dict(zip(mixed, alone))[u] for u in units]
