"""Operators on documents against brute force, on a fixture of awkward rows."""

import collections
import hashlib
import math
import re
import zlib

import pytest

from boxscore.llm import bpe, exact_dedup, language_model, packing, pii, quality, simhash_pivots, substring_dedup, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def passage(seed, n, words=("ann", "bee", "Cee", "dé", "eff", "gee", "haa")):
    x, out = seed, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(words[x // 65536 % len(words)] + str(x // 7 % 90))
    return " ".join(out)


@pytest.fixture(scope="module")
def rows():
    shared = passage(5, 60)
    texts = [None, "", "   \n\t ", "one", "one two", "one  two", "one\ntwo", passage(1, 80), passage(1, 80), passage(1, 80) + " tail",
             passage(2, 30) + " " + shared + " " + passage(3, 30), shared, passage(4, 10) + " " + shared, "x" * 50_000, passage(9, 20_000),
             "spam " * 300, "line a b\nline a b\n\nline a b", "Mail a.b@c.example.com or +1 (523) 555-1219 4795326016703902, 1.2.3.4 and 1.2.3.400.",
             "日本語 テキスト ½ é 🙂 <|endoftext|> don't", "#### $$$ %%% &&& ***", "A\x1cB\x85C\xa0D E"]
    out = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    return out + [(None, "one two", "en", "s0", 7), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    # an extra column whose name clashes with one an operator adds
    return spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA + ", kept string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def test_exact_groups(docs, rows):
    got = exact_dedup.exact_groups(docs, spill_bytes=20_000).collect()
    assert len(got) == len(rows)
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[SPACE.sub(" ", t or "")].append(i)
    for r in got:
        t = SPACE.sub(" ", r["text"] or "")
        ids = [i for i in groups[t] if i is not None]
        assert (r["keep_id"], r["group_size"]) == (min(ids, default=None), len(groups[t]))
        assert r["kept"] == (r["doc_id"] == r["keep_id"])
        assert r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert {r["kept"] for r in kept.collect()} == {"extra"}


def test_exact_repeated_rows(spark, empty):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "a"), (1, "b"), (None, "c"), (None, "c")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in exact_dedup.dedup(df).collect()) == [(0, "c"), (1, "a"), (1, "b")]
    assert exact_dedup.exact_groups(empty).count() == 0


def test_patricia_trie_spills_and_splits():
    trie = exact_dedup.PatriciaTrie()
    keys = [b"abc", b"abd", b"ab", b"abcd", b"x", b"abc"]
    for n, k in enumerate(keys):
        trie.insert(k, (0, n, n, 1, 1))
    spilled = dict(trie.spill_largest())
    assert spilled[b"abc"] == (0, 0, 0, 2, 1) and set(spilled) == {b"ab", b"abc", b"abd", b"abcd"}
    assert [k for k, _ in trie.drain()] == [b"x"]


def brute_fingerprint(t):
    import xxhash

    w = WORD.findall(lower(t))
    if not w:
        return 0
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def linked(fps):
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_groups(docs, rows, empty):
    got = by_id(simhash_pivots.near_groups(docs))
    fps = {i: brute_fingerprint(t) for i, t, *_ in rows if i is not None}
    assert {i: r["fp"] % 2**64 for i, r in got.items()} == fps
    assert {i: r["component_id"] for i, r in got.items()} == linked(fps)
    assert simhash_pivots.near_groups(empty).count() == 0
    assert simhash_pivots.dedup(docs).columns == docs.columns


@pytest.mark.parametrize("heavy", [3, 1024])
def test_near_links_of_a_dense_ball(spark, monkeypatch, heavy):
    """Chains and clusters of fingerprints, through buckets and through centres."""
    import random

    rng = random.Random(1)
    fps, x = [], rng.getrandbits(64)
    for _ in range(60):
        fps += [x, x ^ (1 << rng.randrange(64)), x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))]
        x = x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) if rng.random() < 0.6 else rng.getrandbits(64)
    table = spark.createDataFrame([(i, f if f < 2**63 else f - 2**64) for i, f in enumerate(fps)], "doc_id long, fp long")
    monkeypatch.setattr(simhash_pivots, "fingerprints", lambda d, s: table)
    texts = spark.createDataFrame([(0, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash_pivots.near_groups(texts, heavy=heavy).collect()}
    assert got == linked(dict(enumerate(fps)))


def test_near_dedup_keeps_one_row_of_a_repeated_id(spark):
    df = spark.createDataFrame([(1, "a b c d", "p"), (1, "a b c d", "q"), (2, "a b c d", "r"), (3, "w x y z", "s")], "doc_id long, text string, _gone string")
    assert sorted(r["doc_id"] for r in simhash_pivots.dedup(df).collect()) == [1, 3]


def test_packing(docs, rows, empty):
    import numpy as np
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = packing.with_checksum(packing.pack(docs)).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for i, t, *_ in rows:
        if i is None:
            continue
        ids, at = tokenizer.encode(t or "", add_special_tokens=False).ids + [1], 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            part = ids[at:at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(part, "<u4").tobytes()))
            at += r["length"]
        assert at == len(ids)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert packing.pack(empty).count() == 0


def test_packing_classes_waste_little():
    packer, size, used = packing.HarmonicPacker(0), collections.Counter(), 0
    for doc in range(3000):
        n, start = 1 + doc * 7919 % 3000, 0
        for length in packing.cut_lengths(n):
            for r in packer.add(doc, start, b"\0" * 4 * length, n):
                size[r[5]] += r[2]
            start += length
        used += n
    for r in packer.finish():
        size[r[5]] += r[2]
    padding = sum(2048 - s for s in size.values() if s & (s - 1))
    assert sum(size.values()) == used and padding < 0.005 * used
    with pytest.raises(ValueError):
        packing.pack(None, capacity=1000)


def test_bpe_round_trip(docs, rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.default_path())
    ids = by_id(bpe.encode_documents(docs))
    texts = by_id(bpe.decode_documents(bpe.encode_documents(docs)))
    digests = by_id(bpe.round_trip(docs))
    for i, t, *_ in rows:
        if i is None:
            continue
        want = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert ids[i]["ids"] == want and texts[i]["text"] == (t or "")
        assert digests[i]["n_tokens"] == len(want)
        assert digests[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.round_trip(empty).count() == 0


def test_bpe_verification_finds_wrong_proposals():
    model = bpe.SpeculativeBPE(bpe.default_path())
    words = [" ththes", " unhappiness", "aaaaaaa", " erererer"] + [" " + passage(s, 1) for s in range(40)]
    assert any(model.propose(w.encode()) != model.merge(w.encode()) for w in words)
    import numpy as np
    assert [np.frombuffer(x, np.uint32).tolist() for x in model.encode_words(words)] == [model.merge(w.encode()) for w in words]


def test_pii_base_and_additions(docs, rows, empty):
    crf = pii.SemiCRF().fit(["mail x.y@mail1.example.com", "+1 (319) 555-5132", "4425414259157784", "27.109.211.155", "Version 2.0.", "CC 4.0", "in 2019"] * 40)
    got = by_id(pii.find(docs, crf))
    patterns = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}
    fits = {"email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")), "card": pii.is_card, "phone": pii.is_phone}
    for i, t, *_ in rows:
        if i is None:
            continue
        base = [(k, m.start(), m.end()) for k, p in patterns.items() for m in p.finditer(t or "") if fits[k](m.group())]
        assert [got[i][f"n_{k}"] for k in patterns] == [sum(b[0] == k for b in base) for k in patterns]
        assert got[i]["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(pii.joined(base).split(",")) - {""} <= set(got[i]["spans"].split(","))
    # the greedy phone pattern swallows the card; the model finds both
    kinds = [s.split(":")[0] for s in got[17]["spans"].split(",")]
    assert kinds.count("phone") == 1 and kinds.count("card") == 1 and got[17]["n_phone"] == got[17]["n_card"] == 0
    assert pii.find(empty, crf).count() == 0
    red = {r["doc_id"]: r for r in pii.redact(docs, crf).collect()}
    assert "[EMAIL]" in red[17]["text"] and "555-1219" not in red[17]["text"] and red[17]["n_chars"] == len(red[17]["text"])
    assert red[7]["text"] == rows[7][1] and red[0]["text"] is None


def test_pii_linear_on_long_runs():
    for text in ("x" * 300_000, "1" * 300_000, "a." * 100_000 + "@", "+1" * 50_000, "1." * 100_000):
        pii.base_spans(text)
    assert pii.base_spans("a@b.c@d.e 1.2.3.4.5.6.7.8") == [("email", 0, 5), ("ip", 10, 17), ("ip", 18, 25)]


def test_quality(docs, rows, empty):
    got = by_id(quality.quality(docs))
    for i, t, *_ in rows:
        if i is None:
            continue
        t = t or ""
        w = WORD.findall(t)
        count = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        hit = {k + j for k in range(len(w) - 2) if count[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit))
        assert tuple(got[i][m] for m in quality.MEASURES) == want, i
        assert got[i]["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert not (got[i]["base_failed"] and got[i]["kept"])
    assert quality.quality(empty).count() == 0


def test_quality_fences_follow_groups(spark):
    plain = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "en", "a", 0) for i in range(60)]
    table = [(100 + i, " ".join(f"| w{i}x{j}" for j in range(60)), "en", "b", 0) for i in range(60)]
    odd = [(500, " ".join(f"| q{j}" for j in range(60)), "en", "a", 0)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality(spark.createDataFrame(plain + table + odd, SCHEMA)).collect()}
    assert got[1] and got[101] and not got[500]  # bars are usual in source b only


def test_language_model(docs, rows, empty):
    got = [r for r in language_model.score_texts(docs).collect() if r["doc_id"] is not None]
    tokens = lambda t: WORD.findall(lower(t)) + [None]
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    c = collections.Counter(w for i, t, *_ in rows if not fold(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    texts = {i: t for i, t, *_ in rows}
    for r in got:
        k = tokens(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(k), sum(c[w] > 0 for w in k), n, fold(r["doc_id"]))
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in k), rel_tol=1e-9)
        assert r["score"] < 0
    assert language_model.score_texts(empty).count() == 0


def lm_words(n_words=400, texts=50):
    import numpy as np

    counts = np.arange(n_words, 0, -1) * 30.0
    rare = np.full(language_model.SHAPES, 7.0)
    return language_model.Words([f"w{i:03d}" for i in range(n_words)], counts, np.log10(rare + 4), rare, int(counts.sum() + rare.sum()) + texts, n_words + 90, texts)


def test_language_model_is_normalised():
    import numpy as np

    words = lm_words()
    rng = np.random.default_rng(1)
    rows = language_model.Parameters(words).rows
    rows = rows + rng.normal(0, 0.5, rows.shape).astype(np.float32)
    scorer = language_model.Scorer(words, rows)
    every = np.arange(words.end + 1)  # all words with vectors, all shape classes, the end
    for w2, w1 in ((words.end, words.end), (3, words.end - 1), (399, 120)):
        logs = scorer.log_probabilities(np.full(len(every), w2), np.full(len(every), w1), every)
        assert np.isclose((10.0 ** logs).sum(), 1, atol=1e-4)
    assert words.classes == len(set(words.classes_at(every))) and words.sizes.max() <= language_model.GROUP


def test_language_model_learns_words_in_context(monkeypatch):
    import numpy as np

    monkeypatch.setattr(language_model, "BATCH", 256)
    words = lm_words()
    start = language_model.Parameters(words).rows
    trainer = language_model.Trainer(words, start, 3)
    texts = ["w300 w301 w302 w303", "w010 w399 w350 w020"] * 2000
    for _ in range(10):
        trainer.learn(*language_model.streamed(texts, words, {w: i for i, w in enumerate(words.words)}))
    scorer, before = language_model.Scorer(words, trainer.p.rows), language_model.Scorer(words, start)
    for w2, w1, w in ((300, 301, 302), (301, 302, 303), (10, 399, 350), (399, 350, 20)):
        at = [np.array([x]) for x in (w2, w1, w)]
        assert scorer.log_probabilities(*at)[0] > -1.2 > before.log_probabilities(*at)[0]
    other = [np.array([x]) for x in (10, 399, 302)]
    assert scorer.log_probabilities(*other)[0] < -2


def test_language_model_trains_on_windows_of_all_lengths():
    import numpy as np

    words, rng = lm_words(), np.random.default_rng(2)
    known = {w: i for i, w in enumerate(words.words)}
    texts = ["", "w001", " ".join(f"w{i % 400:03d}" for i in range(1000))] * 200
    whole, _ = language_model.streamed(texts[:3], words, dict(known))
    triples = set(zip(whole[:-2], whole[1:-1], whole[2:]))
    stream, tokens = language_model.streamed(texts, words, known, 0.25, rng)
    assert set(zip(stream[tokens - 2], stream[tokens - 1], stream[tokens])) <= triples
    assert 0.15 < len(tokens) / (200 * 1004) < 0.35 and (stream[tokens] == words.end).any()


def test_language_model_beats_the_base_on_held_out_texts(spark):
    import random

    rng = random.Random(4)
    texts = []
    for i in range(1400):
        stem = rng.choice(["ab", "cd", "ef", "gh"])
        texts.append((i, " ".join(f"{stem}{rng.randrange(30)}" for _ in range(60))))
    got = language_model.score_texts(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).where("held_out").collect()
    score, base, tokens = (sum(r[c] for r in got) for c in ("score", "base_score", "n_tokens"))
    # four kinds of text: knowing the kind is worth 0.6; 73,000 tokens are few steps
    assert len(got) > 100 and score / tokens > base / tokens + 0.2


def brute_removal(rows, window):
    words = {i: WORD.findall(t or "") for i, t, *_ in rows if i is not None}
    first = {}
    for i in sorted(words):
        for s in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][s:s + window]), i)
    out = {}
    for i, w in words.items():
        hit = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < i:
                hit[s:s + window] = [True] * window
        out[i] = (len(w), sum(hit), " ".join(x for x, h in zip(w, hit) if not h))
    return out


def test_substring_dedup(docs, rows, empty):
    got = {i: tuple(r)[1:] for i, r in by_id(substring_dedup.remove_repeats(docs)).items()}
    assert got == brute_removal(rows, 50) and got[11][1] == 60 and got[12][1] == 60
    assert substring_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("window,kmer", [(10, 3), (8, 8)])
def test_substring_dedup_with_many_branches(spark, window, kmer):
    import random

    rng = random.Random(3)
    base = [[rng.choice("abcdefgh") for _ in range(60)] for _ in range(4)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rng.randint(0, 4)):
            p, a = rng.choice(base), rng.randint(0, 30)
            w += p[a:a + rng.randint(5, 60)] + ([rng.choice("abcdefgh")] if rng.random() < 0.5 else [])
        rows.append((i, " ".join(w + ["z"] * rng.choice([0, 0, 25]))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {i: tuple(r)[1:] for i, r in by_id(substring_dedup.remove_repeats(df, window, kmer)).items()}
    assert got == brute_removal(rows, window)


def test_substring_dedup_repeated_ids(spark):
    text, other = passage(1, 60), passage(2, 60)
    df = spark.createDataFrame([(1, text), (1, text), (1, other), (2, text + " " + other), (None, other)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in substring_dedup.remove_repeats(df).collect())
    assert got == [(0, 60), (1, 0), (1, 0), (1, 0), (2, 120)]


def toxic_rows():
    return [(i, passage(i + 100, 60) + (f" grimblefoot zounderkite {passage(i, 5)}" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]


def test_toxicity_held_out(spark, empty):
    rows = toxic_rows() + [(1000, None, 0), (1001, "", 0)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows[:400]] + [(5, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(df, labels).collect()
    truth = {i: x for i, _, x in rows}
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(rows) and len(held) > 60
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    kept = {r["doc_id"] for r in toxicity.drop_toxic(df, labels).collect()}
    assert kept == {r["doc_id"] for r in got if not r["predicted"]} and {1000, 1001} <= kept
    assert toxicity.toxicity(empty, labels).count() == 0


def test_toxicity_by_stems_that_ordinary_texts_have_too():
    ends = ["au", "ein", "st", "be", "en", "keit", "te", "pf"]
    stem = lambda i, n: " ".join("zunkrab" + ends[(i * 5 + j * 3) % 8] for j in range(n))
    toxic = [f"{passage(i, 40)} {stem(i, 4)} {passage(i + 7, 40)}" for i in range(150)]
    ordinary = [f"{passage(i + 1000, 40)} {stem(i, int(i % 7 == 0))} {passage(i + 1007, 40)}" for i in range(600)]
    scorer = toxicity.Scorer(toxicity.train_model(toxic[:100], ordinary[:400], 0.2))
    assert sum(scorer.score(t) >= toxicity.CUTOFF for t in toxic[100:]) >= 45
    assert sum(scorer.score(t) >= toxicity.CUTOFF for t in ordinary[400:]) <= 10


def test_toxicity_without_labels(docs, rows, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxicity(docs, labels).collect()} == {0.0}
    assert toxicity.drop_toxic(docs, labels).count() == len(rows)


def test_near_dedup_decides_by_row(spark):
    a, b, c = (passage(s, 40) for s in (21, 22, 23))
    schema = "doc_id long, text string, copy string"

    def kept(rows):
        return sorted((r["doc_id"], r["text"]) for r in simhash_pivots.dedup(spark.createDataFrame([(*r, "x") for r in rows], schema)).collect())

    assert kept([(3, a), (5, a), (5, b), (7, b)]) == sorted([(3, a), (5, b)])
    assert kept([(3, a), (5, a), (5, c)]) == sorted([(3, a), (5, c)])
    assert kept([(3, a), (3, b), (3, a), (4, b)]) == sorted([(3, a), (3, b)])


def test_packing_encoder_with_a_small_cache(monkeypatch):
    import public_tokenizers
    from array import array
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "MAX_CACHED", 5)
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = packing.WordEncoder(path), Tokenizer.from_file(path)
    for text in ("one two three four five six seven eight", "one ten eleven twelve thirteen fourteen one", "one", "É one日"):
        assert array("I", own.encode([text])[0]).tolist() == library.encode(text, add_special_tokens=False).ids


def test_pii_linear_on_long_regions():
    import time

    model = pii.SemiCRF().fit(["call +1 (523) 555-1219 now", "4795326016703902 and a.b@c.com", "1.2.3.4 x"] * 5)
    texts = ["1 " + "字" * 1_000_000, "1234 5678 " * 10_000, "1" * 1_000_000, "a1" * 100_000, "a@" * 50_000 + "1", "a.b" * 100_000 + "1 2345"]
    for text in texts:
        t0 = time.monotonic()
        pii.all_spans(text, pii.base_spans(text), model)
        assert time.monotonic() - t0 < 5, text[:10]


def test_pii_regions_as_stated():
    import random

    plain = re.compile(r"\S*[0-9@]\S*(?:\s\S*[0-9@]\S*)*")
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choice("ab1@ \n\t語") for _ in range(rng.randrange(30)))
        assert [m.span() for m in pii.REGION.finditer(text)] == [m.span() for m in plain.finditer(text)]


def test_bpe_classes_of_all_unicode_versions():
    from tokenizers import Tokenizer

    own, library = bpe.SpeculativeBPE(bpe.default_path()), Tokenizer.from_file(bpe.default_path())
    named = "࢏౜೜꟒\U00010ee5\U00011dca\U00016eab\U00016ff3\U00018d19\U00018d94՘͸\U000323b0"
    chars = named + "".join(chr(i) for i in range(0, 0x110000, 97) if not 0xD800 <= i < 0xE000)
    texts = ["".join(f"a{c}b 1{c}2 {c} {c}{c}." for c in chars[i:i + 16]) for i in range(0, len(chars), 16)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in own.encode(texts)] == want


def test_bpe_long_pieces():
    import random
    import time
    from tokenizers import Tokenizer

    rng, library = random.Random(1), Tokenizer.from_file(bpe.default_path())
    own = bpe.SpeculativeBPE(bpe.default_path())
    for n in (bpe.LONG_PIECE - 1, bpe.LONG_PIECE + 1, 30_000):
        text = "".join(rng.choice("etaoinshrdlu") for _ in range(n))
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    t0 = time.monotonic()
    own.encode(["".join(rng.choice("etaoinshrdlu") for _ in range(300_000))])
    assert time.monotonic() - t0 < 10


def test_language_model_chunks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language_model, "CHUNK_BYTES", 20_000)
    df = spark.createDataFrame([(i, "w " * (5000 if i % 10 == 0 else 50)) for i in range(100)], "doc_id long, text string").repartition(2)
    sizes = collections.Counter()
    for r in language_model.chunked(df).collect():
        sizes[r["chunk"]] += len(r["text"])
    assert max(v for c, v in sizes.items() if c >= 0) <= language_model.LONG * 20_000 and sum(c < 0 for c in sizes) == 10
    got = language_model.score_texts(df).collect()
    assert len(got) == 100 and all(r["n_tokens"] == (5001 if r["doc_id"] % 10 == 0 else 51) for r in got)


def test_quality_spam_source_does_not_set_its_own_bar(spark):
    clean = [(i, passage(i, 80), "en", "a") for i in range(200)]
    spam = [(1000 + i, passage(i, 60) + " ###" * (40 if i < 45 else 0), "en", "b") for i in range(120)]
    df = spark.createDataFrame(clean + spam, "doc_id long, text string, lang string, source string")
    got = by_id(quality.quality(df))
    assert all(got[i]["kept"] for i in range(200)) and all(got[1000 + i]["kept"] for i in range(45, 120))
    assert not any(got[1000 + i]["kept"] for i in range(45))


def test_checkpoint_folder_is_shared_on_a_cluster():
    from boxscore.llm.common import prepare

    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "spark://head:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        prepare(Cluster)


def test_language_model_trains_on_every_token_of_a_large_corpus(monkeypatch):
    from types import SimpleNamespace

    import pyarrow as pa
    import pyspark

    words = lm_words()
    words.tokens = 10**9
    texts = [" ".join(f"w{(i + j) % 400:03d}" for i in range(300)) for j in range(20)] + [""]
    used = []
    monkeypatch.setattr(pyspark.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    monkeypatch.setattr(language_model.Trainer, "learn", lambda self, stream, places: used.append(len(set(places.tolist()))))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    list(language_model.training_task(iter([batch]), words, language_model.Parameters(words).rows, 0))
    assert sum(used) == 20 * 301 + 1


def test_language_model_chunk_needs_only_counts_of_other_chunks():
    import numpy as np
    import pyarrow as pa

    words = lm_words()
    texts = ["W001 w001 new new \x1cq", " w001 seen ", "", "seen　x w002"]
    docs = pa.table({"doc_id": [1, 2, 3, 4], "held_out": [False, False, False, True], "text": texts})
    others = pa.table({"word": ["w001", "w002", "seen"], "c": pa.array([11970, 11940, 9], pa.int64())})
    got = language_model.score_chunk(docs, others, words, language_model.Parameters(words).rows).to_pylist()
    c = {"w001": 11970, "w002": 11940, "seen": 9, "new new": 1, "\x1cq": 1, None: words.texts}
    for r, t in zip(got, texts):
        k = WORD.findall(lower(t)) + [None]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(k), sum(w in c for w in k), words.tokens)
        assert math.isclose(r["base_score"], sum(math.log10((c.get(w, 0) + 1) / (words.tokens + words.distinct + 1)) for w in k), rel_tol=1e-9)


def test_language_model_normalises_a_class_once_per_slab(monkeypatch):
    import numpy as np

    words, rng = lm_words(), np.random.default_rng(3)
    rows = language_model.Parameters(words).rows
    rows = rows + rng.normal(0, 0.5, rows.shape).astype(np.float32)
    w2, w1, w = rng.integers(0, words.end + 1, (3, 50_000))
    scorer, calls, sums = language_model.Scorer(words, rows), [], language_model.log_sums
    monkeypatch.setattr(language_model, "log_sums", lambda logits, largest: calls.append(len(logits)) or sums(logits, largest))
    got = scorer.log_probabilities(w2, w1, w)
    assert len(calls) <= 2 * 50_000 / scorer.ROWS + words.n_groups + 2
    monkeypatch.setattr(language_model, "log_sums", lambda logits, largest: sums(logits, 1e9))
    assert np.allclose(got, scorer.log_probabilities(w2, w1, w), rtol=1e-5)


def test_language_model_long_texts_share_chunks(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(language_model, "CHUNK_BYTES", 400_000)
    texts = ["w%d v%d " % (i % 7, i) + "w " * (4000 if i % 10 == 0 else 30_000 if i % 55 == 0 else 50) for i in range(600)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    chunked = language_model.chunked(df).collect()
    long = {r["chunk"] for r in chunked if r["chunk"] < 0}
    sizes = collections.Counter()
    for r in chunked:
        sizes[r["chunk"]] += len(r["text"])
    assert len(long) <= sum(len(t) > 7000 for t in texts) / 2 and max(sizes.values()) <= language_model.LONG * 400_000
    columns = [pa.array(x) for x in zip(*((r["held_out"], r["chunk"], r["text"]) for r in chunked))]
    batch = pa.RecordBatch.from_arrays(columns, names=["held_out", "chunk", "text"])
    listed = [r for b in language_model.vocabulary_task(iter([batch.slice(0, 250), batch.slice(250)])) for r in b.to_pylist()]
    expected = collections.Counter()
    for r in chunked:
        for w in r["text"].split():
            expected[r["chunk"], w] += not r["held_out"]
    assert len(listed) == len(expected) and {(r["chunk"], r["word"]): r["n"] for r in listed} == expected
    c = collections.Counter(w for r in chunked if not r["held_out"] for w in [*r["text"].split(), None])
    for r in language_model.score_texts(df).collect():
        base = sum(math.log10((c[w] + 1) / (sum(c.values()) + len(c) + 1)) for w in [*texts[r["doc_id"]].split(), None])
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)


@pytest.mark.parametrize("spread, table", [(0.3, 1 << 22), (0.3, 3000), (4.0, 1 << 22), (4.0, 3000)])
def test_language_model_normaliser_of_products(monkeypatch, spread, table):
    """Products of exponentials give the sums that the logits give, also where they underflow (the larger spread)."""
    import numpy as np

    words, rng = lm_words(), np.random.default_rng(5)
    rows = language_model.Parameters(words).rows
    scorer = language_model.Scorer(words, rows + rng.normal(0, spread, rows.shape).astype(np.float32))
    monkeypatch.setattr(scorer, "TABLE", table)
    taken, log_sums = [], language_model.log_sums
    monkeypatch.setattr(language_model, "log_sums", lambda logits, largest: taken.append(len(logits)) or log_sums(logits, largest))
    w2, w1 = rng.integers(0, words.end + 1, (2, 20_000))
    logits = (scorer.a1[w1] + scorer.a2[w2]).astype(float) @ scorer.q.T.astype(float) + scorer.b
    top = logits.max(axis=1)
    got = scorer.log_normalisers(w2, w1, scorer.q, scorer.b)
    assert np.allclose(got, top + np.log(np.exp(logits - top[:, None]).sum(axis=1)), rtol=1e-5, atol=1e-4)
    assert (sum(taken) == 0) == (spread < 1)
    few = scorer.log_normalisers(w2[:5], w1[:5], scorer.q, scorer.b)
    assert np.allclose(few, got[:5], rtol=1e-5, atol=1e-4)


def test_language_model_step_adds_up_gradients():
    """A step against the same gradients added token by token."""
    import numpy as np

    words, d = lm_words(), language_model.DIMENSIONS
    rng = np.random.default_rng(6)
    start = language_model.Parameters(words).rows
    start = (start + rng.normal(0, 0.2, start.shape)).astype(np.float32)
    w2, w1, w = rng.integers(0, words.end + 1, (3, 700))
    trainer = language_model.Trainer(words, start, 9)
    trainer.step(w2, w1, w)
    draws, p = np.random.default_rng(9), language_model.Parameters(words, start.astype(float))
    noise = np.minimum(np.searchsorted(trainer.noise_cdf, draws.random(language_model.NOISE)), words.classes - 1)
    cls = words.classes_at(w)
    grouped = (cls >= words.first_group) & (cls < words.first_shape)
    group = cls[grouped] - words.first_group
    drawn = iter(words.members[group[:, None], (draws.random((grouped.sum(), language_model.NEAR_NOISE)) * words.sizes[group][:, None]).astype(int)])
    grads, uses = np.zeros(start.shape), np.zeros(len(start))
    context, classes, own, matrix = p.bounds[:4]
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for a, b, x, c, near in zip(w2, w1, w, cls, grouped):
        r, dr = p.c1 @ p.e[b] + p.c2 @ p.e[a], np.zeros(d)
        pairs = [(classes + c, trainer.log_noise[c], 1), *((classes + k, trainer.log_noise[k], 0) for k in noise)]
        if near:
            pairs += [(own + k, trainer.log_near[c - words.first_group], first) for k, first in ((x, 1), *((k, 0) for k in next(drawn)))]
        for row, log_noise, true in pairs:
            weight = true - sigmoid(start[row, :d].astype(float) @ r + start[row, d] - log_noise)
            grads[row] += weight * np.append(r, 1)
            dr += weight * start[row, :d]
            uses[row] += true or row >= own
        for one, m, at in ((b, p.c1, matrix), (a, p.c2, matrix + d)):
            grads[context + one, :d] += m.T @ dr
            grads[at : at + d, :d] += np.outer(dr, p.e[one])
            uses[context + one] += 1
    uses[matrix:] = 1
    np.add.at(uses, classes + noise, 1)
    total = grads / language_model.BATCH
    assert (trainer.used == uses).all()
    assert np.allclose(trainer.p.rows, start + language_model.RATE * total / np.sqrt(1e-3 + total * total), atol=1e-5)
