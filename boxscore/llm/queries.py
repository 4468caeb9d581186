"""Registered queries of the operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from . import (bpe, exact_dedup, html_wrapper, language_model, packing, pii, prefix_trie, quality, secret_scan, simhash_pivots,
               substring_dedup, token_alignment, toxicity)
from .common import documents


def op1_toxicity(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.toxicity(documents(spark, sf_dir).select("doc_id", "text"), labels)


def op2_simhash(spark, sf_dir):
    groups = simhash_pivots.near_groups(documents(spark, sf_dir).select("doc_id", "text"))
    return groups.select("doc_id", simhash_pivots.as_hex("fp").alias("fingerprint"), "component_id")


def op3_html_wrapper(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return html_wrapper.main_text(pages)


def op4_packing(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return packing.with_checksum(packing.pack(docs))


def op5_pii(spark, sf_dir):
    return pii.find(documents(spark, sf_dir).select("doc_id", "text"))


def op6_exact_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return exact_dedup.exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_bpe(spark, sf_dir):
    return bpe.round_trip(documents(spark, sf_dir).select("doc_id", "text"))


def op8_language_model(spark, sf_dir):
    return language_model.score_texts(documents(spark, sf_dir).select("doc_id", "text"))


def op9_quality_rules(spark, sf_dir):
    return quality.quality(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))


def op10_substring_dedup(spark, sf_dir):
    return substring_dedup.removal_digests(documents(spark, sf_dir).select("doc_id", "text"))


def op11_prefix_trie(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return prefix_trie.trie(turns)


def op12_secret_scan(spark, sf_dir):
    return secret_scan.find(documents(spark, sf_dir).select("doc_id", "text"))


def op13_token_alignment(spark, sf_dir):
    return token_alignment.align(documents(spark, sf_dir).select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_simhash, op3_html_wrapper, op4_packing, op5_pii, op6_exact_dedup, op7_bpe, op8_language_model, op9_quality_rules, op10_substring_dedup, op11_prefix_trie, op12_secret_scan, op13_token_alignment)}

ORACLE = {
    "op6_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        h AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM h""",
    "op10_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, unnest(range(len(w) - 49)) AS s, w FROM d WHERE len(w) >= 50),
        h AS (SELECT doc_id, s, array_to_string(w[s + 1:s + 50], ' ') AS window_text FROM s),
        f AS (SELECT window_text, min(doc_id) AS low FROM h GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
        r AS (SELECT DISTINCT h.doc_id, h.s + o.i AS p FROM h JOIN f USING (window_text), range(50) AS o(i) WHERE h.doc_id > f.low),
        k AS (SELECT doc_id, unnest(range(len(w))) AS p, unnest(w) AS word FROM d),
        g AS (SELECT k.doc_id, string_agg(k.word, ' ' ORDER BY k.p) AS kept, count(*) AS n_kept
              FROM k LEFT JOIN r ON r.doc_id = k.doc_id AND r.p = k.p WHERE r.p IS NULL GROUP BY 1)
        SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(g.n_kept, 0) AS n_removed, sha256(coalesce(g.kept, '')) AS kept_sha256
        FROM d LEFT JOIN g USING (doc_id)""",
    "op11_prefix_trie": r"""
        WITH t AS (SELECT conv_id AS c, turn, coalesce(text, '') AS x,
                          sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS g
                   FROM conversations WHERE conv_id IS NOT NULL),
        o AS (SELECT c, g, strlen(x) AS bytes, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, g) AS pos FROM t),
        k AS (SELECT c, count(*) AS n, c - c % 5 AS b,
                     -- CRC-32 of the decimal id: each byte is followed by eight shifts (-1)
                     xor(list_reduce(list_concat([4294967295::HUGEINT], flatten(list_transform(string_split(c::VARCHAR, ''), lambda ch: [ord(ch)::HUGEINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                         lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)::BIGINT % 9 AS h
              FROM o GROUP BY c),
        z AS (SELECT c, n, h, b, least(h, (SELECT count(*) FROM o WHERE o.c = k.b)) AS taken FROM k),
        m AS (SELECT z.c, o.pos AS d, o.g, o.bytes FROM z JOIN o ON o.c = z.b AND o.pos <= z.h
              UNION ALL SELECT z.c, z.taken + o.pos - z.h, o.g, o.bytes FROM z JOIN o ON o.c = z.c AND o.pos > z.h),
        p AS (SELECT c, d, bytes, string_agg(g, '') OVER (PARTITION BY c ORDER BY d) AS key, count(*) OVER (PARTITION BY c) AS len FROM m
              UNION ALL SELECT z.c, 0, 0, '', (SELECT count(*) FROM m WHERE m.c = z.c) FROM z),
        v AS (SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, max(bytes) * (count(*) - 1) AS own,
                     sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = len), '')) AS ends_sha256
              FROM p GROUP BY key, d),
        w AS (SELECT key, d, own, NOT EXISTS (SELECT 1 FROM v AS y WHERE y.d = v.d + 1 AND y.key[1:64 * v.d] = v.key) AS leaf FROM v),
        s AS (SELECT u.key[1:64 * i] AS key, sum(u.own) AS saved_tokens, count(*) FILTER (u.leaf) AS n_leaves
              FROM (SELECT key, own, leaf, unnest(range(d + 1)) AS i FROM w) AS u GROUP BY 1)
        SELECT v.conv_id, v.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, v.n_convs,
               (SELECT count(*) FROM v AS y WHERE y.d = v.d + 1 AND y.key[1:64 * v.d] = v.key) AS n_children,
               s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
        FROM v JOIN s ON s.key = v.key LEFT JOIN v AS parent ON v.d > 0 AND parent.key = v.key[1:64 * (v.d - 1)]""",
}
