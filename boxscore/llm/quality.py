"""Quality rules with thresholds that follow each language and source.

All of it is DataFrame functions. A document's measures are computed inside
its row; mergeable quantile sketches (Greenwald-Khanna, Spark's
``percentile_approx``) of five shares are kept per language and source, per
language, and over all, every one combined before its shuffle. A share is
suspicious beyond its group's fence, ``q75 + SPREAD * (q75 - q25)`` but at
least SLACK above the median (many shares are zero almost everywhere). The
fences of a group with fewer than MIN_GROUP documents come from its language,
or from all documents. A group's fence lies at most SLACK beyond that of its
language, and a language's beyond that of all documents, so that a source
which is spam for a quarter or more does not set its own bar. Documents are
then joined with their group's fences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, WORD_CLASS, prepare, text_of

SPREAD = 3.0
MIN_GROUP = 50
ACCURACY = 1000  # rank error of a sketch: 1 / ACCURACY of the group's rows
MAX_BROADCAST_GROUPS = 20_000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"  # fixed by the contract
MARKS = "!?"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# share -> least distance of a fence from the median
SLACK = {"symbol_share": 0.05, "mark_share": 0.05, "capital_share": 0.25, "repeat_share": 0.25, "dup_line_share": 0.3}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where the body is a lambda over arrays."""
    return F.transform(F.array(value), body)[0]


def count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def words_of(text: Column) -> Column:
    body = F.regexp_replace(text, f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")
    return F.when(F.length(body) == 0, F.array().cast("array<string>")).otherwise(F.split(body, SPACE_CLASS + "+"))


def window_hashes(words: Column) -> Column:
    """64-bit hashes of the 3-word windows, in order."""
    return let(words, lambda w: F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))),
                    lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))))


def repeated_words(hashes: Column, words: Column) -> Column:
    """Words covered by windows that occur twice or more: sort windows by hash,
    keep the positions with an equal neighbour, add up what each start newly covers.
    Windows of equal hash are compared word by word."""
    def starts(pairs: Column) -> Column:
        def same(p, k):
            other = F.get(pairs, k)
            equal = other["h"] == p["h"]
            for d in range(3):
                equal = equal & (F.get(words, other["i"] + d) == F.get(words, p["i"] + d))
            return equal

        kept = F.filter(pairs, lambda p, k: F.coalesce(same(p, k - 1) & (k > 0), F.lit(False)) | F.coalesce(same(p, k + 1), F.lit(False)))
        return F.sort_array(F.transform(kept, lambda p: p["i"]))

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    slow = F.aggregate(let(pairs, starts), zero,
                       lambda a, s: F.struct((a["n"] + F.least(F.lit(3), s - a["last"])).alias("n"), s.alias("last")),
                       lambda a: a["n"])
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(slow)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source (null as empty), the contract's measures and the shares of every row."""
    text = text_of(docs)
    lines = lambda t: F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CLASS))
    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                      F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                      text.alias("text"))
    rows = raw.select("doc_id", "lang", "source", words_of(F.col("text")).alias("words"),
                      F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
                      count_of(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
                      count_of(F.col("text"), MARKS).cast("long").alias("n_marks"),
                      count_of(F.col("text"), CAPITALS).cast("long").alias("n_capitals"),
                      let(lines(F.col("text")), lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"), F.size(x).alias("n"))).alias("lines"))
    rows = rows.select("*", F.size("words").cast("long").alias("n_words"), window_hashes(F.col("words")).alias("hashes"))
    rows = rows.select("*", let(F.col("hashes"), lambda h: repeated_words(h, F.col("words"))).alias("n_repeat_words"), F.col("lines.dup").alias("n_dup_lines"))

    def share(part: str, whole) -> Column:
        return F.coalesce(F.col(part) / F.greatest(F.col(whole) if isinstance(whole, str) else whole, F.lit(1)), F.lit(0.0))

    return rows.select("doc_id", "lang", "source", *MEASURES,
                       share("n_symbols", "word_chars").alias("symbol_share"), share("n_marks", "word_chars").alias("mark_share"),
                       share("n_capitals", "word_chars").alias("capital_share"), share("n_repeat_words", "n_words").alias("repeat_share"),
                       share("n_dup_lines", F.col("lines.n")).alias("dup_line_share"))


def fences(rows: DataFrame) -> DataFrame:
    """One row per (lang, source) with the upper fence of each share."""
    sketch = [F.percentile_approx(s, [0.25, 0.5, 0.75], ACCURACY).alias(s) for s in SLACK]
    levels = {}
    for keys in (("lang", "source"), ("lang",), ()):
        levels[keys] = rows.groupBy(*keys).agg(F.count("*").alias("n"), *sketch).select(
            *keys, "n", F.struct(*[fence(F.col(s), SLACK[s]).alias(s) for s in SLACK]).alias(f"f{len(keys)}"))
    own, lang, every = levels[("lang", "source")], levels[("lang",)], levels[()]
    lang = lang.withColumnRenamed("n", "n_lang")
    # the last one is a single row
    joined = own.join(lang, "lang").join(F.broadcast(every.drop("n")), F.lit(True))

    def chosen(s: str) -> Column:
        in_lang = F.when(F.col("n_lang") >= MIN_GROUP, F.least(F.col("f1")[s], F.col("f0")[s] + SLACK[s])).otherwise(F.col("f0")[s])
        return F.when(F.col("n") >= MIN_GROUP, F.least(F.col("f2")[s], in_lang + SLACK[s])).otherwise(in_lang)

    return joined.select("lang", "source", F.struct(*[chosen(s).alias(s) for s in SLACK]).alias("fences"))


def fence(quantiles: Column, slack: float) -> Column:
    q25, q50, q75 = (quantiles[i] for i in range(3))
    return F.greatest(q75 + SPREAD * (q75 - q25), q50 + slack)


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed and kept of every row of ``docs``.

    Null text has no words, null lang and source count as empty ones; null and
    repeated doc_ids pass through; other columns are not read. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = measured(docs).checkpoint()
    limits = fences(rows).checkpoint()
    if limits.count() <= MAX_BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    joined = rows.join(limits, ["lang", "source"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    within = F.lit(True)
    for s in SLACK:
        within = within & (F.col(s) <= F.col("fences")[s])
    return joined.select("doc_id", *MEASURES, failed.alias("base_failed"), (~failed & within).alias("kept"))
