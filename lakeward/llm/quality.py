"""Quality rules with distribution divergence, as DataFrame functions only.

Fixed rules first: too few words, or too large a share of words in five-word
windows that the text repeats.  Then the method: a document's histogram of
character classes and its histogram of a language's common words are compared
with that language's reference by the Jensen-Shannon distance (base 2, 0 to 1).
A reference is the mean histogram of all documents of the language that reach
the minimum lengths, pass the base rules and have a least share of common words
(where the language has a list), so it is made of whole corpus statistics that
junk does not shift; a document below a minimum length, or of a language without
a reference, is not judged by that histogram.  The limit for common words is a
share of the distance that a text without any of them has.

Per-document features come from one pass over the texts and are written to the
shared folder; references and verdicts read only those.  A null text has no
words and no lines; null languages have no common words and share a reference
for character classes.  Repeated rows are judged alike, an empty table gives an
empty result, and other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import Folder

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Minimum lengths for a histogram to be judged.
MIN_CHARS_JUDGED = 200
MIN_WORDS_JUDGED = 50
#: Largest distances kept.
MAX_CLASS_DISTANCE = 0.31
#: As a share of the distance of a text without common words.
MAX_WORD_DISTANCE_SHARE = 0.975
#: Least share of common words in texts that make up a reference.
MIN_COMMON_SHARE = 0.05
#: Common words by language (fixed values).
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "this"],
    "de": ["der", "die", "und", "den", "das", "ein", "ist", "nicht", "von", "mit", "sich", "auf"],
    "fr": ["le", "la", "de", "et", "les", "des", "un", "une", "du", "que", "pour", "dans"],
    "es": ["el", "la", "de", "que", "y", "los", "en", "un", "las", "del", "por", "con"],
}
WINDOW = 5


def _count(text: Column, kind: str) -> Column:
    """Characters of a class: what is left without the others."""
    return F.length(F.regexp_replace(text, f"[^{kind}]+", ""))


def _features(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    text = F.col("text")
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).alias("lang")
    )
    counted = base.select(
        "doc_id",
        "lang",
        F.length(text).alias("n_chars"),
        _count(text, "A-Z").alias("upper"),
        _count(text, "0-9").alias("digit"),
        _count(text, r"\x20\x09-\x0D").alias("space"),
        _count(text, r"!-/:-@\[-`{-~").alias("mark"),
        _count(text, r"\x{80}-\x{10FFFF}").alias("wide"),
        _count(text, r"#*$%&|<>").cast("long").alias("n_symbols"),
        F.filter(F.split(text, r"\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
    )
    common = F.lit(None).cast("array<string>")
    for lang, listed in COMMON_WORDS.items():
        common = F.when(F.col("lang") == lang, F.array(*[F.lit(w) for w in listed])).otherwise(common)
    hashed = counted.select(
        "doc_id",
        "lang",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        (F.col("n_chars") - F.col("space")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("codes"),
        F.array(*[F.col(c).cast("double") for c in ("upper", "digit", "space", "mark", "wide")]).alias("classes"),
        F.col("n_chars"),
        common.alias("listed"),
        F.filter(
            F.when(common.isNotNull(), F.transform("words", lambda w: F.lower(w))),
            lambda w: F.array_contains(common, w),
        ).alias("hits"),
    )
    codes = F.col("codes")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(codes) - WINDOW),
        lambda i: F.xxhash64(*[codes[i + k] for k in range(WINDOW)]),
    )
    cut = hashed.select(
        "*", F.when(F.size(codes) >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("windows")
    ).drop("codes")
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = cut.select("*", F.when(repeats, placed).alias("placed")).drop("windows")
    p = F.col("placed")
    last = F.size(p) - 1
    again = F.filter(
        p,
        lambda e, k: ((k > 0) & (F.get(p, k - 1)["h"] == e["h"])) | ((k < last) & (F.get(p, k + 1)["h"] == e["h"])),
    )
    flagged = ordered.select("*", F.sort_array(F.transform(again, lambda e: e["i"])).alias("at")).drop("placed")
    at = F.col("at")
    spans = F.transform(at, lambda x, k: F.when(k < F.size(at) - 1, F.least(F.get(at, k + 1) - x, F.lit(WINDOW))).otherwise(WINDOW))
    shares = F.transform("classes", lambda c: c / F.col("n_chars"))
    rest = 1.0 - F.aggregate(shares, F.lit(0.0), lambda a, c: a + c)
    word_shares = F.transform(
        "listed", lambda w: F.size(F.filter("hits", lambda h: h == w)).cast("double") / F.col("n_words")
    )
    return flagged.select(
        "doc_id",
        "lang",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(F.aggregate(spans, F.lit(0), lambda a, c: a + c), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.when(F.col("n_chars") >= MIN_CHARS_JUDGED, F.concat(shares, F.array(rest))).alias("class_shares"),
        F.when(F.col("n_words") >= MIN_WORDS_JUDGED, word_shares).alias("word_shares"),
        F.when(F.col("listed").isNotNull() & (F.col("n_words") > 0), F.size("hits") / F.col("n_words")).alias("common_share"),
    ).withColumn(
        "word_shares",
        F.concat("word_shares", F.array(1.0 - F.aggregate("word_shares", F.lit(0.0), lambda a, c: a + c))),
    )


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two arrays of
    shares with the same bins; null if either is null."""

    def half(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda a, b: (half(a, b) + half(b, a)) / 2)
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.when(total < 0, 0.0).otherwise(total))  # greatest() would make a null 0


def _mean(column: str, bins: int) -> Column:
    return F.when(
        F.count(column) > 0, F.array(*[F.avg(F.get(F.col(column), F.lit(i))) for i in range(bins)])
    )


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance_share: float = MAX_WORD_DISTANCE_SHARE,
) -> DataFrame:
    """One row per document: counts, distances, ``base_failed`` and ``kept``."""
    folder = Folder(docs.sparkSession, "quality")
    feats = folder.keep(_features(docs, id_col, text_col, lang_col), "features")
    bins = 1 + max(map(len, COMMON_WORDS.values()))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    typical = ~base_failed & (F.coalesce("common_share", F.lit(1.0)) >= MIN_COMMON_SHARE)
    reference = feats.filter(typical).groupBy(F.col("lang").alias("of")).agg(
        _mean("class_shares", 6).alias("class_reference"), _mean("word_shares", bins).alias("word_reference")
    )
    without = F.array(*[F.lit(0.0)] * (bins - 1), F.lit(1.0))
    reference = reference.withColumn("none_distance", js_distance(without, F.col("word_reference")))
    joined = feats.join(reference, F.col("lang").eqNullSafe(F.col("of")), "left")
    measured = joined.select(
        F.col("doc_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        js_distance(F.col("class_shares"), F.col("class_reference")).alias("class_distance"),
        js_distance(F.col("word_shares"), F.col("word_reference")).alias("word_distance"),
        (max_word_distance_share * F.col("none_distance")).alias("__word_limit"),
    )
    odd = (F.coalesce("class_distance", F.lit(0.0)) > max_class_distance) | (
        F.coalesce(F.col("word_distance") > F.col("__word_limit"), F.lit(False))
    )
    return measured.withColumn("kept", ~F.col("base_failed") & ~odd).drop("__word_limit")
