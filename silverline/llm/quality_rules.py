"""Operator 5: quality rules. Built-in functions only.

Method: hashed n-gram log-likelihood ratio. Tokens are runs of letters and
digits, or of other visible characters; a document's one- and two-token n-grams
are hashed to ``buckets``. Two multinomials over the buckets, of the trusted
target (labelled good and not toxic) and of the raw corpus (all documents), give
each bucket a weight log(p_target / p_raw); the mean weight of a document's
n-grams is its score and the fixed ``threshold`` decides on every document.

The raw counts cover all documents, and the target's all trusted ones. Trusted ids are
joined by shuffle at every size, hashed by partition, so texts are not sorted. The weights, ``buckets``
doubles, go into the plan as one array literal.

Base rules, per text: word_chars, n_symbols, n_dup_lines, n_repeat_words;
``base_failed`` if n_words < 10 or 100 * n_repeat_words > 20 * n_words. Repeated
windows are found within a text by 64-bit hashes of its five-word windows.

Defined results: a null text has no words and fails; a text without n-grams
scores 0; without trusted labels every weight is 0 and only the base rules
decide; labels that repeat count once, and a null label is none. Repeated rows
are judged alike. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import WORD, let, read, text_or_empty

BUCKETS = 1 << 14
THRESHOLD = -0.15
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
SYMBOLS = r"[#*$%&|<>]"


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _token_pairs(text: Column) -> Column:
    """Array of (token, next token or null) of ``text``."""
    return let(
        _tokens(text),
        # Fields of arrays_zip are named 0 and 1 where the arrays are expressions.
        lambda t: F.arrays_zip(F.slice(t, 1, F.size(t)), F.slice(t, 2, F.size(t))),
    )


def _buckets(pair: Column, buckets: int) -> tuple[Column, Column]:
    """The buckets of the one-token and the two-token gram that start at ``pair``."""
    mask = F.lit(buckets - 1)
    return F.xxhash64(pair["0"]).bitwiseAND(mask), F.xxhash64(pair["0"], pair["1"]).bitwiseAND(mask)


def bucket_weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """log(p_target / p_raw) of each bucket, with add-one smoothing."""
    trusted = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
        .select("doc_id", F.lit(1).alias("trusted"))
    )
    texts = docs.select("doc_id", "text").join(trusted.hint("shuffle_hash"), "doc_id", "left")
    pairs = texts.select("trusted", F.explode(_token_pairs(text_or_empty())).alias("pair"))
    one, two = _buckets(F.col("pair"), buckets)
    counts = (
        pairs.select("trusted", F.explode(F.array(one, F.when(F.col("pair")["1"].isNotNull(), two))).alias("bucket"))
        .where(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("target"))
    )
    raw, target = [1] * buckets, [1] * buckets
    for r in counts.collect():  # at most ``buckets`` rows
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    all_raw, all_target = sum(raw), sum(target)
    if all_target == buckets:
        return [0.0] * buckets
    return [math.log(t / all_target) - math.log(r / all_raw) for t, r in zip(target, raw, strict=True)]


def score(text: Column, weights: list[float]) -> Column:
    """Mean weight of the n-grams of ``text``."""
    # One string that the optimizer folds to an array literal.
    table = F.split(F.lit(",".join(repr(w) for w in weights)), ",").cast("array<double>")

    def weight(bucket: Column) -> Column:
        return F.get(table, bucket)

    def add(total: Column, pair: Column) -> Column:
        one, two = _buckets(pair, len(weights))
        return total + weight(one) + weight(two)

    def mean(tokens: Column) -> Column:
        # The last token begins no two-token gram.
        pairs = F.arrays_zip(F.slice(tokens, 1, F.size(tokens) - 1), F.slice(tokens, 2, F.size(tokens) - 1))
        last = weight(F.xxhash64(F.element_at(tokens, -1)).bitwiseAND(F.lit(len(weights) - 1)))
        return F.when(
            F.size(tokens) > 0, (F.aggregate(pairs, F.lit(0.0), add) + last) / (2 * F.size(tokens) - 1)
        ).otherwise(F.lit(0.0))

    return let(_tokens(text), mean)


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows of ``window`` words found twice or more."""

    def covered(grams: Column) -> Column:
        by_hash = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            return F.sort_array(
                F.transform(
                    F.filter(
                        F.transform(
                            s,
                            lambda x, j: F.struct(
                                x["i"].alias("i"),
                                (
                                    F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                                    | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))
                                ).alias("again"),
                            ),
                        ),
                        lambda x: x["again"],
                    ),
                    lambda x: x["i"],
                )
            )

        def total(at: Column) -> Column:
            widths = F.transform(
                at, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - x, F.lit(window)))
            )
            return F.aggregate(widths, F.lit(0).cast("bigint"), lambda a, x: a + x)

        return let(by_hash, lambda s: let(starts(s), total))

    none = F.lit(0).cast("bigint")
    shifted = [
        F.slice(words, k + 1, F.greatest(F.size(words) - (window - 1), F.lit(0))) for k in range(window)
    ]
    grams = F.transform(F.arrays_zip(*shifted), lambda g: F.xxhash64(g))
    return F.when(
        F.size(words) > window,
        let(
            grams,
            lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(none),
        ),
    ).otherwise(none)


def base_rules(text: Column) -> Column:
    """Struct of the base counts of ``text`` (not null) and ``base_failed``."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))

    def rules(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        )

    counts = let(words, rules)
    dup = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))
    symbols = (F.size(F.split(text, SYMBOLS, -1)) - 1).cast("bigint")
    return let(
        counts,
        lambda c: F.struct(
            c["n_words"].alias("n_words"),
            c["word_chars"].alias("word_chars"),
            symbols.alias("n_symbols"),
            dup.alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
            (
                (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"])
            ).alias("base_failed"),
        ),
    )


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> tuple[Column, Column]:
    """The base-rule struct and the score, as columns over ``docs``."""
    weights = bucket_weights(docs, labels)
    return base_rules(text_or_empty()), score(text_or_empty(), weights)


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: the base counts, base_failed, llr and kept."""
    base, llr = judged(docs, labels, threshold)
    rows = docs.select("doc_id", base.alias("b"), llr.alias("llr"))
    return rows.select(
        "doc_id",
        *[F.col("b")[c].alias(c) for c in BASE],
        "llr",
        (~F.col("b")["base_failed"] & (F.col("llr") >= threshold)).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they came."""
    base, llr = judged(docs, labels, threshold)
    return docs.where(~base["base_failed"] & (llr >= threshold))


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
