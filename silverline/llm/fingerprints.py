"""Operator 10: document fingerprints by a homomorphic multiset hash.

A text is a multiset of paragraphs: its lines, cut further after sentence ends
so that a text without line breaks has several too. Every paragraph is hashed to
a wide vector, and the fingerprint is the sum of the vectors of all paragraphs,
each lane modulo a power of two. It therefore does not depend on the order of
paragraphs, and a paragraph is inserted or deleted by adding or subtracting its
vector (:func:`add`, :func:`subtract`). Two parts:

- 8 lanes modulo 2^32, for equality;
- 126 lanes modulo 2^20 that count the paragraphs whose hash has a given bit.
  Read as +1/-1 they are a random projection, so the cosine of two fingerprints
  estimates how much of the two multisets is shared: :func:`likeness`.

Built-in functions only. The hash is not cryptographic: equality is for
deduplication, not against an adversary.

Defined results: a null text is empty; empty texts have the zero fingerprint
and likeness 1 to each other, 0 to any other text; equal fingerprints have
likeness exactly 1. Documents follow each other by descending doc_id, nulls
last, then by text; after the last comes the first, so a table of one document is
its own next. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.llm.common import let, read, text_or_empty

PARAGRAPH_END = r"\n+|(?<=[.!?])[ \t]+"
EQUALITY_SEEDS = 4  # two 32-bit lanes each
SKETCH_SEEDS = 2  # 63 one-bit lanes each
LANES = 3  # one-bit lanes that one long holds, 21 bits apart
FIELD = (1 << 0) | (1 << 21) | (1 << 42)
KEEP = ((1 << 20) - 1) * FIELD  # each lane modulo 2^20
LANE = (1 << 20) - 1
M32 = (1 << 32) - 1
ROWS_PER_BUCKET = 5000


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, PARAGRAPH_END, -1), lambda p: F.trim(p) != "")


def _hashes(p: Column, seed: int) -> Column:
    return F.transform(p, lambda x: F.xxhash64(F.lit(seed), x))


def _sum_lanes(hashes: Column, shift: int, field: int, keep: int) -> Column:
    """Sum of the hash bits under ``field`` after ``shift``, each lane cut to ``keep``."""
    return F.aggregate(
        hashes,
        F.lit(0).cast("bigint"),
        lambda a, h: (a + F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(field))).bitwiseAND(F.lit(keep)),
    )


def _equality_lanes(p: Column, seed: int) -> Column:
    return let(_hashes(p, seed), lambda h: F.array(*[_sum_lanes(h, k, M32, M32) for k in (0, 32)]))


def _sketch_lanes(p: Column, seed: int) -> Column:
    """21 longs of three lanes: how many paragraphs have each of 63 hash bits."""
    return let(
        _hashes(p, 100 + seed), lambda h: F.array(*[_sum_lanes(h, k, FIELD, KEEP) for k in range(21)])
    )


def fingerprint(text: Column) -> Column:
    """Struct (n, lanes): the number of paragraphs and all lanes of ``text``."""
    return let(
        paragraphs(text),
        lambda p: F.struct(
            F.size(p).cast("bigint").alias("n"),
            F.concat(
                *[_equality_lanes(p, s) for s in range(EQUALITY_SEEDS)],
                *[_sketch_lanes(p, s) for s in range(SKETCH_SEEDS)],
            ).alias("lanes"),
        ),
    )


def _each(a: Column, b: Column, sign: int) -> Column:
    """Lane by lane sum or difference, each lane modulo its power of two."""
    if sign > 0:
        eq, sk = (lambda x, y: (x + y).bitwiseAND(F.lit(M32))), (lambda x, y: (x + y).bitwiseAND(F.lit(KEEP)))
    else:
        # A guard bit above each lane stops a borrow; it is masked off after.
        guard = F.lit(FIELD << 20)
        eq = lambda x, y: (x + F.lit(1 << 32) - y).bitwiseAND(F.lit(M32))
        sk = lambda x, y: (x.bitwiseOR(guard) - y).bitwiseAND(F.lit(KEEP))
    head, tail = 2 * EQUALITY_SEEDS, 21 * SKETCH_SEEDS
    return F.struct(
        (a["n"] + sign * b["n"]).alias("n"),
        F.concat(
            F.zip_with(F.slice(a["lanes"], 1, head), F.slice(b["lanes"], 1, head), eq),
            F.zip_with(F.slice(a["lanes"], head + 1, tail), F.slice(b["lanes"], head + 1, tail), sk),
        ).alias("lanes"),
    )


def add(a: Column, b: Column) -> Column:
    """The fingerprint of both multisets together."""
    return _each(a, b, 1)


def subtract(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the paragraphs of ``b``, which it holds."""
    return _each(a, b, -1)


def as_text(fp: Column) -> Column:
    """Lowercase hex of all lanes."""
    head = 2 * EQUALITY_SEEDS
    return F.lower(
        F.concat(
            F.array_join(F.transform(F.slice(fp["lanes"], 1, head), lambda x: F.lpad(F.hex(x), 8, "0")), ""),
            F.array_join(
                F.transform(
                    F.slice(fp["lanes"], head + 1, 21 * SKETCH_SEEDS), lambda x: F.lpad(F.hex(x), 16, "0")
                ),
                "",
            ),
        )
    )


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two fingerprints' +1/-1 lanes, cut to 0..1; 1 if all lanes are equal."""
    head = 2 * EQUALITY_SEEDS

    def signed(fp: Column) -> Column:
        sketch = F.slice(fp["lanes"], head + 1, 21 * SKETCH_SEEDS)
        return F.flatten(
            F.transform(
                sketch,
                lambda x: F.array(
                    *[
                        2.0 * F.shiftrightunsigned(x, 21 * j).bitwiseAND(F.lit(LANE)) - fp["n"]
                        for j in range(LANES)
                    ]
                ),
            )
        )

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    def cosine(x: Column, y: Column) -> Column:
        norms = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
        return F.when(norms > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(x, y) / norms))).otherwise(
            F.lit(0.0)
        )

    return F.when(a["lanes"] == b["lanes"], F.lit(1.0)).otherwise(
        let(signed(a), lambda x: let(signed(b), lambda y: cosine(x, y)))
    )


def with_next(docs: DataFrame, columns: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Each row of ``docs`` (doc_id, text, ...) with ``next``: the next document's columns.

    Ids are dealt into ranges of equal width, about ``rows_per_bucket`` rows each
    where ids are spread evenly; ``lead`` within a range, and the last row of each
    range takes the first of the next range that has rows. Only one row per range
    crosses ranges, so no task holds the whole order.
    """
    ends = docs.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, hi = ends["lo"] or 0, ends["hi"] or 0
    width = max(1, (hi - lo + 1) * rows_per_bucket // max(1, ends["n"]))
    bucket = F.coalesce(
        F.floor((F.lit(hi) - F.col("doc_id")) / F.lit(width)), F.lit((hi - lo) // width + 1)
    ).cast("bigint")
    order = Window.partitionBy("_bucket").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    payload = F.struct(*columns)
    rows = docs.withColumn("_bucket", bucket).withColumns(
        {"next": F.lead(payload).over(order), "_first": F.row_number().over(order) == 1}
    )
    firsts = rows.where("_first").select(F.col("_bucket").alias("_to"), payload.alias("_head"))
    by_bucket = Window.orderBy("_to")
    whole = Window.partitionBy()
    # One long per range; the first range follows the last.
    hops = firsts.select("_to").select(
        "_to", F.coalesce(F.lag("_to").over(by_bucket), F.max("_to").over(whole)).alias("_bucket")
    )
    heads = hops.join(firsts, "_to").select("_bucket", "_head")
    return rows.join(heads, "_bucket").withColumn("next", F.coalesce("next", "_head")).drop(
        "_bucket", "_first", "_head"
    )


def op10_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text"))
    rows = with_next(docs.withColumn("fp", fingerprint(F.col("text"))), ["text", "fp"])
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substr(F.col("text"), F.lit(1), n - third), F.substr(F.col("next")["text"], F.lit(1), third)
    )
    rows = rows.select("doc_id", n.cast("bigint").alias("n_chars"), "fp", F.col("next")["fp"].alias("next_fp"),
                       edited.alias("edited"))
    rows = rows.select(
        "doc_id", "n_chars", "fp", "next_fp", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("edited")).alias("edited_fp"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
