"""Operator 8: n-gram Jaccard join by several global token orders.

A document's set is that of its distinct shingles, as 64-bit hashes. Two sets
link when 100 * |A and B| >= percent * |A or B|. In any global order of the
tokens, two linked sets share a token among the first n - ceil(percent n / 100) + 1
of each (its prefix). Candidates must do so under every one of ``ORDERS`` orders:

- All orders put rare tokens first, by one estimate of rarity, and differ in a hash within a
  level. The estimate counts over all documents the shingles that make up more than ``RARE``
  of some chunk of sets, so at most 1 / RARE per chunk: passages that a share of the
  corpus has come last, and documents that have no more in common meet nowhere. Any estimate
  gives the same links, only at another cost.
- Equal sets are one class from the start. The classes are joined on the tokens
  of the first order; tokens of a single class drop out in a count. Sizes and token
  positions bound the overlap that a pair can still have.
- Each class has a bitmap: per bit, whether an odd number of its tokens falls there. Two bitmaps differ in
  at most as many bits as the sets differ in tokens, so pairs whose bitmaps differ in more than a link
  allows are dropped, in the second meeting before they are made.
- Only of the classes in pairs that are left one text each is read again, for the whole sets and the
  prefixes under the other orders, which must overlap too.

No group's pairs are all made. First every class meets only the most central
class of each of its tokens; the links found give components. Then, per token,
classes outside the component of its central class meet the others of another
component. What is left unmade are pairs inside one component, so the components
are those of all links.

Class ids are 64-bit hashes of sorted sets; a collision, as of two shingles, is
not looked for (of 10^9 sets, one with a chance of 3 %).

Defined results: null, empty and blank texts have an empty set and link with
nothing; with fewer words than a shingle has, the whole sequence is the only
one. Rows that repeat a doc_id are documents of their own, labelled alike; a null doc_id counts
as larger than any other, and a group of only such has a null component. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm.common import read, remove_folder, with_results
from silverline.llm.components import components
from silverline.session import scratch_path

ORDERS = 3
TABLE_BITS = 23
PART = 1 << 16  # cells that are summed up together
COUNTERS = 256
LEVELS, STEPS = 255, 8  # levels, and how many to a doubling
FEW = 1 << 18  # longs that are broadcast
BITS = 9  # a bitmap has 2^BITS bits
# Odd multipliers of the orders' hashes.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def token_levels(docs: DataFrame, words: int) -> bytes:
    """Level of each cell of shingle hashes: a logarithm of how many members of all sets fall there.

    No shingle is in more sets than its cell has members, so those of the lowest levels are rare. Tables have
    2^TABLE_BITS cells whatever the corpus, at most ``COUNTERS`` tasks make one each, and the driver
    gets one byte a cell.
    """

    def count(frames):
        shingler = Shingler(None, words, 0)
        cells = np.zeros(1 << TABLE_BITS, np.uint32)
        for pdf in frames:
            for text in pdf["text"]:
                np.add.at(cells, shingler.shingles(text) & np.uint64((1 << TABLE_BITS) - 1), 1)
        for i, part in enumerate(cells.reshape(-1, PART)):
            if part.any():
                packed = zlib.compress(part.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)
                yield pd.DataFrame({"part": [i], "cells": [packed]})

    def sums(key, pdf):
        n = np.zeros(PART, np.int64)
        for packed in pdf["cells"]:
            n += np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0]
        level = np.clip(STEPS * np.log2(np.maximum(n, 1)), 0, LEVELS).astype(np.uint8)
        return pd.DataFrame({"part": [key[0]], "levels": [zlib.compress(level.tobytes(), 1)]})

    counted = docs.select("text").coalesce(COUNTERS).mapInPandas(count, "part int, cells binary")
    table = np.zeros((1 << TABLE_BITS) // PART * PART, dtype=np.uint8).reshape(-1, PART)
    for r in counted.groupBy("part").applyInPandas(sums, "part int, levels binary").collect():  # PART cells each
        table[r["part"]] = np.frombuffer(zlib.decompress(r["levels"]), np.uint8)
    return table.tobytes()


class Shingler:
    """Sets and prefixes of texts; one per task."""

    def __init__(self, levels: bytes | None, words: int, percent: int):
        self.levels = np.frombuffer(levels, dtype=np.uint8) if levels else None
        self.words, self.percent = words, percent

    def shingles(self, text) -> np.ndarray:
        """Sorted distinct shingle hashes (uint64)."""
        words = text.encode("utf-8", "replace").lower().split() if isinstance(text, str) else []
        n = len(words)
        if not n:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
        k = min(self.words, n)
        out = np.full(n - k + 1, k, dtype=np.uint64)
        for i in range(k):
            out = (out ^ h[i : n - k + 1 + i]) * np.uint64(MIX[0])
            out ^= out >> np.uint64(29)
        return np.unique(out)

    def prefixes(self, tokens: np.ndarray, orders: int = ORDERS) -> list[np.ndarray]:
        """The prefix of the set under each of the first ``orders`` orders, in that order."""
        n = len(tokens)
        level = self.levels[tokens & np.uint64((1 << TABLE_BITS) - 1)]
        size = n - -(-self.percent * n // 100) + 1 if n else 0
        out = []
        for mix in MIX[:orders]:
            key = (tokens * np.uint64(mix)) >> np.uint64(8)
            key |= level.astype(np.uint64) << np.uint64(56)
            best = np.argpartition(key, size - 1)[:size] if size < n else np.arange(n)
            out.append(tokens[best[np.argsort(key[best], kind="stable")]])
        return out


def set_key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def parities(tokens: np.ndarray) -> np.ndarray:
    """The bitmap of a set, as longs."""
    at = ((tokens * np.uint64(MIX[2])) >> np.uint64(64 - BITS)).astype(np.int64)
    odd = (np.bincount(at, minlength=1 << BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def sketches(docs: DataFrame, keep: list[str], levels, words: int, percent: int) -> DataFrame:
    """``keep`` columns, key, n, the prefix under the first order and the bitmap, per row."""
    longs = T.ArrayType(T.LongType())
    fields = [T.StructField("key", T.LongType()), T.StructField("n", T.IntegerType())]
    fields += [T.StructField("prefix", longs), T.StructField("bits", longs)]

    def setup():
        shingler = Shingler(levels.value, words, percent)

        def step(pdf):
            sets = [shingler.shingles(t) for t in pdf["text"]]
            return {
                "key": [set_key(s) for s in sets],
                "n": [len(s) for s in sets],
                "prefix": [_signed(shingler.prefixes(s, 1)[0]) for s in sets],
                "bits": [parities(s) for s in sets],
            }

        return step

    return with_results(docs.select(*keep, "text"), keep, "text", fields, setup)


def whole_sets(docs: DataFrame, levels, words: int, percent: int) -> DataFrame:
    """key, tokens and the prefixes under the orders after the first, of every text."""
    longs = T.ArrayType(T.LongType())
    fields = [T.StructField("key", T.LongType()), T.StructField("tokens", longs)]
    fields += [T.StructField("others", T.ArrayType(longs))]

    def setup():
        shingler = Shingler(levels.value, words, percent)

        def step(pdf):
            sets = [shingler.shingles(t) for t in pdf["text"]]
            return {
                "key": [set_key(s) for s in sets],
                "tokens": [_signed(s) for s in sets],
                "others": [[_signed(x) for x in shingler.prefixes(s)[1:]] for s in sets],
            }

        return step

    return with_results(docs.select("text"), [], "text", fields, setup)


def _sizes_allow(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _overlap_allows(n: Column, i: Column, m: Column, j: Column, percent: int) -> Column:
    """Whether sets whose i-th and j-th tokens are their first common ones may still link."""
    need = percent * (n + m)
    return ((100 + percent) * (n - i) >= need) & ((100 + percent) * (m - j) >= need)


def _bitmaps_allow(x: Column, y: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether sets of n and m tokens with these bitmaps may link: they then differ in few enough tokens."""
    differ = sum((F.bit_count(F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))) for k in range((1 << BITS) // 64)), F.lit(0))
    return (100 + percent) * differ <= (100 - percent) * (n + m)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()


def _only(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is in ``wanted``, a written table: without a shuffle of the rows if it is small."""
    small = wanted.count() <= FEW
    return rows.join(F.broadcast(wanted) if small else wanted, key, "left_semi")


def _close(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose bitmaps allow a link."""

    def side(name: str) -> DataFrame:
        return classes.select(F.col("key").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(_bitmaps_allow(F.col("bits_a"), F.col("bits_b"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def _verified(docs: DataFrame, pairs: DataFrame, marks: DataFrame, levels, words: int, percent: int):
    """The pairs (a, b) of classes that link: prefixes overlap under every order, and whole sets decide.

    ``docs`` has the column ``mark``; the rows with one of ``marks`` are read, equal rows as one.
    """
    texts = _only(docs, marks, "mark").groupBy("mark").agg(F.first("text").alias("text"))
    sets = whole_sets(texts, levels, words, percent)

    def side(name: str) -> DataFrame:
        return sets.select(F.col("key").alias(name), F.col("tokens").alias(f"t_{name}"), F.col("others").alias(f"o_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    for k in range(ORDERS - 1):
        both = both.where(F.arrays_overlap(F.get("o_a", F.lit(k)), F.get("o_b", F.lit(k))))
    shared = F.size(F.array_intersect("t_a", "t_b"))
    union = F.size("t_a") + F.size("t_b") - shared
    return both.where(100 * shared >= percent * union).select("a", "b").distinct()


def join(
    docs: DataFrame, words: int = 3, percent: int = 90, mark: str | None = None, folder: str | None = None
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, class ``key``, the component's
    least key ``root`` and, if there is one, the column ``mark``, equal on equal rows only.

    What the rows are read from lies in ``folder``."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "jaccard")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def done(*names: str) -> None:
        for name in names:
            remove_folder(spark, f"{folder}/{name}")

    def linked(close: DataFrame, name: str) -> DataFrame:
        marks = classes.join(_ends(close), "key").select(F.col("rep").alias("mark")).distinct()
        return _verified(docs, close, stored(marks, f"marks-{name}"), levels, words, percent)

    own = F.col(f"`{mark}`") if mark else F.xxhash64("doc_id", F.col("doc_id").isNull(), "text")
    docs = docs.select("doc_id", "text", own.alias("mark"))
    levels = spark.sparkContext.broadcast(token_levels(docs, words))
    rows = stored(sketches(docs, ["doc_id", "mark"], levels, words, percent), "rows")
    classes = stored(
        rows.where("n > 0").groupBy("key").agg(
            F.min("doc_id").alias("least_id"), F.min("mark").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits")
        ),
        "classes",
    )
    # One long for size and position keeps the widest shuffle narrow. Copies of a
    # class stay in until the few tokens are left that two classes share.
    index = rows.select("key", "n", F.posexplode("prefix").alias("pos", "token")).select(
        "token", "key", (F.shiftleft(F.col("n").cast("bigint"), 32) + F.col("pos")).alias("size_pos")
    )
    often = (
        index.groupBy("token")
        .agg(F.min("key").alias("least"), F.max("key").alias("most"))
        .where("least <> most")
    )
    hits = stored(
        index.join(often.select("token"), "token", "left_semi").dropDuplicates(["token", "key"]).select(
            "token", "key", F.shiftright("size_pos", 32).cast("int").alias("n"),
            F.col("size_pos").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("pos"),
        ),
        "hits",
    )
    # The most central class of a token is the one with the largest share of
    # tokens that others have too: of copies, the one with the fewest changes.
    shared = hits.groupBy("key").agg(F.count(F.lit(1)).alias("in_hits"))
    common = classes.join(shared, "key").select("key", (F.col("in_hits") / F.col("n")).alias("common"))
    central = stored(
        hits.join(common, "key")
        .groupBy("token")
        .agg(F.max(F.struct("common", "key", "n", "pos")).alias("c"))
        .select("token", *[F.col("c")[x].alias(f"hub_{x}") for x in ("key", "n", "pos")]),
        "central",
    )
    near = hits.join(central, "token").where(
        (F.col("key") != F.col("hub_key"))
        & _sizes_allow(F.col("n"), F.col("hub_n"), percent)
        & _overlap_allows(F.col("n"), F.col("pos"), F.col("hub_n"), F.col("hub_pos"), percent)
    )
    first = near.select(F.least("key", "hub_key").alias("a"), F.greatest("key", "hub_key").alias("b")).distinct()
    first = stored(_close(first, classes, percent), "pairs-1")
    links = stored(linked(first, "1"), "links-1")
    roots = components(links)

    placed = stored(
        hits.join(roots, F.col("key") == F.col("node"), "left").select(
            "token", "key", "n", "pos", F.coalesce("root", "key").alias("root")
        ),
        "placed",
    )
    done("hits")
    hubs = central.join(roots, F.col("hub_key") == F.col("node"), "left").select(
        "token", F.coalesce("root", "hub_key").alias("hub_root")
    )
    outside = placed.join(hubs, "token").where("root <> hub_root").select("token", "hub_root", "key", "n", "pos", "root")
    outside = stored(outside, "outside")
    done("central")
    bitmaps = classes.select("key", "bits")
    open_ = outside.select("token").distinct()
    members = placed.join(open_, "token", "left_semi").join(bitmaps, "key")
    others = outside.join(bitmaps, "key").select(
        "token", "hub_root", *[F.col(c).alias(f"x_{c}") for c in ("key", "n", "pos", "root", "bits")]
    )
    met = members.join(others, "token").where(
        (F.col("root") != F.col("x_root"))
        & ((F.col("key") < F.col("x_key")) | (F.col("root") == F.col("hub_root")))
        & _sizes_allow(F.col("n"), F.col("x_n"), percent)
        & _overlap_allows(F.col("n"), F.col("pos"), F.col("x_n"), F.col("x_pos"), percent)
        & _bitmaps_allow(F.col("bits"), F.col("x_bits"), F.col("n"), F.col("x_n"), percent)
    )
    second = met.select(F.least("key", "x_key").alias("a"), F.greatest("key", "x_key").alias("b")).distinct()
    second = stored(second.join(first, ["a", "b"], "left_anti"), "pairs-2")
    done("placed", "outside")
    if not second.isEmpty():
        links = stored(links.unionByName(linked(second, "2")), "links")
        roots = components(links)

    labelled = classes.join(roots, F.col("key") == F.col("node"), "left").select(
        "key", "least_id", F.coalesce("root", "key").alias("root")
    )
    least = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_class = labelled.join(least, "root").select("key", "component_id", "root")
    return rows.join(by_class, "key", "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "key",
        "root",
        *([F.col("mark").alias(mark)] if mark else []),
    )


def op8_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return join(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``docs``, and every row without words.

    The row that stays has the component's least doc_id, a null one only where no
    row has another; of several such rows one by hash of all columns, of equal rows one.
    """
    mark = "row_mark"
    while mark in docs.columns:
        mark += "_"
    # Hashes pass over nulls, so it is hashed too which columns are null.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn(mark, F.xxhash64(*columns, *[c.isNull() for c in columns]))
    path = scratch_path(docs.sparkSession, "keep")
    folder = scratch_path(docs.sparkSession, "jaccard")
    linked = join(marked, words, percent, mark, folder).where("n_shingles > 0")
    linked.groupBy("root", "doc_id", mark).agg(F.count(F.lit(1)).alias("copies")).write.parquet(path)
    remove_folder(docs.sparkSession, folder)
    kinds = docs.sparkSession.read.parquet(path)
    best = kinds.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", mark)).alias("best")
    )
    stays = best.select(F.col("best")[mark].alias(mark), F.lit(True).alias("stays"))
    judged = kinds.join(stays, mark, "left").select(mark, "copies", F.col("stays").isNotNull().alias("stays"))
    once = marked.join(judged.where(~F.col("stays") | (F.col("copies") > 1)).select(mark), mark, "left_anti")
    again = judged.where(F.col("stays") & (F.col("copies") > 1)).select(mark)
    if again.isEmpty():
        return once.select(docs.columns)
    # Equal rows are one before they are shuffled.
    copies = marked.join(again, mark, "left_semi").dropDuplicates()
    return once.unionByName(copies).select(docs.columns)
