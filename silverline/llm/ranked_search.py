"""Ranked lexical search over a length-stratified index.

The length normaliser ``m`` is an integer, so documents fall into strata of equal ``m``.
Within a stratum the impact of a term depends on ``tf`` alone,

    impact = (1000000000 * tf) div (1000 * tf + 8 * m),

and is computed once per ``tf``. The index is a written table of stratum blocks (at most
``BLOCK`` documents of one stratum), each with its postings ordered by term and ``tf``:
for every (term, tf) the places of the documents that have the term so often.

A search block is a bounded set of items (at most about ``ITEMS`` items and ``ENTRIES``
distinct item terms; larger query sets are searched block by block). Per search block:

1. one pass over all texts counts each document's terms; df, N and L are aggregates of it;
2. documents get their ``m``, are dealt by ranges of (m, row) - so a frequent length is cut over
   many tasks - and are written as stratum blocks;
3. the best tf of each term bounds what any document of a block can score; per item the blocks with
   the highest bounds are visited first, which gives a score that ten documents reach (the floor);
4. all blocks are passed in order of their bounds; an item skips every block whose bound is
   below its floor, which rises with what a task has found. Bounds equal to the floor are visited, so ties
   are decided by ``doc_id`` and no result is lost.

The index holds the terms that the items ask for (a document with none of them scores 0 and has no
posting); N, L and lengths count all terms of all documents. Sums stay exact: they are
held in doubles only where no score can reach 2^53, else in 64-bit integers.

To the driver come an item block, its df (at most one row per asked term) and ten rows per
item; every task sends ten rows per item at most.

Edges: null and empty texts have no term and are not counted in N; an item without terms, or whose
terms no document has, gives no row; rows of ``items`` with one ``item_id`` (nulls too) are
one item with all their terms; repeated rows of documents are ranked each, next to each other; a
null ``doc_id`` comes last among equal scores; empty tables give no rows. Further columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from silverline.llm.common import read, remove_folder, slices
from silverline.session import scratch_path

TOP = 10
SCALE, TF_WEIGHT, M_WEIGHT = 1_000_000_000, 1000, 8  # fixed values of the score
SLOPE = 75  # per cent of m that goes with length
BLOCK = 1024  # documents in a stratum block
ITEMS, ENTRIES = 128, 8192  # aimed at in a search block; its dense tables stay within tens of MB
CELLS = 4_000_000  # of a dense table of documents by terms

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and anything beyond ASCII; only A-Z are folded."""
    return text.translate(_FOLD).split()


def _bytes(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column, "").cast(pa.binary()).to_pylist()


@dataclass
class Query:
    """A search block: its terms numbered, and what each item gives to a term."""

    items: list  # item ids
    entries: list[tuple[int, int, int]]  # item, term, occurrences in the item
    vocabulary: dict[bytes, int]
    weights: np.ndarray = field(default=None)  # per term
    documents: int = 0
    length: int = 0

    def table(self) -> np.ndarray:
        """Terms by items: occurrences times weight. Doubles if all scores are exact in them."""
        out = np.zeros((len(self.vocabulary), len(self.items)), np.int64)
        for item, term, n in self.entries:
            out[term, item] = n * self.weights[term]
        exact = not len(out) or int(out.sum(axis=0).max()) * (SCALE // TF_WEIGHT) < 2**53
        return out.astype(np.float64) if exact else out


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, n) of all items, with the search block each item falls into."""
    kind = items.schema["item_id"].dataType

    def run(batches):
        for batch in slices(batches, 1):
            counts = [Counter(terms(t)) for t in _bytes(batch.column(1))]
            at = pa.array(np.repeat(np.arange(len(counts)), [len(c) for c in counts]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    pa.array([t for c in counts for t in c], pa.binary()),
                    pa.array([n for c in counts for n in c.values()], pa.int64()),
                ],
                ["item_id", "term", "n"],
            )

    schema = T.StructType(
        [T.StructField("item_id", kind), T.StructField("term", T.BinaryType()), T.StructField("n", T.LongType())]
    )
    return items.select("item_id", "text").mapInArrow(run, schema).groupBy("item_id", "term").agg(F.sum("n").alias("n"))


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), and the asked terms with their tf, of every document with a term."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a search block's terms

    def run(batches):
        place = known.value
        for batch in slices(batches, 1):
            lengths, found = [], []
            for text in _bytes(batch.column(1)):
                words = terms(text)
                lengths.append(len(words))
                found.append([(place[w], n) for w, n in Counter(words).items() if w in place])
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.array([[t for t, _ in f] for f in found], pa.list_(pa.int32())),
                    pa.array([[n for _, n in f] for f in found], pa.list_(pa.int32())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )
            yield out.filter(pc.greater(out.column(1), 0))

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("tfs", T.ArrayType(T.IntegerType())),
        ]
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def stratum_blocks(counted: DataFrame, query: Query) -> DataFrame:
    """The index: blocks of documents of equal m, postings by term and tf."""
    n, total = F.lit(query.documents).cast("long"), F.lit(query.length).cast("long")
    held = counted.filter(F.size("terms") > 0).select(
        (F.lit(100 - SLOPE) + F.call_function("div", F.lit(SLOPE).cast("long") * F.col("n") * n, total)).alias("m"),
        "rid",
        "doc_id",
        "terms",
        "tfs",
    )

    def run(batches):
        for batch in batches:
            m = batch.column(0).to_numpy()
            sizes = pc.list_value_length(batch.column(3)).to_numpy()
            term, tf = batch.column(3).flatten().to_numpy(), batch.column(4).flatten().to_numpy()
            ends = np.concatenate([[0], np.cumsum(sizes)])
            starts = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]])) if len(m) else np.array([], int)
            rows = []
            for a, z in zip(starts, [*starts[1:], len(m)], strict=True):
                for lo in range(a, z, BLOCK):
                    hi = min(lo + BLOCK, z)
                    t, f = term[ends[lo] : ends[hi]], tf[ends[lo] : ends[hi]]
                    who = np.repeat(np.arange(hi - lo, dtype=np.int32), sizes[lo:hi])
                    order = np.lexsort((who, f, t))
                    t, f = t[order], f[order]
                    heads = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (f[1:] != f[:-1])]))
                    rows.append((int(m[lo]), int(batch.column(1)[lo].as_py()), lo, hi, t[heads], f[heads],
                                 np.diff([*heads, len(t)]).astype(np.int32), who[order]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array([0, *(r[3] for r in rows)], pa.int32()), batch.column(2)
                    ) if rows else pa.array([], pa.list_(batch.schema.field(2).type)),
                    *(pa.array([r[i] for r in rows], pa.list_(pa.int32())) for i in (4, 5, 6, 7)),
                ],
                ["m", "block", "doc_ids", "term", "tf", "size", "members"],
            )

    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [
            T.StructField("m", T.LongType()),
            T.StructField("block", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(counted.schema["doc_id"].dataType)),
            *(T.StructField(c, ints) for c in ("term", "tf", "size", "members")),
        ]
    )
    return held.repartitionByRange("m", "rid").sortWithinPartitions("m", "rid").mapInArrow(run, schema)


class Block:
    """One row of the index in numpy."""

    def __init__(self, batch: pa.RecordBatch, row: int, table: np.ndarray):
        self.id = batch.column(1)[row].as_py()
        self.doc_ids = batch.column(2)[row].values
        term, tf, self.size, self.members = (batch.column(i)[row].values.to_numpy() for i in (3, 4, 5, 6))
        m = batch.column(0)[row].as_py()
        distinct, at = np.unique(tf.astype(np.int64), return_inverse=True)
        self.impact = ((SCALE * distinct) // (TF_WEIGHT * distinct + M_WEIGHT * m))[at]  # once per tf
        self.columns, self.column = np.unique(term, return_inverse=True)
        self.table = table  # the task's: its blocks are held together, so none copies its part
        last = np.flatnonzero(np.concatenate([term[1:] != term[:-1], [True]]))  # the greatest tf of each term
        self.bounds = self.impact[last].astype(table.dtype) @ table[self.columns]

    def scores(self, items: np.ndarray) -> np.ndarray:
        """Documents by ``items``."""
        table = self.table[np.ix_(self.columns, items)]
        out = np.empty((len(self.doc_ids), len(items)), table.dtype)
        step = max(1, CELLS // max(1, len(self.columns)))
        column, impact = np.repeat(self.column, self.size), np.repeat(self.impact, self.size)
        for lo in range(0, len(out), step):
            here = (self.members >= lo) & (self.members < lo + step)
            dense = np.zeros((min(step, len(out) - lo), len(self.columns)), table.dtype)
            dense[self.members[here] - lo, column[here]] = impact[here]
            out[lo : lo + len(dense)] = dense @ table
        return out


class Best:
    """The best documents of every item, and the score from which one can still be among them."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k = np.maximum(floor, 1), k
        self.rows = [[] for _ in floor]

    def take(self, block: Block, items: np.ndarray) -> None:
        scores = block.scores(items)
        for column, item in enumerate(items):
            s = scores[:, column]
            near = np.flatnonzero(s >= self.floor[item])
            if len(near) > self.k:
                near = near[s[near] >= np.partition(s[near], -self.k)[-self.k]]
            if not len(near):
                continue
            ids = block.doc_ids.take(pa.array(near)).to_pylist()
            rows = self.rows[item] + [(-int(s[i]), d is None, d) for i, d in zip(near, ids, strict=True)]
            rows.sort(key=lambda r: r[:2] if r[1] else r)
            self.rows[item] = rows[: self.k]
            if len(rows) >= self.k:
                self.floor[item] = max(self.floor[item], -self.rows[item][-1][0])


def _visit(index: DataFrame, query, floor: np.ndarray, k: int) -> DataFrame:
    """(item, doc_id, score): per task at most k documents of each item that reach its floor."""
    kind = index.schema["doc_ids"].dataType.elementType

    def run(batches):
        table = query.value.table()
        best = Best(floor, k)
        arrow_type = None
        for batch in batches:
            arrow_type = batch.schema.field(2).type.value_type
            blocks = [Block(batch, row, table) for row in range(len(batch))]
            for block in sorted(blocks, key=lambda b: -float(b.bounds.max(initial=0))):
                alive = np.flatnonzero(block.bounds >= best.floor)
                if len(alive):
                    best.take(block, alive)
        rows = [(i, d, -s) for i, found in enumerate(best.rows) for s, _, d in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([r[1] for r in rows], arrow_type),
                    pa.array([r[2] for r in rows], pa.int64()),
                ],
                ["item", "doc_id", "score"],
            )

    schema = T.StructType(
        [T.StructField("item", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())]
    )
    return index.mapInArrow(run, schema)


def _first_blocks(index: DataFrame, query, k: int) -> list[int]:
    """The k blocks with the highest bounds of every item."""

    def run(batches):
        table = query.value.table()
        best = [[] for _ in range(table.shape[1])]
        for batch in batches:
            for row in range(len(batch)):
                block = Block(batch, row, table)
                for item in np.flatnonzero(block.bounds > 0):
                    best[item].append((float(block.bounds[item]), block.id))
            best = [sorted(b, reverse=True)[:k] for b in best]
        rows = [(i, *r) for i, b in enumerate(best) for r in b]
        if rows:
            yield pa.RecordBatch.from_pylist([{"item": i, "bound": b, "block": x} for i, b, x in rows],
                pa.schema([("item", pa.int32()), ("bound", pa.float64()), ("block", pa.int64())]))

    bounds = index.mapInArrow(run, "item int, bound double, block long")
    place = Window.partitionBy("item").orderBy(F.desc("bound"), "block")
    chosen = bounds.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k)
    return [r[0] for r in chosen.select("block").distinct().collect()]  # k per item


def _ranked(found: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents."""
    spark = docs.sparkSession
    folder, path = scratch_path(spark, "ranked-search"), scratch_path(spark, "ranked-search-result")
    kind = items.schema["item_id"].dataType
    asked = item_terms(items)
    asked.write.parquet(f"{folder}/items")
    asked = spark.read.schema(asked.schema).parquet(f"{folder}/items")
    size = asked.agg(F.count("*"), F.count_distinct(F.struct("item_id"))).first()
    n_blocks = max(1, math.ceil(size[0] / ENTRIES), math.ceil(size[1] / ITEMS))
    names = T.StructType([T.StructField("item_id", kind), T.StructField("item", T.IntegerType())])
    schema = T.StructType(
        [
            T.StructField("item_id", kind),
            T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    for number in range(n_blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == number).collect()  # a search block
        if not rows:
            continue
        ids, vocabulary = {}, {}
        entries = [
            (ids.setdefault(r["item_id"], len(ids)), vocabulary.setdefault(bytes(r["term"]), len(vocabulary)), r["n"])
            for r in rows
        ]
        query = Query(list(ids), entries, vocabulary)
        counted = count_terms(docs, vocabulary).withColumn("rid", F.monotonically_increasing_id())
        counted.write.parquet(f"{folder}/counted-{number}")
        counted = spark.read.schema(counted.schema).parquet(f"{folder}/counted-{number}")
        total = counted.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
        if not total["n"]:
            break
        query.documents, query.length = total["n"], total["l"]
        query.weights = np.zeros(len(vocabulary), np.int64)
        for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per asked term
            query.weights[r["t"]] = math.floor(1000 * math.log((2 * query.documents + 2) / (2 * r["count"] + 1)))
        index = stratum_blocks(counted, query)
        index.write.parquet(f"{folder}/index-{number}")
        index = spark.read.schema(index.schema).parquet(f"{folder}/index-{number}")

        shared = spark.sparkContext.broadcast(query)
        none = np.zeros(len(ids), np.int64)
        first = index.filter(F.col("block").isin(_first_blocks(index, shared, k)))
        floor = none.copy()
        for r in _ranked(_visit(first, shared, none, k), "item", k).filter(F.col("rank") == k).collect():
            floor[r["item"]] = r["score"]
        found = _ranked(_visit(index, shared, floor, k), "item", k)
        numbered = spark.createDataFrame([(x, i) for x, i in ids.items()], names)  # a search block's ids
        found.join(F.broadcast(numbered), "item").select(*schema.names).write.mode("append").parquet(path)
        remove_folder(spark, f"{folder}/counted-{number}")
        remove_folder(spark, f"{folder}/index-{number}")
    remove_folder(spark, folder)
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
