"""Best-fit packing of token pieces after a Martello-Toth reduction.

Lengths are whole numbers up to the capacity, so an instance of any size is a table of at
most ``CAPACITY`` counts. That table, not the pieces, is reduced and packed on the driver; the pieces stay
where they are and look their place up:

1. tasks tokenize the texts, cut documents longer than the capacity, and number their pieces of each
   length as they come (``local``); the pieces are written;
2. per length, a running sum over the tasks' counts turns the local numbers into ranks;
3. the counts are packed (below), which gives runs: ``n`` pieces of one length, from a rank on,
   ``per_bin`` in each sequence from ``first_bin`` on, at one ``offset``;
4. a piece of (length, rank) finds its run by binary search. Runs are broadcast; their number
   follows from the distinct lengths and not from the pieces.

Reduction (Martello and Toth): a feasible set of pieces that dominates every other feasible set with
the same largest piece j - each other set can be split into parts that fit under different pieces of
it - is in some best packing, so it is fixed and its pieces leave the instance. Sets of up
to three are tested, ``r`` being what j leaves free:

* nothing else fits: {j};
* some piece is exactly r: {j, r} dominates all;
* no two others fit: {j, x}, x the largest that fits;
* no three others fit: {j, x} if x is at least the largest pair that fits; else {j, x, y}, y the largest
  that fits beside both, if no pair that fits has a smaller member above y.

Conditions stay true as pieces leave, so all copies that can be fixed are fixed at once, and
passes go on until nothing changes. The remainder is packed best-fit by descending length, whole
groups of sequences with the same free room at a time.

Chunks between ASCII white space are encoded by themselves and remembered per worker, which gives the
ids that encoding the whole text gives, for tokenizers that never join across white space (tested).

Edges: a null or empty text is the end id alone (one piece of length 1); ``doc_id`` passes
through untouched (nulls, repeated ids and rows are documents of their own); an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

import gc
import os
import re
import unicodedata
import zlib
from bisect import bisect_left, insort
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from silverline.llm.common import read, slices
from silverline.session import scratch_path

CAPACITY = 4096
END = 1
REMEMBERED = 1 << 19  # chunks that a worker remembers before it starts anew
REMEMBERED_PARTS = 1 << 19  # and parts of them
TOGETHER = 500  # words encoded at a time
RUNS = re.compile("[a-z]+|[^a-z]+")


class Chunks:
    """Token ids of texts, chunk by chunk.

    A chunk without apostrophes is cut further where letters meet other signs, if the tokenizer
    does so too; a word with another case or sign beside it is then known. Words of small ASCII letters
    go straight to the tokenizer's model, as nothing before it changes them. Other words are encoded
    many at a time: a token that ends in the vocabulary's suffix ends its word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.word_end[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.cut = bool(suffix) and self._cuts_at_signs()
        self.parts: dict[str, bytes] = {}
        self._clear()

    def _cuts_at_signs(self) -> bool:
        """Whether the tokenizer folds case, keeps letters apart from other signs and hands words to its model as they are."""
        for word in ("abcdefghijklm", "nopqrstuvwxyz"):
            ids = [t.id for t in self.tokenizer.model.tokenize(word)]
            if ids != self.tokenizer.encode(word, add_special_tokens=False).ids:
                return False
        signs = [chr(c) for c in range(33, 127) if not chr(c).isalpha() and chr(c) != "'"]
        pairs = [("aB" + x + "Cd", "ab " + x + " cd") for x in signs]
        return all(
            a.ids == b.ids
            for a, b in zip(*(self.tokenizer.encode_batch(list(t), add_special_tokens=False) for t in zip(*pairs)), strict=True)
        )

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        # Slot 0 is the end id.
        self.pool, self.starts, self.sizes = np.array([END], np.uint32), np.zeros(1, np.int64), np.ones(1, np.int64)

    def _parts(self, chunk: str) -> list[str]:
        """The chunk in pieces that the tokenizer never joins."""
        if not self.cut or "'" in chunk or "<" in chunk:
            return [chunk]
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk.lower()]
            return RUNS.findall(chunk.lower())
        word = chunk.rstrip(".,;:!?")
        # A letter whose folded form ends in a mark would go with the sign.
        folded = unicodedata.normalize("NFC", word[-1:]).lower() if word != chunk else ""
        return [word, chunk[len(word) :]] if folded[-1:].isalpha() else [chunk]

    def _learn_parts(self, parts: set[str]) -> None:
        if self.cut:
            model, plain = self.tokenizer.model, [p for p in parts if p.isascii() and p.isalpha()]
            for word in plain:
                self.parts[word] = np.array([t.id for t in model.tokenize(word)], "<u4").tobytes()
            parts = parts.difference(plain)
        words = [p for p in parts if self.cut and p.isalpha()]
        others = list(parts.difference(words))
        for lo in range(0, len(words), TOGETHER):
            some = words[lo : lo + TOGETHER]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            raw, ends = ids.tobytes(), (4 * (np.flatnonzero(self.word_end[ids]) + 1)).tolist()
            if len(ends) == len(some):  # every one is one word to the tokenizer too
                self.parts.update((w, raw[a:z]) for w, a, z in zip(some, [0, *ends[:-1]], ends, strict=True))
            else:
                others += some
        for part, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self.parts[part] = np.array(e.ids, "<u4").tobytes()

    def _learn(self, chunks: list[str]) -> np.ndarray:
        """The slot of each of these distinct chunks."""
        if len(self.known) > REMEMBERED:
            self._clear()
        if len(self.parts) > REMEMBERED_PARTS:
            self.parts = {}
        slots = list(map(self.known.get, chunks))
        new = [c for c, slot in zip(chunks, slots, strict=True) if slot is None]
        cut = list(map(self._parts, new))
        self._learn_parts(set(chain.from_iterable(cut)).difference(self.parts))
        known = self.parts
        ids = [known[parts[0]] if len(parts) == 1 else b"".join([known[p] for p in parts]) for parts in cut]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = len(self.pool) + np.cumsum(sizes) - sizes
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), "<u4")])
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        following = range(len(self.known) + 1, len(self.known) + len(new) + 1)
        self.known.update(zip(new, following, strict=True))
        out = np.fromiter((slot or 0 for slot in slots), np.int64, len(slots))
        out[out == 0] = following
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, the end id after each, and the length of each."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        collects = gc.isenabled()
        gc.disable()  # learning makes no cycles, and each collection would walk the parts of all new chunks
        try:
            slot = self._learn(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        finally:
            if collects:
                gc.enable()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        slot = np.insert(slot, ends, 0)
        sizes = self.sizes[slot]
        after = np.cumsum(sizes)
        steps = (self.starts[slot] - after + sizes).astype(np.int32)
        out = self.pool[np.repeat(steps, sizes) + np.arange(int(sizes.sum()), dtype=np.int32)]
        return out, np.diff(after[ends + np.arange(len(ends))], prepend=0)


@lru_cache(1)
def _chunks(path: str) -> Chunks:
    """One per worker process, which runs many tasks."""
    return Chunks(path)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; its task and its number there."""

    def run(batches):
        chunks, seen = _chunks(tokenizer_path), np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in slices(batches, 1):
            ids, lengths = chunks.encode(batch.column(1))
            n = -(-lengths // capacity)
            doc = np.repeat(np.arange(len(lengths)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(lengths[doc] - start, capacity)
            at = (np.cumsum(lengths) - lengths)[doc] + start
            little = ids.astype("<u4", copy=False)
            crc = [zlib.crc32(little[a : a + size]) for a, size in zip(at, length, strict=True)]
            # Number the pieces of each length, on from the task's earlier ones.
            order = np.argsort(length, kind="stable")
            counts = np.bincount(length, minlength=capacity + 1)
            local = np.empty(len(doc), np.int64)
            local[order] = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
            local += seen[length]
            seen += counts
            columns = [batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32())]
            columns += [pa.array(v, pa.int64()) for v in (start, length, crc)]
            columns += [pa.array(np.full(len(doc), task), pa.int32()), pa.array(local, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "piece", "start", "length", "ids_crc32", "task", "local"]
            )

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]
    fields += [T.StructField("task", T.IntegerType()), T.StructField("local", T.LongType())]
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType(fields))


class Packing:
    """Packs a table of counts by length; ``runs`` says where the pieces go."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.rank = np.zeros(capacity + 1, np.int64)
        self.bins = 0
        self.fixed = 0  # sequences that the reduction made
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, first rank, first bin, per bin, offset

    def _put(self, length: int, first_bin: int, bins: int, per_bin: int, offset: int) -> None:
        self.runs.append((length, int(self.rank[length]), first_bin, per_bin, offset))
        self.rank[length] += bins * per_bin
        self.left[length] -= bins * per_bin

    def _fix(self, lengths: list[int]) -> None:
        """As many sequences of just these lengths as there are pieces for."""
        wanted = {x: lengths.count(x) for x in lengths}
        bins = min(int(self.left[x]) // n for x, n in wanted.items())
        offset = 0
        for x, n in wanted.items():
            self._put(x, self.bins, bins, n, offset)
            offset += x * n
        self.bins += bins
        self.fixed += bins

    def _dominant(self, j: int) -> list[int] | None:
        """A set with j that dominates every other feasible set with it, if one of the rules finds it."""
        free = self.capacity - j
        self.left[j] -= 1
        try:
            if free and self.left[free]:
                return [j, free]
            sizes = np.flatnonzero(self.left[: free + 1])
            if not len(sizes):
                return [j]
            low = np.repeat(sizes[:3], np.minimum(self.left[sizes[:3]], 3))[:3]
            x = int(sizes[-1])
            if len(low) < 2 or low[:2].sum() > free:
                return [j, x]
            if len(low) == 3 and low.sum() <= free:
                return None
            # Pairs that fit: each size with the largest partner, another piece, that fits beside it.
            at = np.searchsorted(sizes, free - sizes, side="right") - 1
            at = np.where((at >= 0) & (sizes[at] == sizes) & (self.left[sizes] < 2), at - 1, at)
            fits = at >= 0
            first, second = sizes[fits], sizes[at[fits]]
            if x >= (first + second).max():
                return [j, x]
            beside = second[first == x]
            if len(beside) and np.minimum(first, second).max() <= beside[0]:
                return [j, x, int(beside[0])]
            return None
        finally:
            self.left[j] += 1

    def reduce(self) -> None:
        changed = True
        while changed:
            changed = False
            for j in np.flatnonzero(self.left)[::-1]:
                while self.left[j] and (found := self._dominant(int(j))):
                    self._fix(found)
                    changed = True

    def best_fit(self) -> None:
        room: dict[int, list[tuple[int, int]]] = {}  # free room -> (first bin, bins)
        rooms: list[int] = []

        def keep(free: int, first: int, bins: int) -> None:
            if free and bins:
                if free not in room:
                    room[free] = []
                    insort(rooms, free)
                room[free].append((first, bins))

        for length in np.flatnonzero(self.left)[::-1].tolist():
            while n := int(self.left[length]):
                at = bisect_left(rooms, length)
                if at < len(rooms):
                    free = rooms[at]
                    first, bins = room[free].pop()
                    if not room[free]:
                        del room[free], rooms[at]
                else:
                    free, first, bins = self.capacity, self.bins, -(-n // (self.capacity // length))
                    self.bins += bins
                each = free // length
                full = min(bins, n // each)
                if full:
                    self._put(length, first, full, each, self.capacity - free)
                    keep(free - each * length, first, full)
                rest = n - full * each
                if full < bins and rest:
                    self._put(length, first + full, 1, rest, self.capacity - free)
                    keep(free - rest * length, first + full, 1)
                    full += 1
                keep(free, first + full, bins - full)

    def solve(self) -> Packing:
        self.reduce()
        self.best_fit()
        return self


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    spark = docs.sparkSession
    found = pieces(docs, tokenizer_path, capacity)
    path = scratch_path(spark, "packing-pieces")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    per_task = found.groupBy("length", "task").agg((F.max("local") + 1).alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity
    runs = np.array(sorted(Packing(counts, capacity).solve().runs), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(runs)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = found.join(offsets, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local")).alias("rank")
    )

    def place(batches):
        length, rank, first_bin, per_bin, offset = shared.value.T
        keys = (length << 48) | rank
        for batch in batches:
            own, number = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(keys, (own << 48) | number, side="right") - 1
            i = number - rank[at]
            columns = [batch.column(k) for k in range(5)]
            columns.append(pa.array(first_bin[at] + i // per_bin[at], pa.int64()))
            columns.append(pa.array(offset[at] + i % per_bin[at] * own, pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    schema = T.StructType(
        [*ranked.schema.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return ranked.mapInArrow(place, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack(read(spark, sf_dir, "documents"), default_tokenizer())
