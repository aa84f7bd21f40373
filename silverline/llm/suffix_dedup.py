"""Operator 2: removal of repeated byte strings by suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts at another place,
in any document; strings do not cross documents and are judged on the input.

1. Anchors. Of the ``GRAM``-byte grams of every window of ``length`` bytes, those with
   the least hash are the window's anchors (about one in 75 bytes). Equal windows have
   equal anchors at equal offsets, so a repeated window is found among the places of one
   anchor gram, in the context of ``length - GRAM`` bytes to each side.
2. Neighbours. Places are sorted by gram and hash of the context. A gram's single place is no
   repeat; equal contexts are repeated as a whole. Only neighbours are compared, so copies of one
   document or passage, however many, are not held.
3. Where a gram's contexts differ, one of each goes on to be met by the others: from the texts,
   straight to where its gram's are solved, by a sparse suffix array. Only suffixes at anchors are sorted:
   all repeats that an anchor shares with another context hold the anchor, so the furthest to each side
   tell all of them. Groups of more than ``PAIRS`` go to an enhanced suffix array of all
   suffixes: suffixes and common prefix lengths by prefix doubling, on the alphabet (group, offset to the
   anchor, byte), as only strings at one offset to the anchor are different
   places for certain. A stack scan walks the tree of common-prefix intervals; an interval
   of at least ``length`` whose suffixes have different left neighbours is a maximal
   repeat, and all suffixes of the interval are its occurrences.
4. The windows around the anchors of groups of more than ``MAX_GROUP`` different contexts are halved by
   offset: those of one half share a longer gram (125 bytes, then 162, ...). Halves are counted, by key and
   hash of the context, and solved in the same way, or halved again, at the latest until a half is a
   single window, which a count decides.
5. Spans meet their documents again by row, and are merged and cut out.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing;
repeated rows are places of their own, so all of them go; null and repeated doc_ids are
fine, as rows are known by a hash of id and text. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations


import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm.common import read, slices, text_or_empty, with_results
from silverline.session import checkpoint_root

LENGTH = 200
GRAM = 50
MAX_GROUP = 400
PAIRS = 200  # contexts of a key that are met pair by pair
CHUNK = 1 << 20
EQUAL, OPEN, SEVERAL = 0, 1, 2  # kinds of places
SOLVED = pa.schema([("row", pa.int64()), *((c, pa.int32()) for c in ("start", "end", "pos", "last")), ("data", pa.binary())])
BASE = 0x01000193


def _sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over each run of ``width`` values, by doubling."""
    step = 1
    while 2 * step <= width:
        a = op(a[:-step], a[step:])
        step *= 2
    rest = width - step
    return op(a[:-rest], a[rest:]) if rest else a


class Powers:
    """Powers of the hash base and their inverses modulo 2^32, for one task."""

    def __init__(self, size: int):
        inverse = pow(BASE, -1, 1 << 32)
        self.up = np.cumprod(np.full(size, BASE, dtype=np.uint32), dtype=np.uint32)
        self.down = np.cumprod(np.full(size, inverse, dtype=np.uint32), dtype=np.uint32)


def anchors(data: bytes, powers: Powers, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Sorted positions of the grams that are the least of some window of ``length`` bytes."""
    found = []
    width = length - gram + 1
    for start in range(0, max(1, len(data)), CHUNK):
        piece = np.frombuffer(data[start : start + CHUNK + length - 1], dtype=np.uint8)
        n = len(piece)
        if n < length:
            break
        sums = np.zeros(n + 1, dtype=np.uint32)
        np.cumsum(piece * powers.up[:n], dtype=np.uint32, out=sums[1:])
        h = (sums[gram:] - sums[:-gram]) * powers.down[: n - gram + 1]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        least = _sliding(h, width, np.minimum)
        # The greatest of the least values of the windows that hold a gram.
        padded = np.zeros(len(least) + 2 * (width - 1), dtype=np.uint32)
        padded[width - 1 : width - 1 + len(least)] = least
        is_anchor = h <= _sliding(padded, width, np.maximum)[: len(h)]
        found.append(np.flatnonzero(is_anchor) + start)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _hash(b: bytes) -> int:
    return xxhash.xxh3_64_intdigest(b) - (1 << 63)


def anchor_rows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per anchor of each row (row, t): its position, and the hashes of its gram and of its context."""

    def run(batches):
        powers = Powers(CHUNK + length)
        reach = length - gram
        digest = xxhash.xxh3_64_intdigest
        for batch in slices(batches, 1):
            rows, at, grams, contexts = [], [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = text.encode("utf-8", "replace")
                places = anchors(data, powers, length, gram)
                if not len(places):
                    continue
                view = memoryview(data)
                rows.append(np.full(len(places), row, dtype=np.int64))
                at.append(places)
                places = places.tolist()
                grams += [digest(view[p : p + gram]) for p in places]
                # The seed tells how much of the context stands before the anchor.
                contexts += [digest(view[max(0, p - reach) : p + length], min(p, reach)) for p in places]
            if rows:
                hashes = [np.array(x, dtype=np.uint64).view(np.int64) for x in (grams, contexts)]
                arrays = [np.concatenate(rows), np.concatenate(at).astype(np.int32), *hashes]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["row", "pos", "gram", "ctx"])

    return docs.select("row", "t").mapInArrow(run, "row long, pos int, gram long, ctx long")


def grouped(index: DataFrame) -> DataFrame:
    """(kind, row, pos, key, ctx): the ``EQUAL`` places, whose context another place of their gram has too,
    and a place of each different context of the grams that have several, ``OPEN`` if it is the only one.

    Places come gram by gram and context by context, and only neighbours are compared, so
    copies of one context, however many, are not held.
    """

    def run(batches):
        held, before, link = None, False, False  # the last row; whether it continues a context, or its gram
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if not len(batch):
                    continue
                now = [batch.column(i).to_numpy() for i in range(4)]
                held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            if held is None:
                return
            row, pos, gram, ctx = held
            same_gram = gram[1:] == gram[:-1]
            same = same_gram & (ctx[1:] == ctx[:-1])
            if batch is None:  # nothing comes after
                same_gram, same = (np.append(x, False) for x in (same_gram, same))
            n = len(same)
            if not n:
                continue
            from_before = np.concatenate([[before], same[:-1]])
            links = np.concatenate([[link], same_gram[:-1]])
            # A context's link is that of its first place: whether its gram had another context before.
            links = links[np.maximum.accumulate(np.where(from_before, 0, np.arange(n)))]
            equal = np.flatnonzero(same | from_before)
            nodes = np.flatnonzero(~same & (links | same_gram))
            kind = np.concatenate([np.full(len(equal), EQUAL), np.where(from_before[nodes], SEVERAL, OPEN)])
            some = np.concatenate([equal, nodes])
            if len(some):
                blank = np.arange(len(some)) < len(equal)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kind, pa.int32()), pa.array(row[some]), pa.array(pos[some], pa.int32()),
                        pa.array(gram[some], mask=blank), pa.array(ctx[some], mask=blank),
                    ],
                    ["kind", "row", "pos", "key", "ctx"],
                )
            before, link = bool(same[-1]), bool(links[-1] if same[-1] else same_gram[-1])
            held = [x[n:] for x in held]

    dealt = index.select("row", "pos", "gram", "ctx").repartition("gram").sortWithinPartitions("gram", "ctx")
    return dealt.mapInArrow(run, "kind int, row long, pos int, key long, ctx long")


def contexts_at(docs: DataFrame, nodes: DataFrame, length: int, gram: int) -> DataFrame:
    """``nodes`` (row, pos, ...) with the context ``data`` of their place and the place ``at`` in it, from the texts.

    Rows of ``docs`` that repeat give the same contexts, once each.
    """
    more = [c for c in nodes.columns if c != "row"]
    lists = nodes.groupBy("row").agg(F.collect_list(F.struct(*more)).alias("nodes"))  # of one text
    joined = docs.select("row", "t").join(lists, "row").select("row", "t", "nodes")
    kinds = T.StructType([nodes.schema["row"], *(nodes.schema[c] for c in more)])
    names = [*kinds.names, "at", "data"]
    reach = length - gram

    def run(batches):
        for batch in slices(batches, 1):
            texts, lists = batch.column(1).to_pylist(), batch.column(2)
            of = lists.flatten()
            columns = [pc.take(batch.column(0), pc.list_parent_indices(lists)), *of.flatten()]
            at, cut = [], []
            places = iter(of.field(more.index("pos")).to_pylist())
            for text, n in zip(texts, pc.list_value_length(lists).to_pylist(), strict=True):
                data = text.encode("utf-8", "replace")
                for p in itertools.islice(places, n):
                    at.append(min(p, reach))
                    cut.append(data[max(0, p - reach) : p + length])
            for lo in range(0, len(at), 5000):
                part = [x.slice(lo, 5000) for x in columns]
                yield pa.RecordBatch.from_arrays(
                    [*part, pa.array(at[lo : lo + 5000], pa.int32()), pa.array(cut[lo : lo + 5000], pa.binary())], names
                )

    return joined.mapInArrow(run, T.StructType([*kinds, T.StructField("at", T.IntegerType()), T.StructField("data", T.BinaryType())]))


def halves(contexts: DataFrame, ranges: DataFrame, length: int, gram: int) -> DataFrame:
    """The halves (lo, hi) of each place's range, with the hash of what all their windows share
    (key) and of all that they reach (ctx). Halves without a whole window are left out."""

    names = ["row", "pos", "at", "data", "lo", "hi", "done"]

    def run(frames):
        for pdf in frames:
            out = []
            for row, pos, at, data, lo, hi, done in pdf[names].itertuples(index=False):
                middle = (lo + hi) // 2
                for a, b in ((lo, middle), (middle + 1, hi)) if lo < hi else ((lo, hi),):
                    # Windows start ``a`` to ``b`` bytes before the anchor, as far as the text goes.
                    b_in, a_in = min(b, at), max(a, at + length - len(data))
                    if a_in > b_in:
                        continue
                    reach = data[at - b_in : at - a_in + length]
                    shared = data[at - min(a, at) : at - b + length] if at >= a else b""
                    key = _hash(shared + bytes([a, b]))
                    out.append((row, pos, a, b, key, _hash(reach + bytes([b_in, a_in])), a_in, b_in, done))
            yield pd.DataFrame(out, columns=["row", "pos", "lo", "hi", "key", "ctx", "first", "last", "done"])

    return contexts.join(ranges, ["row", "pos"]).mapInPandas(
        run, "row long, pos int, lo int, hi int, key long, ctx long, first int, last int, done boolean"
    )


# --- enhanced suffix array -------------------------------------------------


def suffix_array(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``limit`` codes or more, and common prefix lengths with the one before.

    Prefix doubling; the ranks of every doubling are kept, and give the lengths.
    """
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    ranks, step = [rank], 1
    while step < limit:
        second = np.zeros(n, dtype=np.int64)
        second[: n - step] = rank[step:]
        pair = rank * (n + 2) + second
        order = np.argsort(pair)
        new = np.empty(n, dtype=np.int64)
        sorted_ = pair[order]
        new[order] = np.cumsum(np.concatenate([[1], sorted_[1:] != sorted_[:-1]]))
        rank = new
        ranks.append(rank)
        step *= 2
        if int(rank.max()) == n:  # all suffixes differ by now
            break
    order = np.argsort(rank)
    lcp = np.zeros(n, dtype=np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for level in range(len(ranks) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), dtype=bool)
        same[inside] = ranks[level][a[inside]] == ranks[level][b[inside]]
        lcp[1:] += same * (1 << level)
        a += same * (1 << level)
        b += same * (1 << level)
    return order, lcp


def maximal_repeats(
    order: np.ndarray, lcp: np.ndarray, left: np.ndarray, length: int
) -> Iterator[tuple[int, np.ndarray]]:
    """(common length, suffixes) of every maximal repeat of at least ``length``.

    ``left`` is the code before each suffix, distinct where there is none. Runs of
    the suffix array whose suffixes all have one left neighbour hold no maximal repeat;
    the others are scanned with a stack of open common-prefix intervals.
    """
    long = lcp >= length
    edges = np.flatnonzero(np.diff(np.concatenate([[0], long.astype(np.int8), [0]])))
    for start, end in zip((edges[::2] - 1).tolist(), edges[1::2].tolist(), strict=True):
        neighbours = left[order[start:end]]
        if (neighbours == neighbours[0]).all():
            continue
        # differs[i]: the neighbour of suffix i differs from that of suffix i - 1.
        changes = np.concatenate([[0], np.cumsum(neighbours[1:] != neighbours[:-1])]).tolist()
        heights = [*lcp[start + 1 : end].tolist(), 0]
        stack: list[tuple[int, int]] = []  # (height, first suffix of the interval)
        for i, height in enumerate(heights):
            first = i
            while stack and stack[-1][0] > height:
                tall, first = stack.pop()
                if changes[i] != changes[first]:  # left extensions differ
                    yield tall, order[start + first : start + i + 1]
            if height and (not stack or stack[-1][0] < height):
                stack.append((height, first))


def covered_at(keys: np.ndarray, data: list[bytes], at: np.ndarray, is_open: np.ndarray, length: int, gram: int) -> np.ndarray:
    """(contexts, 2): how far the repeated bytes around each open context's anchor ``at`` reach to the left and right.

    A sparse suffix array: of the suffixes at the anchors only, key by key, with common prefix
    lengths. Two contexts of a key share ``r`` bytes from the anchor on, the least prefix length between them,
    and ``l`` before it; if these are ``length`` together, both are repeated so far. All such
    stretches hold the anchor, so their union is one. Contexts are met at growing distances in the array.
    """
    reach = length - gram
    sizes = np.array([len(d) for d in data])
    whole = np.frombuffer(b"\0" * reach + b"".join(data) + b"\0" * length, dtype=np.uint8)
    anchor = np.cumsum(sizes) - sizes + at + reach
    to_right, to_left = np.minimum(sizes - at, length), np.minimum(at, reach)
    step = np.arange(length)
    right = np.where(step < to_right[:, None], whole[anchor[:, None] + step], np.uint8(0))
    group = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]])).astype(">u4")
    marked = np.concatenate([group.view(np.uint8).reshape(-1, 4), right], axis=1)
    order = np.argsort(marked.view(f"S{length + 4}")[:, 0], kind="stable")
    marked, anchor, to_right, to_left, is_open = (x[order] for x in (marked, anchor, to_right, to_left, is_open))
    differs = marked[1:] != marked[:-1]
    lcp = np.where(differs.any(axis=1), differs.argmax(axis=1), length + 4) - 4

    step = np.arange(reach)
    left = np.zeros((len(data), -(-reach // 8) * 8), dtype=np.uint8)
    left[:, :reach] = np.where(step < to_left[:, None], whole[anchor[:, None] - 1 - step], np.uint8(0))
    nearest = left.view("<u8")[:, 0]  # the eight bytes before the anchor
    best = np.zeros((len(data), 2), dtype=np.int64)
    i, least, distance = np.arange(len(lcp)), lcp, 1
    while True:
        some = least >= gram
        i, least = i[some], least[some]
        if not len(i):
            break
        j = i + distance
        r = np.minimum(least, np.minimum(to_right[i], to_right[j]))
        need = length - r
        some = (need <= np.minimum(to_left[i], to_left[j])) & ((need <= 8) | (nearest[i] == nearest[j])) & (is_open[i] | is_open[j])
        a, b, r, need = i[some], j[some], r[some], need[some]
        differs = left[a] != left[b]
        l = np.where(differs.any(axis=1), differs.argmax(axis=1), reach)  # noqa: E741
        l = np.minimum(l, np.minimum(to_left[a], to_left[b]))  # noqa: E741
        some = l >= need
        found = np.stack([l[some], r[some]], axis=1)
        for x in (a[some], b[some]):  # each context once
            best[x] = np.maximum(best[x], found)
        some = j < len(lcp)
        i, least = i[some], np.minimum(least[some], lcp[j[some]])
        distance += 1
    out = np.empty_like(best)
    out[order] = best
    return out


def covered(keys: list[int], data: list[bytes], offsets: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Per context: spans that repeat in another context of the same key at the same offset.

    ``offsets`` is each context's start relative to its anchor (not above 0).
    """
    sizes = np.array([len(d) for d in data])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    total = int((sizes + 1).sum())
    codes = np.zeros(total, dtype=np.int64)
    owner = np.repeat(np.arange(len(data)), sizes + 1)
    group = np.unique(np.array(keys), return_inverse=True)[1]
    for i, d in enumerate(data):
        s = starts[i]
        place = np.arange(len(d)) + (offsets[i] + length)
        codes[s : s + len(d)] = (group[i] * (3 * length) + place) * 256 + np.frombuffer(d, dtype=np.uint8)
    # The mark after each context is a code of its own.
    codes[starts + sizes] = -1 - np.arange(len(data))
    order, lcp = suffix_array(codes, 2 * length)
    left = np.empty(total, dtype=np.int64)
    left[1:] = codes[:-1]
    left[0] = -len(data) - 1
    spans: list[list[tuple[int, int]]] = [[] for _ in data]
    for size, suffixes in maximal_repeats(order, lcp, left, length):
        for p in suffixes.tolist():
            i = owner[p]
            spans[i].append((p - starts[i], p - starts[i] + size))
    return spans


def solved(nodes: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans (row, start, end) of the open ones of ``nodes`` (key, ctx, row, pos, open, last, data), by suffix arrays.

    ``nodes`` are contexts of small groups, from ``last`` bytes before their anchor on, and come key by key and
    context by context; ``NULL`` as key passes the context through, as (row, pos, last, data).
    """

    def solve(batch: list[tuple]) -> pd.DataFrame:
        keys, rows, places, opens, lasts, data = zip(*batch, strict=True)
        keys, is_open, lasts = np.array(keys), np.array(opens, dtype=bool), np.array(lasts)
        edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        many = np.repeat(np.diff(edges) > PAIRS, np.diff(edges))
        out = []
        few = np.flatnonzero(~many)
        if len(few):
            found = covered_at(keys[few], [data[i] for i in few], lasts[few], is_open[few], length, gram)
            hit = (found[:, 1] > 0) & is_open[few]
            for i, (a, b) in zip(few[hit].tolist(), found[hit].tolist(), strict=True):
                out.append((rows[i], places[i] - a, places[i] + b))
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            if not many[start]:
                continue
            some = range(start, end)
            for i, spans in zip(some, covered([keys[i] for i in some], [data[i] for i in some], [-lasts[i] for i in some], length), strict=True):
                if is_open[i]:
                    out += [(rows[i], places[i] + a - lasts[i], places[i] + b - lasts[i]) for a, b in merge(spans)]
        return pd.DataFrame(out, columns=["row", "start", "end"])

    names = ["key", "ctx", "row", "pos", "open", "last", "data"]

    def run(batches):
        batch: list[tuple] = []
        size, last, passed = 0, (None, None), (0, -1)
        for x in batches:
            big = x.filter(pc.is_null(x.column("key"))).select(["row", "pos", "last", "data"]).to_pandas()
            if len(big):
                now = big[["row", "pos"]].to_numpy()
                yield big[(now != np.concatenate([[passed], now[:-1]])).any(axis=1)]
                passed = now[-1]
            x = x.filter(pc.is_valid(x.column("key"))).select(names)
            for key, ctx, *record in zip(*(c.to_pylist() for c in x.columns), strict=True):
                if size > CHUNK and key != last[0]:
                    yield solve(batch)
                    batch, size = [], 0
                if (key, ctx) != last:  # repeated rows give the same
                    batch.append((key, *record))
                    size, last = size + len(record[-1]), (key, ctx)
        if batch:
            yield solve(batch)

    def as_arrow(batches):
        for pdf in run(batches):
            columns = [pa.array(pdf[f.name], f.type) if f.name in pdf else pa.nulls(len(pdf), f.type) for f in SOLVED]
            yield pa.RecordBatch.from_arrays(columns, SOLVED.names)

    return nodes.mapInArrow(as_arrow, "row long, start int, end int, pos int, last int, data binary")


def repeats(contexts: DataFrame, nodes: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans (row, start, end) of the open places among ``nodes``, by suffix arrays.

    ``nodes`` are different contexts (key, ctx, row, pos, first, last, open) of small groups.
    """
    once = nodes.join(contexts, ["row", "pos"]).select(
        "key",
        "ctx",
        "row",
        "pos",
        "open",
        "last",
        F.expr(f"substring(data, at - last + 1, last - first + {length})").alias("data"),
    )
    # All contexts of a key in one partition, key after key; groups are small by now. The work is many times
    # that of reading, so partitions are given by number: by size, small ones are put together in one task.
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = once.repartition(parts, "key").sortWithinPartitions("key", "ctx")
    return solved(once, length, gram).select("row", "start", "end")


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans, as maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _nodes(rows: DataFrame) -> DataFrame:
    """The different contexts of each key: how many places, and one of them (x).

    ``open``: a single place whose windows are not yet known to be repeated.
    """
    # The values of one of them: all that come first are of the same row. Unlike the least struct they need no sort.
    one = [F.first(c).alias(c) for c in ("row", "pos", "lo", "hi", "first", "last", "done")]
    nodes = rows.groupBy("key", "ctx").agg(F.count(F.lit(1)).alias("n"), *one)
    return nodes.withColumn("open", (F.col("n") == 1) & ~F.col("done"))


def _equal_places(rows: DataFrame, nodes: DataFrame, length: int) -> DataFrame:
    """Spans of the places whose context another place of their key has too."""
    several = nodes.where("n > 1").select("key", "ctx")
    return rows.where(~F.col("done")).join(several, ["key", "ctx"], "left_semi").select(
        "row", (F.col("pos") - F.col("last")).alias("start"), (F.col("pos") - F.col("first") + length).alias("end")
    )


def _undecided(nodes: DataFrame) -> DataFrame:
    """The nodes of keys that have an open one and another to compare it with, with the key's size."""
    sizes = nodes.groupBy("key").agg(
        F.count(F.lit(1)).alias("contexts"), F.count_if("open").alias("opens")
    )
    return nodes.join(sizes.where("contexts > 1 AND opens > 0").select("key", "contexts"), "key")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, max_group: int = MAX_GROUP) -> DataFrame:
    """(row, start, end), overlapping, of all repeated bytes of ``docs`` (row, t); ends may pass the text's."""
    spark = docs.sparkSession
    folder = f"{checkpoint_root(spark)}/suffix-{uuid.uuid4().hex}"

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    reach = length - gram
    index = stored(grouped(anchor_rows(docs, length, gram)), "places")
    spans = [index.where(F.col("kind") == EQUAL).select(
        "row", (F.col("pos") - reach).alias("start"), (F.col("pos") + length).alias("end")
    )]
    nodes = index.where(F.col("kind") != EQUAL).select("key", "ctx", "row", "pos", (F.col("kind") == OPEN).alias("open"))
    left = stored(_undecided(nodes), "undecided-0")
    # Contexts of small groups go to where their key's are solved, the others are dealt by place and kept to be halved.
    is_small = F.col("contexts") <= max_group
    once = contexts_at(docs, left, length, gram).withColumn("dealt", F.when(is_small, F.col("key")).otherwise(F.xxhash64("row", "pos")))
    once = once.withColumn("key", F.when(is_small, F.col("key"))).withColumn("last", F.col("at"))
    once = once.repartition("dealt").sortWithinPartitions("key", "ctx", "row", "pos")
    first = stored(solved(once, length, gram), "solved-0")
    spans.append(first.where("data IS NULL").select("row", "start", "end"))
    contexts = first.where("data IS NOT NULL").select("row", "pos", F.col("last").alias("at"), "data")
    left = left.where(~is_small).select("row", "pos", F.lit(0).alias("lo"), F.lit(reach).alias("hi"), "open")
    level = 0
    while not left.isEmpty():
        level += 1
        ranges = left.select("row", "pos", "lo", "hi", (~F.col("open")).alias("done"))
        rows = stored(halves(contexts, ranges, length, gram), f"halves-{level}")
        nodes = stored(_nodes(rows), f"nodes-{level}")
        spans.append(_equal_places(rows, nodes, length))
        left = stored(_undecided(nodes), f"undecided-{level}")
        spans.append(repeats(contexts, left.where(is_small), length, gram))
        left = left.where(~is_small)
    out = spans[0]
    for s in spans[1:]:
        out = out.unionByName(s)
    return out


def identified(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", text_or_empty().alias("t"), F.xxhash64("doc_id", text_or_empty()).alias("row")
    )


def spans_by_row(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, spans) of ``repeated_spans``, the spans as an array."""
    # Rows that repeat give the same spans; those are one before they are gathered.
    return repeated_spans(rows, length).groupBy("row").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")  # of one text
    )


def cut(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, text without its repeated bytes as ``kept`` (binary), n_bytes, n_removed, n_spans."""
    rows = identified(docs)
    spans = spans_by_row(rows, length)

    def step(pdf):
        out = {"kept": [], "n_bytes": [], "n_removed": [], "n_spans": []}
        for text, found in zip(pdf["t"], pdf["spans"], strict=True):
            data = text.encode("utf-8", "replace")
            clipped = [(max(0, s["start"]), min(len(data), s["end"])) for s in found] if found is not None else []
            merged = merge(clipped)
            kept, at = [], 0
            for a, b in merged:
                kept.append(data[at:a])
                at = b
            kept.append(data[at:])
            for name, value in zip(out, (b"".join(kept), len(data), sum(b - a for a, b in merged), len(merged)), strict=True):
                out[name].append(value)
        return out

    fields = [T.StructField("kept", T.BinaryType())]
    fields += [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    rows = rows.join(spans, "row", "left").select("doc_id", "t", "spans")
    return with_results(rows, ["doc_id"], "t", fields, lambda: step)


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return cut(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
