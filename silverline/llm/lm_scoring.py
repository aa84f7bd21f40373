"""Operator 4: language-model scoring by cross-entropy difference.

Two bigram models, of the trusted target (documents labelled good and not toxic)
and of the background (all documents), score each document's tokens; the score
is the mean over tokens of the background's loss less the target's, in nats. The models
match: one vocabulary, one order, one smoothing.

- Every word is in the vocabulary and every bigram in the models, whatever the corpus; words
  are known by 64-bit hashes, bigrams by a 64-bit mix of the two.
- P(w | v) = L * c(v, w) / c(v) + (1 - L) * P(w), with add-``ALPHA`` unigrams over as
  many slots as there are words, and at least ``VOCABULARY``, and two more.
- A token's loss is -log((1 - L) * P(w)) less the gain log(1 + c(v, w) * r) of its bigram,
  with r = L / (c(v) * (1 - L) * P(w)).
- Tasks hold the counts of the ``WORDS`` most frequent words and of ``BIGRAMS`` frequent
  bigrams, so these tables have a size known beforehand. Which these are decides only the cost: every
  other bigram of two such words goes to where its bucket is counted, packed with the others of its
  chunk and bucket (key, document, n; the more tokens, the more buckets), and every bigram with another
  word goes as a row, to which that word's counts are joined. Gains are summed by document.

Defined results: null and empty texts have no tokens, and losses and score 0; without
trusted labels the target is empty and its model uniform; a document with several
labels is trusted if none speaks against it; rows that repeat count as often as
they stand, and score alike.
"""

from __future__ import annotations

import math
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from silverline.llm.common import read, slices
from silverline.session import checkpoint_root

VOCABULARY = 1 << 14
WORDS = 1 << 20
BIGRAMS = 1 << 20
LAMBDA = 0.7
ALPHA = 0.1
CHUNK = 1 << 20
BLOCK = 1 << 18
SHIFT = 20  # numbers of WORDS words have so many bits
START = 0  # stands for the word before a text's first
MIX = np.uint64(0x9E3779B97F4A7C15)
UNTRUSTED, TRUSTED, HEAD, PACKED = 0, 1, 2, 3  # kinds of the rows that scoring emits
TRUSTED_IDS = 1 << 20  # ids that are broadcast, some 32 MB; more are joined by shuffle
BUCKET_TOKENS = 1 << 19  # tokens of a bucket on average
BUCKETS = 1 << 9  # at least; with fewer, packed rows are larger, and the rows of a document's losses rise with the corpus
SPREAD = 0x9E3779B97F4A7C15 & ((1 << 2 * SHIFT) - 1) | 1  # odd, so products with it can be undone
KEYS = (1 << 2 * SHIFT) - 1


def _hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of ``data``, all words' next eight bytes at a time; eight bytes follow the last word."""
    eights = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    h = lengths.astype(np.uint64) * MIX
    some, at, left = np.arange(len(starts)), starts, lengths
    while len(some):
        piece = eights[at]
        short = left < 8
        piece[short] &= (np.uint64(1) << (left[short].astype(np.uint64) << np.uint64(3))) - np.uint64(1)
        x = (h[some] ^ piece) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)
        h[some] = x ^ x >> np.uint64(29)
        more = left > 8
        some, at, left = some[more], at[more] + 8, left[more] - 8
    return h.view(np.int64)


def word_hash(w: bytes) -> int:
    return int(_hashes(np.frombuffer(w + bytes(8), np.uint8), np.array([0]), np.array([len(w)]))[0])


def word_hashes(texts) -> list[np.ndarray]:
    """The hashes of each text's words, made from the texts' bytes."""
    array = pa.array([t if isinstance(t, str) else "" for t in texts], pa.large_string())
    _, ends, data = array.buffers()
    ends = np.frombuffer(ends, np.int64)[: len(array) + 1]
    data = np.concatenate([np.frombuffer(data or b"", np.uint8)[: ends[-1]], np.zeros(8, np.uint8)])
    text = data[: ends[-1]]
    is_word = (text - np.uint8(0x09) > 4) & (text != 0x20)  # white space is 9 to 13 and 32
    breaks = np.zeros(len(is_word) + 1, dtype=bool)
    breaks[ends] = True
    starts = np.flatnonzero(is_word & (breaks[:-1] | ~np.concatenate([[False], is_word])[:-1]))
    stops = np.flatnonzero(is_word & (breaks[1:] | ~np.concatenate([is_word, [False]])[1:])) + 1
    return np.split(_hashes(data, starts, stops - starts), np.searchsorted(starts, ends[1:-1]))


def before(ids: np.ndarray) -> np.ndarray:
    return np.concatenate([[START], ids[:-1]]) if len(ids) else ids


def bigram_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first.view(np.uint64) * MIX
    mixed ^= mixed >> np.uint64(29)
    return ((mixed ^ second.view(np.uint64)) * MIX).view(np.int64)


def _blocks(frames, size: int):
    """Runs of rows as (rows, documents' numbers, first words, second words, trusted by token)."""
    held, tokens = [], 0

    def out():
        ids = [x for _, x in held]
        lengths = [len(x) for x in ids]
        trusted = np.array([r["trusted"] is True or r["trusted"] == True for r, _ in held], dtype=bool)  # noqa: E712
        place = np.repeat(np.arange(len(held)), lengths)
        first = np.concatenate([before(x) for x in ids]).astype(np.int64)
        return [r for r, _ in held], place, first, np.concatenate(ids), trusted

    for pdf in frames:
        for r, ids in zip(pdf.drop(columns="text").to_dict("records"), word_hashes(pdf["text"]), strict=True):
            held.append((r, ids))
            tokens += len(ids)
            if tokens > size or len(held) >= size:
                yield out()
                held, tokens = [], 0
    if held:
        yield out()


def marked(docs: DataFrame, labels: DataFrame, path: str, small: int = TRUSTED_IDS) -> DataFrame:
    """(rid, doc_id, text, trusted): the rows of ``docs``, each with a number of its own.

    Up to ``small`` trusted ids are sent to all tasks; with more the texts are shuffled to them, once, and
    kept at ``path`` for the passes over them.
    """
    trusted = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
        .where((F.col("q") == 1) & (F.coalesce(F.col("t"), F.lit(0)) == 0))
        .select("doc_id", F.lit(True).alias("trusted"))
    )
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    columns = ["rid", "doc_id", "text", "trusted"]
    if trusted.count() <= small:
        return rows.join(F.broadcast(trusted), "doc_id", "left").select(*columns)
    joined = rows.join(trusted, "doc_id", "left").select(*columns)
    joined.write.parquet(path)
    return docs.sparkSession.read.schema(joined.schema).parquet(path)


def word_counts(rows: DataFrame) -> DataFrame:
    """Per word h: its counts (background ub, target ut) and as first of a bigram (hb, ht).

    Rows with ``bigram`` are of bigrams that stand twice or more in some chunk, with a
    lower bound of their background count.
    """

    def run(frames):
        for _, place, first, second, trusted in _blocks(frames, CHUNK):
            if not len(second):
                continue
            by_token = trusted[place]
            code, u = pd.factorize(second)
            # A token begins a bigram unless it is its text's last; as many begin after START.
            last = np.flatnonzero(np.diff(place, append=-1))
            count = [
                np.bincount(code[i], weights=x, minlength=len(u)).astype(np.int64)
                for i in (slice(None), last)
                for x in (None, by_token[i])
            ]
            ub, ut, hb, ht = count[0], count[1], count[0] - count[2], count[1] - count[3]
            starts = ([START], 0, 0, [len(last)], [int(by_token[last].sum())])
            keys, n = np.unique(bigram_keys(first, second), return_counts=True)
            keys, n = keys[n > 1], n[n > 1]
            for bigram, part in ((False, (u, ub, ut, hb, ht)), (False, starts), (True, (keys, n, 0, 0, 0))):
                if len(part[0]):
                    yield pd.DataFrame({"bigram": bigram, **dict(zip(["h", "ub", "ut", "hb", "ht"], part, strict=True))})

    counted = rows.select("text", "trusted").mapInPandas(
        run, "bigram boolean, h long, ub long, ut long, hb long, ht long"
    )
    return counted.groupBy("bigram", "h").agg(*[F.sum(c).alias(c) for c in ("ub", "ut", "hb", "ht")])


def frequent_counts(rows: DataFrame, keys: np.ndarray) -> np.ndarray:
    """(keys, 2): background and target counts over all documents of the sorted bigram keys."""
    shared = rows.sparkSession.sparkContext.broadcast(keys)

    def run(frames):
        known = pd.Index(shared.value)
        sums = np.zeros((len(known), 2), dtype=np.int64)
        for _, place, first, second, trusted in _blocks(frames, BLOCK):
            at = known.get_indexer(bigram_keys(first, second))
            hit = at >= 0
            np.add.at(sums[:, 0], at[hit], 1)
            np.add.at(sums[:, 1], at[hit & trusted[place]], 1)
        seen = np.flatnonzero(sums[:, 0])
        yield pd.DataFrame({"i": seen, "b": sums[seen, 0], "t": sums[seen, 1]})

    out = np.zeros((len(keys), 2), dtype=np.int64)
    if len(keys):
        counted = rows.select("text", "trusted").mapInPandas(run, "i long, b long, t long")
        got = counted.groupBy("i").agg(F.sum("b").alias("b"), F.sum("t").alias("t")).toArrow().to_pandas()
        out[got["i"]] = got[["b", "t"]]
    return out


def planes(values: np.ndarray) -> bytes:
    flat = np.ascontiguousarray(values, dtype="<i8").reshape(-1)
    return zlib.compress(flat.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unplaned(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1).T).view("<i8")[:, 0]


class Tables:
    """What every task holds: counts of frequent words and bigrams, and the corpus totals.

    Words are numbered by frequency, which keeps the keys of their bigrams small.
    Only counts are sent, as compressed planes of equal bytes; each worker makes the factors from them.
    """

    def __init__(self, frequent: pd.DataFrame, keys: np.ndarray, bigrams: np.ndarray, total: np.ndarray, slots: int):
        counts = frequent[["ub", "ut", "hb", "ht"]].to_numpy(np.int64)
        self.sent = frequent["h"].to_numpy(np.int64), counts, keys, bigrams, total, slots
        self._set(*self.sent)

    def _set(self, hashes, counts, keys, bigrams, total, slots) -> None:
        self.number = np.argsort(hashes)
        self.words = hashes[self.number]
        # Of a word that the tables lack, both factors are 1 and wait for the join.
        self.p1 = np.concatenate([(1 - LAMBDA) * (counts[:, :2] + ALPHA) / (total + ALPHA * slots), [[1, 1]]])
        self.share = np.concatenate([LAMBDA / np.maximum(counts[:, 2:], 1), [[1, 1]]])
        self.keys, self.bigrams = keys, bigrams
        self._of_word = self._of_bigram = None

    def bigram(self, keys: np.ndarray) -> np.ndarray:
        """Places of bigrams among those held, or -1."""
        if self._of_bigram is None:
            self._of_bigram = pd.Index(self.keys)
        return self._of_bigram.get_indexer(keys)

    @property
    def loss1(self) -> np.ndarray:
        return -np.log(self.p1)

    def __getstate__(self):
        hashes, counts, keys, bigrams, total, slots = self.sent
        return hashes, planes(counts), planes(np.diff(keys, prepend=0)), planes(bigrams), total, slots

    def __setstate__(self, state) -> None:
        hashes, counts, keys, bigrams, total, slots = state
        counts, bigrams = (unplaned(x).reshape(-1, n) for x, n in ((counts, 4), (bigrams, 2)))
        self._set(hashes, counts, np.cumsum(unplaned(keys)), bigrams, total, slots)

    def word(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words; of those not held, the one after the last."""
        if self._of_word is None:
            self._of_word = pd.Index(self.words)
        return np.append(self.number, len(self.words))[self._of_word.get_indexer(hashes)]


def pack(key_place: np.ndarray, n: np.ndarray, rid: np.ndarray) -> bytes:
    """Sorted (key << SHIFT | document's place), counts and numbers of documents, by planes of equal bytes.

    The high bytes of steps, numbers and counts hardly differ, and few values stand in the low ones of the latter two.
    """
    steps = np.diff(key_place >> SHIFT, prepend=0)
    flat = b"".join(x.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for x in (steps, n, rid))
    return len(flat).to_bytes(8, "little") + pa.compress(flat, "zstd", asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    """(3, entries): keys, counts, numbers of documents."""
    packed = memoryview(packed)
    flat = pa.decompress(pa.py_buffer(packed[8:]), int.from_bytes(packed[:8], "little"), "zstd")
    planes = np.frombuffer(flat, dtype=np.uint8).reshape(3, 8, -1)
    out = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[:, :, 0]
    return np.stack([np.cumsum(out[0]), out[1], out[2]])


def bucket_count(tokens: float) -> int:
    return 1 << min(2 * SHIFT, max(BUCKETS.bit_length() - 1, math.ceil(math.log2(max(1.0, tokens / BUCKET_TOKENS)))))


def _packed(keys: np.ndarray, place: np.ndarray, rid: np.ndarray, trusted: np.ndarray, buckets: int):
    """(bucket, entries, packed) of a chunk's bigrams; a count's lowest bit tells whether its document is trusted."""
    spread = (keys.astype(np.uint64) * np.uint64(SPREAD) & np.uint64(KEYS)).astype(np.int64)
    entries, n = np.unique(spread << SHIFT | place, return_counts=True)
    at = entries & ((1 << SHIFT) - 1)
    width = 3 * SHIFT - (buckets.bit_length() - 1)
    edges = np.flatnonzero(np.diff(entries >> width, prepend=-1))
    for start, end in zip(edges, np.append(edges, len(entries))[1:], strict=True):
        some = slice(start, end)
        yield int(entries[start] >> width), end - start, pack(
            entries[some], n[some] << 1 | trusted[at[some]], rid[at[some]]
        )


def _emitted(rows: DataFrame, shared, buckets: int) -> DataFrame:
    """A HEAD row for each of ``rows``, with the losses less the gains that the tables hold, and its other bigrams.

    Bigrams of two words in the tables are PACKED rows of a chunk and bucket, known by the words'
    numbers. Others are rows known by a hash, and ``more`` has the words that the tables lack
    (v and w) and the number of the word that they hold, if one.
    """
    id_field = rows.schema["doc_id"].dataType
    id_type = to_arrow_type(id_field)
    more_type = pa.struct(
        [("b", pa.float64()), ("t", pa.float64()), ("v", pa.int64()), ("w", pa.int64()), ("doc_id", id_type), ("known", pa.int32())]
    )
    names = ["rid", "key", "n", "kind", "more", "packed"]
    size = min(CHUNK, BLOCK)  # beside the tables, which are some 80 MB
    text = rows.columns.index("text")

    def batch(rid, key, n, kind, more=None, packed=None) -> pa.RecordBatch:
        if more is None:
            more = pa.nulls(len(rid), more_type)
        else:
            more = [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(more, more_type, strict=True)]
            more = pa.StructArray.from_arrays(more, fields=list(more_type))
        packed = pa.nulls(len(rid), pa.binary()) if packed is None else pa.array(packed, pa.binary())
        arrays = [pa.array(rid, pa.int64()), pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(kind, pa.int32()), more, packed]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches):
        held = shared.value
        lacks = len(held.words)
        start = held.word(np.array([START]))[0]
        frames = (x.to_pandas(integer_object_nulls=True) for x in slices(batches, text))
        for docs, place, first, second, trusted in _blocks(frames, size):
            rid = np.array([r["rid"] for r in docs], dtype=np.int64)
            w = held.word(second)
            v = before(w)
            v[np.flatnonzero(np.diff(place, prepend=-1))] = start
            keys = bigram_keys(first, second)
            at = held.bigram(keys)
            known = (v < lacks) & (w < lacks)
            here = (at >= 0) & known
            # A word not held adds -log(1) here, and its loss where its counts are joined.
            losses = -np.log(held.p1[w])
            found = here.nonzero()[0]
            if len(found):
                r = held.share[v[found]] / held.p1[w[found]]
                losses[found] -= np.log1p(held.bigrams[at[found]] * r)
            sums = [np.bincount(place, weights=losses[:, k], minlength=len(docs)) for k in (0, 1)]
            lengths = np.bincount(place, minlength=len(docs))
            none = pa.nulls(len(docs), pa.int64())
            ids = pa.array([r_["doc_id"] for r_ in docs], id_type)
            # Rows of documents are dealt by a mix of their numbers; counts leave them out.
            yield batch(rid, bigram_keys(rid, rid), lengths, np.full(len(docs), HEAD), [*sums, none, none, ids, none.cast(pa.int32())])
            rest = (~here & known).nonzero()[0]
            parts = list(_packed(v[rest] << SHIFT | w[rest], place[rest], rid, trusted, buckets))
            if parts:
                bucket, n, packed = zip(*parts, strict=True)
                yield batch([-1] * len(parts), bucket, n, [PACKED] * len(parts), packed=packed)
            rest = (~known).nonzero()[0]
            if len(rest):
                # One row for each document and bigram.
                code = pd.factorize(keys[rest])[0]
                _, one, n = np.unique(place[rest] * np.int64(len(rest)) + code, return_index=True, return_counts=True)
                one = rest[one]
                lack = [pa.array(x[one], mask=i[one] < lacks) for x, i in ((first, v), (second, w))]
                number = np.minimum(v[one], w[one])
                blank = pa.nulls(len(one), pa.float64())
                number = pa.array(number.astype(np.int32), mask=number == lacks)
                more = [blank, blank, *lack, pa.nulls(len(one), id_type), number]
                yield batch(rid[place[one]], keys[one], n, trusted[place[one]].astype(np.int32), more)

    more = f"struct<b:double,t:double,v:bigint,w:bigint,doc_id:{id_field.simpleString()},known:int>"
    return rows.mapInArrow(run, f"rid long, key long, n long, kind int, more {more}, packed binary")


def _complete(dealt: DataFrame, shared) -> DataFrame:
    """(rid, doc_id, n, b, t): the HEAD rows, and what the bigrams of each bucket take off their documents' losses.

    ``dealt`` comes bucket by bucket; one bucket at a time is held.
    """
    id_field = dealt.schema["more"].dataType["doc_id"].dataType
    id_type = to_arrow_type(id_field)
    undo = np.uint64(pow(SPREAD, -1, KEYS + 1))
    names = ["rid", "doc_id", "n", "b", "t"]

    def gains(held, parts) -> pa.RecordBatch:
        spread, n, rid = np.concatenate(parts, axis=1)
        order = np.argsort(spread, kind="stable")
        spread, n, rid = spread[order], n[order], rid[order]
        good, n = n & 1, n >> 1
        starts = np.flatnonzero(np.diff(spread, prepend=-1))
        lengths = np.diff(starts, append=len(spread))
        key = (spread[starts].astype(np.uint64) * undo & np.uint64(KEYS)).astype(np.int64)
        r = held.share[key >> SHIFT] / held.p1[key & ((1 << SHIFT) - 1)]
        counts = np.stack([np.add.reduceat(n, starts), np.add.reduceat(n * good, starts)], axis=1)
        each = np.repeat(np.log1p(counts * r), lengths, axis=0) * n[:, None]
        docs, place = np.unique(rid, return_inverse=True)
        sums = [pa.array(-np.bincount(place, weights=each[:, k], minlength=len(docs))) for k in (0, 1)]
        nothing = pa.nulls(len(docs), id_type), pa.array(np.zeros(len(docs), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(docs), *nothing, *sums], names=names)

    def run(batches):
        held = shared.value
        bucket, parts = None, []
        for x in batches:
            heads = x.filter(pc.equal(x.column("kind"), HEAD))
            if heads.num_rows:
                more = heads.column("more")
                arrays = [heads.column("rid"), pc.struct_field(more, "doc_id"), heads.column("n")]
                arrays += [pc.struct_field(more, c) for c in ("b", "t")]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
            some = x.filter(pc.equal(x.column("kind"), PACKED))
            for key, packed in zip(some.column("key").to_pylist(), some.column("packed"), strict=True):
                if parts and key != bucket:
                    yield gains(held, parts)
                    parts = []
                bucket = key
                parts.append(unpack(packed.as_buffer()))
        if parts:
            yield gains(held, parts)

    return dealt.mapInArrow(run, f"rid long, doc_id {id_field.simpleString()}, n long, b double, t double")


def _lacking(dealt: DataFrame, shared) -> DataFrame:
    """Rows of bigrams with a word that the tables lack, with the known factors of r (b and t) and their bigram's counts cb and ct.

    They come bigram by bigram, before all other rows, and one bigram's rows at a time are held.
    They are picked in a task, not by a filter, which would go below the shuffle and run all before it again.
    """
    names = ["rid", "key", "n", "b", "t", "v", "w", "cb", "ct"]

    def counted(rows: pa.Table) -> pa.RecordBatch:
        key, n, kind = (rows.column(c).to_numpy() for c in ("key", "n", "kind"))
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        lengths = np.diff(starts, append=len(key))
        sums = [np.repeat(np.add.reduceat(x, starts), lengths) for x in (n, n * (kind == TRUSTED))]
        v, w, known = (pc.struct_field(rows.column("more"), c).combine_chunks() for c in ("v", "w", "known"))
        tables = shared.value
        lacks = len(tables.words)
        at = [np.where(x.is_null(), pc.fill_null(known, lacks), lacks) for x in (v, w)]
        r = tables.share[at[0]] / tables.p1[at[1]]
        columns = [*(rows.column(c).combine_chunks() for c in names[:3]), pa.array(r[:, 0]), pa.array(r[:, 1]), v, w]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.RecordBatch.from_arrays([*columns, *map(pa.array, sums)], names=names)

    def run(batches):
        held = None
        for x in batches:
            some = pa.Table.from_batches([x.filter(pc.less(x.column("kind"), HEAD)).drop_columns("packed")])
            if not some.num_rows:
                continue
            held = some if held is None else pa.concat_tables([held, some])
            key = held.column("key").to_numpy()
            end = int(np.argmax(key == key[-1]))
            if end:
                yield counted(held.slice(0, end))
                held = held.slice(end)
        if held is not None:
            yield counted(held)

    types = "rid long, key long, n long, b double, t double, v long, w long, cb long, ct long"
    return dealt.mapInArrow(run, types)


def _with_counts(lacking: DataFrame, counts: DataFrame, sides: dict[str, str]) -> DataFrame:
    """``lacking`` with the counts of the words in its columns ``sides``, named with the prefix given for each."""
    for side, prefix in sides.items():
        of = counts.select(*[F.col(c).alias(f"{prefix}{c}") for c in ("h", "ub", "ut", "hb", "ht")])
        lacking = lacking.join(of, F.col(side) == F.col(f"{prefix}h"), "left").drop(f"{prefix}h")
    return lacking


def _level(count: Column) -> Column:
    """A count, above 1024 its logarithm: rises with the count, some 4,500 values at most."""
    return F.when(count < 1024, count).otherwise(F.floor(F.log2(count) * 64 + 384)).cast("long")


def _most_frequent(rows: DataFrame, count: Column, limit: int) -> Column:
    """True for at most some ``limit`` rows (h, ...) of the highest levels; of the last level, those of low hashes.

    Hashes are spread evenly, so a share of their range is a share of the rows: nothing is sorted or shuffled.
    """
    sizes = sorted(rows.groupBy(_level(count).alias("level")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    left = limit
    for level, n in sizes:
        if n > left:
            below = -(1 << 63) + (left << 64) // n
            return (_level(count) > level) | ((_level(count) == level) & (F.col("h") < F.lit(below)))
        left -= n
    return F.lit(True)


def score(docs: DataFrame, labels: DataFrame, frequent: int = WORDS, bigrams: int = BIGRAMS) -> DataFrame:
    """doc_id, n_tokens, background_loss, target_loss and score of every document."""
    spark = docs.sparkSession
    path = f"{checkpoint_root(spark)}/lm-{uuid.uuid4().hex}"
    rows = marked(docs, labels, f"{path}-marked")
    word_counts(rows).write.partitionBy("bigram").parquet(path)
    counted = spark.read.schema("h long, ub long, ut long, hb long, ht long, bigram boolean").parquet(path)
    counts = counted.where(~F.col("bigram"))
    sums = counts.agg(F.count_if(F.col("ub") > 0), F.sum("ub"), F.sum("ut")).first()
    total = [float(x or 0) for x in sums[1:]]
    slots = max(VOCABULARY, sums[0]) + 2

    held = _most_frequent(counts, F.greatest("ub", "hb"), frequent)
    top = counts.where(held).drop("bigram").toArrow().to_pandas()
    top = top.iloc[np.lexsort((top["h"], -np.maximum(top["ub"], top["hb"])))]
    pairs = counted.where("bigram")
    often = pairs.where(_most_frequent(pairs, F.col("ub"), bigrams)).select("h").toArrow().to_pandas()
    keys = np.sort(often["h"].to_numpy(np.int64))
    tables = Tables(top, keys, frequent_counts(rows, keys), np.array(total), slots)

    shared = spark.sparkContext.broadcast(tables)
    # Both parts read one shuffle.
    dealt = _emitted(rows, shared, bucket_count(total[0])).repartition("key").sortWithinPartitions(F.col("kind") >= HEAD, "key")
    lacking = _lacking(dealt, shared)
    rare = counts.where(~held)

    no_id, no_tokens = F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.lit(0).cast("long").alias("n")

    def losses_of(rows: DataFrame, first: str, second: str) -> DataFrame:
        """Losses of rows; the counts of a first or second word that the tables lack are in columns with these prefixes."""
        sums = []
        for side, of_all in zip(("b", "t"), total, strict=True):
            unigram = (1 - LAMBDA) * (F.col(f"{second}u{side}") + ALPHA) / F.lit(of_all + ALPHA * slots)
            history = F.lit(LAMBDA) / F.greatest(F.col(f"{first}h{side}"), F.lit(1))
            p = F.when(F.col("w").isNotNull(), unigram).otherwise(F.lit(1.0))
            share = F.when(F.col("v").isNotNull(), history).otherwise(F.lit(1.0))
            gain = F.log1p(F.col(f"c{side}") * F.col(side) * share / p)
            sums.append((-F.col("n") * (F.log(p) + gain)).alias(side))
        return rows.select("rid", no_id, no_tokens, *sums)

    # Most of these rows have one such word, and are shuffled once.
    one = lacking.where("v IS NULL OR w IS NULL").withColumn("word", F.coalesce("v", "w"))
    two = lacking.where("v IS NOT NULL AND w IS NOT NULL")
    lacked = losses_of(_with_counts(one, rare, {"word": ""}), "", "").unionByName(
        losses_of(_with_counts(two, rare, {"w": "w_", "v": "v_"}), "v_", "w_")
    )
    losses = (
        _complete(dealt, shared)
        .unionByName(lacked)
        .groupBy("rid")
        .agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), F.sum("b").alias("b"), F.sum("t").alias("t"))
    )
    mean = [F.col(x) / F.greatest(F.col("n_tokens"), F.lit(1)) for x in ("b", "t")]
    return losses.select(
        "doc_id", "n_tokens", mean[0].alias("background_loss"), mean[1].alias("target_loss"),
        (mean[0] - mean[1]).alias("score"),
    )


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
