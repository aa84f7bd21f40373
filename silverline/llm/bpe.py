"""Operator 6: byte-pair encoding and decoding by a pair occurrence index.

The words that a batch of texts is split into are encoded together. All distinct
words not met before are laid out as one sequence of symbols, linked left to
right; an index maps each adjacent pair, by its rank, to all its positions.
Active ranks are taken in ascending order from a heap: all occurrences of that
pair are merged from left to right, and each merge adds the pairs it makes to
their lists, while positions it destroys are told by their symbols. The heap is
empty when no pair has a rank. Encoded words, and the runs between spaces that they
form, are kept in one bounded cache, which a worker keeps for its later partitions.

Encoding equals that of the vocabulary's library with no special tokens added;
a special token's own string in a text gives its id. Decoding joins the tokens'
bytes and replaces malformed UTF-8 as the library does.

The vocabulary file is read on the driver and its tables, of a fixed size, go to
the tasks; the path is a parameter.

Defined results: a null text is empty; an empty text has no tokens, and the digests
of nothing. Repeated rows are encoded alike. Only the columns named are read.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from silverline.llm.common import read, with_results

CACHE_WORDS = 1_000_000
BATCH_CHARS = 1 << 22
# Fixed value: the pre-tokenizer's pattern. \s is written out, as the library's
# engine does not count the separators U+001C to U+001F as white space.
SPACE = r"\t-\r\x20\x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, and back."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Token bytes by id, byte ids, ranks of pairs and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.byte_ids = [0] * 256
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        self.rank: dict[int, int] = {}  # by left id << 20 | right id
        self.left: list[int] = []
        self.right: list[int] = []
        self.made: list[int] = []
        for pair in spec["model"]["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(vocab[a] << 20 | vocab[b], len(self.made))
            self.left.append(vocab[a])
            self.right.append(vocab[b])
            self.made.append(vocab[a + b])
        # Ranks of pairs of bytes, -1 for none, and the bytes' ids. The byte 0xFF, which UTF-8 never
        # holds, is the end of a word.
        self.byte_rank = np.full((256, 256), -1, dtype=np.int32)
        byte_of = {i: b for b, i in enumerate(self.byte_ids) if b != 0xFF}
        for rank, (a, b) in enumerate(zip(self.left, self.right, strict=True)):
            if a in byte_of and b in byte_of and self.rank[a << 20 | b] == rank:
                self.byte_rank[byte_of[a], byte_of[b]] = rank
        self.byte_symbol = np.array([*self.byte_ids[:0xFF], -2], dtype=np.int32)


class Encoder:
    """Encodes and decodes with one vocabulary; keeps a bounded cache of words and runs."""

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS):
        self.v, self.cache_words = vocabulary, cache_words
        self.cache: dict[str, bytes] = {}  # a run that is a word has that word's ids
        self.words = regex.compile(PATTERN).findall
        self.space_before = regex.compile(f"[{SPACE}] ").search
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(regex.escape(n) for n in names) + ")") if names else None
        self.positions: list[list[int]] = [[] for _ in vocabulary.made]

    def pieces(self, text: str) -> list[str]:
        """Parts of ``text`` between which no word reaches: special tokens and runs.

        No word holds a space but as its first character or within white space, so a
        space after another character starts a word.
        """
        if self.cut is not None and any(n in text for n in self.v.special):
            parts = self.cut.split(text)
        else:
            parts = [text]
        out: list[str] = []
        for part in parts:
            if part in self.v.special or self.space_before(part) or part.startswith(" "):
                out.append(part)
            else:
                first, *rest = part.split(" ")
                if first:
                    out.append(first)
                out += [" " + r for r in rest]
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words and put them into the cache."""
        words = list(words)
        if not words:
            return
        rank_of, at = self.v.rank.get, self.positions
        data = np.frombuffer(b"\xff".join([w.encode("utf-8", "replace") for w in words]) + b"\xff", dtype=np.uint8)
        # -1: merged into its left neighbour; -2: end of a word
        symbol: list[int] = self.v.byte_symbol[data].tolist()
        n = len(symbol)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.v.byte_rank[data[:-1], data[1:]]
        places = np.flatnonzero(ranks >= 0)
        ranks = ranks[places]
        order = np.argsort(ranks, kind="stable")
        places = places[order].tolist()
        found, starts = np.unique(ranks[order], return_index=True)
        active, starts = found.tolist(), [*starts.tolist(), len(places)]
        for r, start, end in zip(active, starts, starts[1:], strict=False):
            at[r] = places[start:end]
        push, pop = heapq.heappush, heapq.heappop  # ranks in order are a heap already
        while active:
            rank = pop(active)
            a, b, new = self.v.left[rank], self.v.right[rank], self.v.made[rank]
            positions, at[rank] = at[rank], []
            positions.sort()
            for i in positions:
                if symbol[i] != a:
                    continue  # an earlier merge has taken this symbol
                j = right[i]
                if symbol[j] != b:
                    continue
                symbol[i], symbol[j] = new, -1
                k = right[i] = right[j]
                left[k] = i  # every word ends with a mark, so k is in range
                if (s := symbol[k]) >= 0 and (r := rank_of(new << 20 | s)) is not None:
                    if not at[r]:
                        push(active, r)
                    at[r].append(i)
                if (h := left[i]) >= 0 and (s := symbol[h]) >= 0 and (r := rank_of(s << 20 | new)) is not None:
                    if not at[r]:
                        push(active, r)
                    at[r].append(h)
        left_over = np.array(symbol, dtype=np.int32)
        left_over = left_over[left_over != -1]
        ends = np.flatnonzero(left_over == -2)
        ids = left_over.astype("<u4").tobytes()
        cache, start = self.cache, 0
        for w, end in zip(words, (4 * ends).tolist(), strict=True):
            cache[w] = ids[start:end]
            start = end + 4

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cache = self.cache
        if len(cache) > self.cache_words:
            cache.clear()
        collects = gc.isenabled()
        gc.disable()  # this makes no cycles, and each collection would walk the lists of all pieces and places
        try:
            pieces = [self.pieces(t) for t in texts]
            fresh = set().union(*pieces).difference(cache)
            for name, i in self.v.special.items():
                if name in fresh:
                    cache[name] = struct.pack("<I", i)
                    fresh.remove(name)
            # ASCII letters, with one space before them or without, are one word.
            mixed = {p: self.words(p) for p in fresh if not (p.isascii() and p.removeprefix(" ").isalpha())}
            new = fresh.difference(mixed)
            new.update(*mixed.values())
            self.learn(new.difference(cache))
            known = cache.__getitem__
            for p, words in mixed.items():
                if len(words) > 1:
                    cache[p] = b"".join(map(known, words))
            return [b"".join(map(known, ps)) for ps in pieces]
        finally:
            if collects:
                gc.enable()

    def decode(self, ids: bytes) -> str:
        token = self.v.token_bytes.__getitem__
        return b"".join(map(token, memoryview(ids).cast("I"))).decode("utf-8", "replace")


def batches(texts: Iterable[str], chars: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Runs of texts of about ``chars`` characters; a longer text is a run of its own."""
    run: list[str] = []
    size = 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(docs: DataFrame, vocabulary_path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``ids`` (array of int) and ``decoded`` of every text."""
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]

    def results(encoder: Encoder, encoded: list[bytes]):
        return {
            "ids": [list(memoryview(b).cast("I")) for b in encoded],
            "decoded": [encoder.decode(b) for b in encoded],
        }

    return _encoded(docs, vocabulary_path, keep, text, fields, results)


def digests(docs: DataFrame, vocabulary_path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256 and decoded_sha256 of every text."""
    fields = [T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")]

    def results(encoder: Encoder, encoded: list[bytes]):
        return {
            "n_tokens": [len(b) // 4 for b in encoded],
            "ids_sha256": [hashlib.sha256(b).hexdigest() for b in encoded],
            "decoded_sha256": [hashlib.sha256(encoder.decode(b).encode()).hexdigest() for b in encoded],
        }

    return _encoded(docs, vocabulary_path, keep, text, fields, results)


def _encoded(docs: DataFrame, vocabulary_path: str, keep: list[str], text: str, fields, results) -> DataFrame:
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))

    def setup():
        encoder = Encoder(vocabulary.value)

        def step(pdf):
            out = {f.name: [] for f in fields}
            for run in batches(t if isinstance(t, str) else "" for t in pdf[text]):
                for name, values in results(encoder, encoder.encode(run)).items():
                    out[name] += values
            return out

        return step

    columns = [*keep, *([text] if text not in keep else [])]
    return with_results(docs.select(*columns), keep, text, fields, setup)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"), default_vocabulary(), ["doc_id"])
