"""Packing: ids against the library, places against the rules, the reduction against exhaustive search."""

from __future__ import annotations

import gc
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from silverline.llm import best_fit_packing as packing
from tests.llm import fixtures

PATH = packing.default_tokenizer()


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]


def test_chunks_give_the_ids_of_whole_texts(whole):
    rng = random.Random(3)
    signs = list("abcXYZ'stre.,!0189-_<|>  \n\t\r\x0b\x0c\x1c\x85  ́ÉΣσİﬁ中😀‍﻿")
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(1500)]
    # Words with signs after them, as the shorter ways take them.
    words = ["Éa", "İ", "\u0958", "h\u0331", "ñandú", "Ünï", "ΣΑΣ", "abc", "AbC", "ß", "中文", "x1", "x", "ŉ", "ǰ"]
    texts += [" ".join(rng.choice(words) + rng.choice(["", ".", ",", "...", "!?", ";x"]) for _ in range(20)) for _ in range(500)]
    texts += [None, "", "it's THEY'LL <|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "e ́ x", "word " * 9000]
    chunks = packing.Chunks(PATH)
    ids, lengths = chunks.encode(pa.array(texts, pa.string()))
    at = np.concatenate([[0], np.cumsum(lengths)])
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == whole(t), repr(t)


def test_forgetting_chunks_changes_nothing(whole, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    monkeypatch.setattr(packing, "REMEMBERED_PARTS", 3)
    chunks = packing.Chunks(PATH)
    for t in ("one two three four five", "five six one", "seven seven"):
        assert chunks.encode(pa.array([t]))[0].tolist() == whole(t)


def test_new_chunks_are_learnt_without_collections(whole):
    chunks, begun = packing.Chunks(PATH), []
    texts = [" ".join(f"word{i}.x{j}" for j in range(100)) for i in range(300)]

    def note(phase, _):
        begun.append(phase)

    gc.collect()
    gc.callbacks.append(note)
    try:
        ids, lengths = chunks.encode(pa.array(texts))
    finally:
        gc.callbacks.remove(note)
    assert len(begun) <= 2 and gc.isenabled()
    assert ids[-lengths[-1] :].tolist() == whole(texts[-1])


def check(rows, docs, whole, capacity):
    """Every token once and in order, sequences without gaps and within the capacity."""
    per_doc, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        per_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    expected = defaultdict(list)
    for d, t, *_ in docs:
        ids = np.array(whole(t), "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            cut = ids[start : start + capacity]
            expected[d].append((piece, start, len(cut), zlib.crc32(cut.tobytes())))
    assert {d: sorted(v) for d, v in per_doc.items()} == {d: sorted(v) for d, v in expected.items()}
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_pieces_are_whole_and_sequences_gapless(spark, whole, capacity):
    rows = fixtures.edge_rows() + [(2**53 + 1, "big id " * 30, None, None, 0)]
    docs = fixtures.documents(spark, rows).repartition(3)
    out = packing.pack(docs, PATH, capacity)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    n = check(out.collect(), rows, whole, capacity)
    tokens = sum(len(whole(t)) for _, t, *_ in rows)
    assert -(-tokens // capacity) <= n <= -(-tokens // capacity) * 1.1 + 1


def test_empty_table_and_very_long_text(spark, whole):
    assert packing.pack(fixtures.documents(spark, []), PATH).collect() == []
    rows = [(1, "alpha beta " * 60_000, None, None, 0), (2, "x" * 100_000, None, None, 0)]
    check(packing.pack(fixtures.documents(spark, rows), PATH).collect(), rows, whole, packing.CAPACITY)


def fewest(lengths: tuple[int, ...], capacity: int) -> int:
    """The least number of sequences, by search over the free rooms."""
    items = sorted(lengths, reverse=True)

    @lru_cache(None)
    def go(i: int, rooms: tuple[int, ...]) -> int:
        if i == len(items):
            return len(rooms)
        options = [go(i + 1, tuple(sorted((*rooms, capacity - items[i]))))]
        for room in set(rooms):
            if room >= items[i]:
                rest = list(rooms)
                rest.remove(room)
                options.append(go(i + 1, tuple(sorted((*rest, room - items[i])))))
        return min(options)

    return go(0, ())


def laid_out(p: packing.Packing, counts):
    """Free room per sequence, after checking that ranks and places are used once."""
    runs = sorted(p.runs)
    used, seen = defaultdict(list), defaultdict(int)
    for k, (length, rank, first, each, offset) in enumerate(runs):
        end = runs[k + 1][1] if k + 1 < len(runs) and runs[k + 1][0] == length else counts[length] - int(p.left[length])
        assert rank == seen[length]
        seen[length] = end
        for i in range(end - rank):
            used[first + i // each].append((offset + i % each * length, length))
    for placed in used.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= p.capacity
    assert len(used) == p.bins
    return used


def test_reduction_keeps_the_least_number():
    rng = random.Random(11)
    fixed = reduced = 0
    for _ in range(400):
        capacity = rng.choice([10, 20, 31])
        low = rng.choice([1, capacity // 5, capacity // 4])
        lengths = [rng.randint(max(1, low), capacity) for _ in range(rng.randint(1, 9))]
        counts = {x: lengths.count(x) for x in lengths}
        p = packing.Packing(counts, capacity)
        p.reduce()
        laid_out(p, counts)
        rest = tuple(np.repeat(np.arange(capacity + 1), p.left).tolist())
        assert p.fixed + fewest(rest, capacity) == fewest(tuple(sorted(lengths)), capacity), lengths
        fixed += p.fixed
        reduced += len(rest) < len(lengths)
        p.best_fit()
        assert sum(len(v) for v in laid_out(p, counts).values()) == len(lengths)
    assert reduced > 100 and fixed > 300


def best_fit_one_by_one(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - x)
        else:
            rooms.append(capacity - x)
    return sorted(rooms)


def test_groups_are_packed_as_single_pieces_are():
    rng = random.Random(5)
    for _ in range(300):
        capacity = rng.choice([30, 100, 257])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 15))]
        lengths = [x for x in lengths for _ in range(rng.choice([1, 1, 2, 17]))]
        counts = {x: lengths.count(x) for x in lengths}
        p = packing.Packing(counts, capacity)
        p.best_fit()
        rooms = sorted(capacity - sum(n for _, n in v) for v in laid_out(p, counts).values())
        assert rooms == best_fit_one_by_one(lengths, capacity)
