"""Ranked search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from silverline.llm import ranked_search
from tests.llm import fixtures

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    held = [(d, t) for d, text, *_ in docs if (t := terms(text))]
    n_docs, length = len(held), sum(len(t) for _, t in held)
    df = Counter(w for _, t in held for w in set(t))
    asked = {}
    for item, text in items:
        asked.setdefault(item, []).extend(terms(text))
    out = []
    for item, words in asked.items():
        found = []
        for d, t in held:
            tf, m = Counter(t), 25 + (75 * len(t) * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m))
                for w in words
                if w in df
            )
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        found.sort(key=lambda r: r[:3])
        out += [(item, rank + 1, r[3], -r[0]) for rank, r in enumerate(found[:k])]
    return out


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return key(tuple(r) for r in df.collect())


def tables(spark, rows, asked):
    items = spark.createDataFrame([(*a, None, 0) for a in asked], "item_id long, text string, doc_id string, score long")
    return fixtures.documents(spark, rows), items


ROWS = fixtures.edge_rows() + [
    (2**53 + 1, "Ünï-Code ÉA éa x1_y2 TOP", None, None, 0),
    (2**53, "Ünï-Code ÉA éa x1_y2 TOP", None, None, 0),
]


def asked_of(rows, seed=1):
    rng = random.Random(seed)
    words = [w for _, t, *_ in rows for w in terms(t)]
    asked = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(25)]
    asked += [(30, None), (31, ""), (32, "nowhere-found"), (33, "ünï CODE; éa ÉA"), (33, "top"), (None, words[0] + "."), (None, words[9])]
    return [*asked, (34, asked[0][1] + " " + asked[0][1])]


def test_equals_scoring_every_document(spark):
    asked = asked_of(ROWS)
    assert result(ranked_search.search(*tables(spark, ROWS, asked))) == key(brute(ROWS, asked))


@pytest.mark.parametrize("change", [{"BLOCK": 2}, {"ITEMS": 4}, {"ENTRIES": 20, "CELLS": 7}])
def test_small_blocks_give_the_same(spark, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(ranked_search, name, value)
    asked = asked_of(ROWS, 2)
    docs, items = tables(spark, ROWS, asked)
    assert result(ranked_search.search(docs.repartition(5), items, k=3)) == key(brute(ROWS, asked, 3))


def test_integer_sums_where_doubles_are_not_exact(spark):
    rows = [(i, "rare " + "often " * (i + 1), None, None, 0) for i in range(8)] + [(9, "other", None, None, 0)]
    asked = [(1, "rare often " * 300_000)]
    query = ranked_search.Query([1], [(0, 0, 300_000), (0, 1, 300_000)], {b"rare": 0, b"often": 1}, [50_000, 50_000])
    assert query.table().dtype.kind == "i"
    asked[0] = (1, "rare often other " * 40_000)
    assert result(ranked_search.search(*tables(spark, rows, asked))) == key(brute(rows, asked))


def test_hot_stratum_ties_and_repeated_rows(spark, monkeypatch):
    # A third of all rows are copies: one stratum, cut into blocks; the smallest ids win.
    monkeypatch.setattr(ranked_search, "BLOCK", 16)
    rows = [(500 - i, "same words in every copy", None, None, 0) for i in range(120)]
    rows += [(1000 + i, f"same other{i} " + "pad " * (i % 7), None, None, 0) for i in range(200)]
    rows += [(381, "same words in every copy", None, None, 0), (None, "same words in every copy", None, None, 0)]
    random.Random(4).shuffle(rows)
    asked = [(1, "same words"), (2, "pad same"), (3, "other7 copy")]
    docs, items = tables(spark, rows, asked)
    assert result(ranked_search.search(docs.repartition(7), items)) == key(brute(rows, asked))


def test_empty_tables_and_very_long_text(spark):
    asked = [(1, "alpha beta"), (2, "gamma")]
    rows = [(1, "alpha " * 200_000 + "gamma", None, None, 0), (2, "alpha beta", None, None, 0), (3, None, None, None, 0)]
    docs, items = tables(spark, rows, asked)
    assert result(ranked_search.search(docs, items)) == key(brute(rows, asked))
    assert result(ranked_search.search(docs, items.limit(0))) == []
    assert result(ranked_search.search(docs.limit(0), items)) == []
    assert result(ranked_search.search(docs.filter("text IS NULL"), items)) == []


def test_blocks_below_the_floor_are_skipped(spark):
    """The bound of a block is what its best document could score, never less."""
    asked = asked_of(ROWS, 3)
    seen = []
    take = ranked_search.Best.take

    def spy(self, block, items):
        scores = block.scores(items)
        seen.append((scores <= block.bounds[items] + 0.5).all())
        take(self, block, items)

    docs, _ = tables(spark, ROWS, asked)
    vocabulary = {w: i for i, w in enumerate({w.encode() for _, t in asked for w in terms(t)})}
    entries = [(i, vocabulary[w.encode()], n) for i, (_, t) in enumerate(asked) for w, n in Counter(terms(t)).items()]
    query = ranked_search.Query(list(range(len(asked))), entries, vocabulary, None, len(ROWS), 5000)
    query.weights = [7] * len(vocabulary)
    counted = ranked_search.count_terms(docs, vocabulary).selectExpr("*", "monotonically_increasing_id() AS rid")
    batches = ranked_search.stratum_blocks(counted, query).toArrow().to_batches()
    best = ranked_search.Best([0] * len(asked), 1)
    blocks = [ranked_search.Block(b, i, query.table()) for b in batches for i in range(len(b))]
    skipped = 0
    for block in sorted(blocks, key=lambda b: -b.bounds.max(initial=0)):
        alive = [i for i in range(len(asked)) if block.bounds[i] >= best.floor[i]]
        skipped += len(asked) - len(alive)
        spy(best, block, ranked_search.np.array(alive, int))
    assert all(seen) and skipped > 0


def test_blocks_of_a_task_share_one_table(spark):
    docs, _ = tables(spark, ROWS, asked_of(ROWS, 3))
    vocabulary = {w: i for i, w in enumerate({w.encode() for r in ROWS for w in terms(r[1])})}
    query = ranked_search.Query([0], [(0, i, 1) for i in vocabulary.values()], vocabulary, None, len(ROWS), 5000)
    query.weights = [7] * len(vocabulary)
    counted = ranked_search.count_terms(docs, vocabulary).selectExpr("*", "monotonically_increasing_id() AS rid")
    table = query.table()
    for batch in ranked_search.stratum_blocks(counted, query).toArrow().to_batches():
        for row in range(len(batch)):
            held = vars(ranked_search.Block(batch, row, table))
            assert not any(isinstance(v, ranked_search.np.ndarray) and v.ndim > 1 for v in held.values() if v is not table)
