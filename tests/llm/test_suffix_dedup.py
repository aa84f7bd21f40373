import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from silverline.llm import suffix_dedup as S
from tests.llm.fixtures import documents, edge_rows


def brute(texts, length=200):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        gone = np.cumsum(cover)[: len(t)] > 0
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def hard_rows():
    rng = random.Random(3)

    def prose(n):
        return "".join(rng.choices("abcdefgh ", k=n))

    passage, line, near = prose(260), prose(60), prose(900)
    texts = [prose(rng.randint(0, 150)) + line + prose(90) + (passage if i % 2 else "") + prose(50) for i in range(60)]
    texts += ["Der " * 200, "Der " * 120, "x" * 199, "x" * 200, "x" * 201, passage, passage[:200], passage[5:205], "é" * 300]
    for _ in range(12):
        at = rng.randrange(890)
        texts.append(near[:at] + prose(3) + near[at:])
    return [(500 + i, t, None, None, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("max_group", [400, 5])
def test_cut_equals_brute_force(spark, monkeypatch, max_group):
    """With groups of 5 the halving goes down to single windows."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(S.repeated_spans, "__defaults__", (S.LENGTH, S.GRAM, max_group))
    rows = edge_rows() + hard_rows()
    got = S.cut(documents(spark, rows)).withColumn("h", F.sha2("kept", 256))
    got = got.select("doc_id", "n_bytes", "n_removed", "n_spans", "h").collect()
    want = [(r[0], *b) for r, b in zip(rows, brute([(r[1] or "").encode() for r in rows]), strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_maximal_repeats_list_all_occurrences():
    text = "xabcdeyabcdezabcdq"
    codes = np.array([ord(c) for c in text], dtype=np.int64)
    order, lcp = S.suffix_array(codes, 32)
    assert [text[i:] for i in order] == sorted(text[i:] for i in range(len(text)))
    left = np.concatenate([[-1], codes[:-1]])
    found = {text[p[0] : p[0] + n]: sorted(p.tolist()) for n, p in S.maximal_repeats(order, lcp, left, 3)}
    assert found == {"abcde": [1, 7], "abcd": [1, 7, 13]}


def test_anchors_of_equal_windows_are_equal():
    rng = random.Random(1)
    window = bytes(rng.choices(range(97, 123), k=500))
    a, b = b"A" * 37 + window, bytes(rng.choices(range(97, 123), k=90)) + window + b"!"
    powers = S.Powers(S.CHUNK + S.LENGTH)
    pa, pb = set(S.anchors(a, powers).tolist()), set(S.anchors(b, powers).tolist())
    for s in range(0, 301):
        inside = {p - s for p in (x - 37 for x in pa) if s <= p <= s + 150}
        assert inside & {p - s for p in (x - 90 for x in pb) if s <= p <= s + 150}


def test_empty_table(spark):
    assert S.cut(documents(spark, [])).count() == 0


def test_spans_of_repeated_rows_are_gathered_once(spark):
    row = hard_rows()[1]

    def gathered(copies):
        rows = S.identified(documents(spark, [row] * copies))
        (got,) = S.spans_by_row(rows).collect()
        return sorted(map(tuple, got["spans"]))

    assert gathered(2) == gathered(30)


def test_sparse_array_finds_what_the_whole_one_finds():
    """Groups of contexts that share a gram, at their texts' ends too, with zero bytes; one context is not open."""
    rng = random.Random(8)
    gram = bytes(rng.choices(b"ab\0", k=S.GRAM))
    before, after = bytes(rng.choices(b"ab\0", k=150)), bytes(rng.choices(b"ab\0", k=150))
    keys, data, at = [], [], []
    for key in range(30):
        for _ in range(rng.randint(1, 12)):
            l, r = rng.choice([0, 7, 60, 90, 149, 150]), rng.choice([0, 30, 60, 110, 150])
            own = [bytes(rng.choices(b"xy\0", k=n)) for n in (rng.choice([0, 150 - l]), rng.choice([0, 150 - r]))]
            keys.append(key)
            data.append(own[0] + before[150 - l :] + gram + after[:r] + own[1])
            at.append(len(own[0]) + l)
    is_open = np.array([i != 5 for i in range(len(data))])
    got = S.covered_at(np.array(keys), data, np.array(at), is_open, S.LENGTH, S.GRAM)
    whole = S.covered(keys, data, [-x for x in at], S.LENGTH)
    want = [S.merge([(int(a) - p, int(b) - p) for a, b in spans]) for spans, p in zip(whole, at, strict=True)]
    got = [[(-int(l), int(r))] if r else [] for l, r in got]
    assert [x for x, o in zip(got, is_open, strict=True) if o] == [x for x, o in zip(want, is_open, strict=True) if o]
    assert sum(map(bool, got)) > 40


def test_contexts_are_counted_without_a_sort(spark):
    """Aggregates that hold structs or texts sort all rows; so did the contexts' and the texts' before."""
    from pyspark.sql import functions as F

    rows = spark.range(10).select(
        *[F.col("id").alias(c) for c in ("row", "pos", "lo", "hi", "first", "last", "key", "ctx")], F.lit(False).alias("done")
    )
    plan = S._nodes(rows)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    docs = S.identified(documents(spark, hard_rows()[:2]))
    plan = S.contexts_at(docs, rows.select("row", "pos"), S.LENGTH, S.GRAM)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_places_are_told_apart_across_batches(spark):
    """Single grams give nothing; equal places all come, and one place of each context where a gram has several."""
    grams = {1: [5], 2: [5] * 7, 3: [5, 6], 4: [5, 5, 5, 6, 7, 7, 7, 7]}
    rows = [(g * 100 + i, i, g, c) for g, contexts in grams.items() for i, c in enumerate(contexts)]
    index = spark.createDataFrame(rows, "row long, pos int, gram long, ctx long")
    for size in ("1", "3", "1000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = S.grouped(index).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        equal = sorted(r["row"] for r in got if r["kind"] == S.EQUAL)
        assert equal == [*range(200, 207), 400, 401, 402, 404, 405, 406, 407]
        nodes = sorted((r["key"], r["ctx"], r["kind"]) for r in got if r["kind"] != S.EQUAL)
        assert nodes == [(3, 5, S.OPEN), (3, 6, S.OPEN), (4, 5, S.SEVERAL), (4, 6, S.OPEN), (4, 7, S.SEVERAL)]
