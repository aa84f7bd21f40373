"""Filter audit against a walk over every order."""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import permutations

import pytest

from silverline.llm import filter_audit
from tests.llm import fixtures


def brute(rows, marks):
    good = {d for d, q, _ in marks if d is not None and q == 1}
    toxic = {d for d, _, t in marks if d is not None and t == 1}
    docs = [(d, t or "", s or "") for d, t, _, s, _ in rows]
    fails = []
    for d, t, _ in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            f.add("C")
        if re.search(r"[#$%&*|]", t):
            f.add("D")
        if d is not None and any(e is not None and e < d and u == t for e, u, _ in docs):
            f.add("E")
        fails.append(f)
    out = {}
    shapley = defaultdict(int)
    for part in {p for _, _, p in docs}:
        mine = [(d, f) for (d, _, p), f in zip(docs, fails, strict=True) if p == part]
        for order in permutations("ABCDE"):
            alive = mine
            for step, f in enumerate(order):
                gone = [(d, x) for d, x in alive if f in x]
                alive = [(d, x) for d, x in alive if f not in x]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step + 1] = (
                    len(alive), len(gone), sum(f in x for _, x in mine) - len(gone),
                    sum(x == {f} for _, x in mine), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(df):
    cols = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in cols) for r in rows}
    assert len(out) == len(rows)
    return out


MARKS = [(i, int(i % 4 != 0), int(i % 5 == 0)) for i in range(40)] + [(2, None, None), (None, 1, 0), (3, 0, 1)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(MARKS, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("extra", [False, True])
def test_equals_a_walk_over_every_order(spark, labels, extra):
    rows = fixtures.edge_rows()
    got = result(filter_audit.audit(fixtures.documents(spark, rows, extra=extra), labels))
    assert got == brute(rows, MARKS)


def test_hot_keys_take_the_broadcast_way(spark, labels, monkeypatch):
    # One text and one id on a third of the rows each, ids beyond 2^53, and a share that makes few keys hot.
    big = 2**53
    rows = [(big + i, "same %", "en", "hot", 6) for i in range(40)]
    rows += [(7, f"own text {i}", "en", "hot" if i % 2 else None, 9) for i in range(40)]
    rows += [(big + 100 + i, f"Pair {i // 2}", "en", "cold", 6) for i in range(30)] + [(None, "same %", "en", "", 6)]
    marks = [*MARKS, (big + 1, 1, 1), (big + 2, 0, 1)]
    monkeypatch.setattr(filter_audit, "HOT_SHARE", 0.1)
    docs = fixtures.documents(spark, rows)
    got = result(filter_audit.audit(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")))
    assert got == brute(rows, marks)


def test_long_text_no_failures_and_empty_table(spark, labels):
    long = " ".join(f"w{i}" for i in range(150_000))
    rows = [(1, long, "en", "a", 0), (2, long + " x", "en", "a", 0)]
    got = result(filter_audit.audit(fixtures.documents(spark, rows), labels))
    assert got == brute(rows, MARKS) and set(got.values()) == {(2, 0, 0, 0, 0, 0, 0)}
    assert filter_audit.audit(fixtures.documents(spark, []), labels).collect() == []
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert result(filter_audit.audit(fixtures.documents(spark, rows), none)) == got


def test_fewer_filters(spark, labels):
    rows = fixtures.edge_rows()
    got = result(filter_audit.audit(fixtures.documents(spark, rows), labels, filters="CD"))
    full = brute(rows, MARKS)
    assert {o for _, o, _ in got} == {"CD", "DC"}
    for (part, order, step), v in got.items():
        assert v[:2] == full[part, order + "ABE", step][:2]
