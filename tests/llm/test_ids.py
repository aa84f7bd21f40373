"""Whole numbers beyond 2^53 beside null and repeated ids, in one batch."""

from __future__ import annotations

from collections import Counter

import pytest

from silverline.llm import bpe, jaccard_join, quality_classifier, suffix_dedup
from tests.llm.fixtures import documents, labels

BIG = 2**53 + 1
PASSAGE = " ".join(f"p{i}" for i in range(80))
ROWS = [
    (BIG, PASSAGE, "en", "a", 0),
    (BIG + 1, PASSAGE, "en", "a", 0),
    (BIG + 2, "x " + PASSAGE, "en", "a", 0),
    (None, "alone in this table " + " ".join(f"q{i}" for i in range(30)), "en", "a", 0),
    (None, None, None, None, 0),
    (7, "one id", "en", "a", 0),
    (7, "on two texts", "en", "a", 0),
    (BIG + 4, "", "en", "a", 0),
]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, ROWS).coalesce(1).persist()


def ids(df):
    return Counter(r["doc_id"] for r in df.collect())


EXPECTED = Counter(r[0] for r in ROWS)


def test_classifier(spark, docs):
    out = quality_classifier.classify(docs, labels(spark))
    assert ids(out) == EXPECTED and dict(out.dtypes)["doc_id"] == "bigint"


def test_suffix_dedup(spark, docs):
    out = suffix_dedup.cut(docs)
    assert ids(out) == EXPECTED
    removed = {r["doc_id"]: r["n_removed"] for r in out.collect()}
    assert all(removed[BIG + i] > 200 for i in range(3)) and removed[BIG + 4] == 0


def test_bpe(spark, docs):
    path = bpe.default_vocabulary()
    assert ids(bpe.digests(docs, path, ["doc_id", "source"])) == EXPECTED
    out = bpe.encode(docs, path, ["doc_id", "text"])
    assert ids(out) == EXPECTED and all((r["text"] or "") == r["decoded"] for r in out.collect())


def test_jaccard_join(spark, docs):
    out = jaccard_join.join(docs, 3, 90).collect()
    assert Counter(r["doc_id"] for r in out) == EXPECTED
    assert {r["component_id"] for r in out if r["doc_id"] in (BIG, BIG + 1, BIG + 2)} == {BIG}
    assert {r["component_id"] for r in out if r["doc_id"] == 7} == {7}


def test_one_of_a_group_stays_whatever_the_columns_are_called(spark, docs):
    kept = jaccard_join.keep_one(docs.selectExpr("*", "12 AS row_mark", "'x' AS row_mark_", "5 AS mark"))
    assert ids(kept) == EXPECTED - Counter([BIG + 1, BIG + 2])
    assert {tuple(r[-3:]) for r in kept.collect()} == {(12, "x", 5)}
