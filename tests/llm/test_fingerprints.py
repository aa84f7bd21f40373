import hashlib

from pyspark.sql import functions as F

from silverline.llm import fingerprints as P
from tests.llm.fixtures import documents, edge_rows


def run(spark, monkeypatch, rows):
    import silverline.llm.fingerprints as module

    monkeypatch.setattr(module, "read", lambda *a: documents(spark, rows))
    return P.op10_fingerprints(spark, "").collect()


def test_edited_texts_and_equal_fingerprints(spark, monkeypatch):
    rows = edge_rows()
    monkeypatch.setattr(P, "ROWS_PER_BUCKET", 4)
    got = run(spark, monkeypatch, rows)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want, by_text = [], {}
    for i, (doc_id, t, *_) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + following[:third]
        want.append((doc_id, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == sorted(want, key=str)
    for doc_id, t, *_ in rows:
        by_text.setdefault(t or "", set()).update(
            r["fingerprint"] for r in got if r["doc_id"] == doc_id and r["n_chars"] == len(t or "") and doc_id is not None
        )
    assert all(len(v) <= 1 for v in by_text.values())
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_order_free_and_incremental(spark):
    a, b, c = "First line.", "Second line!", "Third one?"
    df = spark.createDataFrame([(f"{a}\n{b}\n{c}", f"{c}\n{a}\n{b}", f"{a}\n{c}", b)], "abc string, cab string, ac string, b string")
    fps = df.select(*[P.fingerprint(F.col(x)).alias(x) for x in df.columns])
    row = fps.select(
        (F.col("abc") == F.col("cab")).alias("order_free"),
        (P.add(F.col("ac"), F.col("b")) == F.col("abc")).alias("inserted"),
        (P.subtract(F.col("abc"), F.col("b")) == F.col("ac")).alias("deleted"),
        P.likeness(F.col("abc"), F.col("cab")).alias("same"),
        P.likeness(F.col("ac"), F.col("abc")).alias("near"),
    ).first()
    assert row["order_free"] and row["inserted"] and row["deleted"] and row["same"] == 1.0 and 0.4 < row["near"] < 1


def test_one_document_and_none(spark, monkeypatch):
    (row,) = run(spark, monkeypatch, [(7, "abcdef", None, None, None)])
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and row["near_next"] == 1.0
    assert run(spark, monkeypatch, []) == []
