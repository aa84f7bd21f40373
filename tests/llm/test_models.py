"""Operators 1, 4 and 7."""

import math
import pickle
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from silverline.llm import license_scan as C
from silverline.llm import lm_scoring as L
from silverline.llm import quality_classifier as Q
from tests.llm.fixtures import documents, edge_rows, labels

SF = "/root/testdata/sf0.01"


def test_classifier_on_held_out_labels(spark):
    got = Q.op1_quality_classifier(spark, SF).toPandas()
    marks = pd.read_parquet(f"{SF}/labels.parquet")
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert ((got.score >= 0.3).astype(int) == got.predicted).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got.doc_id, got.held_out, strict=True))
    held = got[got.held_out].merge(marks, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.9


def test_classifier_edges(spark):
    rows = edge_rows()
    got = Q.classify(documents(spark, rows), labels(spark)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    empty = {round(r["score"], 9) for r in got if r["doc_id"] in (30, 31, 32)}
    assert len(empty) == 1
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [True, True]
    assert {r["score"] for r in Q.classify(documents(spark, rows), labels(spark, [])).collect()} == {0.5}
    assert Q.classify(documents(spark, []), labels(spark)).count() == 0


def test_word_vectors_do_not_depend_on_partitions(spark):
    docs = documents(spark)
    assert np.array_equal(Q.word_vectors(docs.repartition(3)), Q.word_vectors(docs.repartition(7)))


def test_losses_equal_brute_force(spark):
    rows = edge_rows()
    got = {(r["doc_id"], r["n_tokens"]): r for r in L.score(documents(spark, rows), labels(spark)).collect()}
    trusted = {i for i in range(40) if i % 4 != 0} - {3}
    sides = []
    for keep in (lambda i: True, lambda i: i in trusted):
        uni, bi, hist = Counter(), Counter(), Counter()
        for doc_id, t, *_ in rows:
            if keep(doc_id):
                w = (t or "").split()
                uni.update(w)
                pairs = list(zip(["<s>", *w], w, strict=False))
                bi.update(pairs)
                hist.update(a for a, _ in pairs)
        sides.append((uni, bi, hist))
    size = L.VOCABULARY + 2

    def loss(side, w):
        uni, bi, hist = side
        total = uni.total()
        out = 0.0
        for a, b in zip(["<s>", *w], w, strict=False):
            p1 = (uni[b] + L.ALPHA) / (total + L.ALPHA * size)
            out -= math.log(L.LAMBDA * bi[(a, b)] / max(1, hist[a]) + (1 - L.LAMBDA) * p1)
        return out / len(w)

    for doc_id, t, *_ in rows:
        # The library splits at ASCII white space only; these texts hold no other.
        w = (t or "").split()
        r = got[(doc_id, len(w))]
        if w:
            assert abs(r["background_loss"] - loss(sides[0], w)) < 1e-5
            assert abs(r["target_loss"] - loss(sides[1], w)) < 1e-5
        assert abs(r["score"] - (r["background_loss"] - r["target_loss"])) < 1e-9
    assert L.score(documents(spark, []), labels(spark)).count() == 0


def test_license_rules(spark):
    mit = (
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and "
        'associated documentation files (the "Software"), to deal\nin the Software without restriction, including without '
        "limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the "
        "Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of "
        'the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT '
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.\n"
    )
    texts = [
        mit,
        "some | table |\nLicensed under CC BY-NC 4.0.",
        "Text. Released under the MIT License.\nReleased under the MIT License.",
        mit.replace("The above copyright notice and", "Another notice and"),  # a sentence of the rule is missing
        "Not licensed. A licence to copy.",
        None,
        "",
        mit + "\nReleased under the MIT License.",
    ]
    docs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    got = sorted((r["doc_id"], r["licence"], r["rule"], r["complete"]) for r in C.scan(docs).collect())
    assert got == [
        (0, "MIT", "mit-full", True),
        (1, "CC-BY-NC-4.0", "cc-by-nc-mention", False),
        (2, "MIT", "mit-mention", False),
        (2, "MIT", "mit-mention", False),
        (7, "MIT", "mit-full", True),
    ]
    without_hint = C.scan(docs, hint="")
    assert without_hint.count() == len(got)
    assert C.scan(documents(spark, [])).count() == 0


def test_license_lines_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("x")).where("x ilike '%licensed under%' or x ilike '%released under%'")
    got = C.op7_license_scan(spark, SF)
    assert got.count() == lines.count() > 0


def test_losses_do_not_depend_on_what_tasks_hold(spark):
    """Bigrams and words outside the tables of the tasks count as all others do."""
    docs = documents(spark)
    names = ["n_tokens", "background_loss", "target_loss", "score"]

    def losses(*held):
        got = L.score(docs, labels(spark), *held).collect()
        return sorted([(str(r["doc_id"]), *[round(r[c], 9) for c in names]) for r in got])

    everything = losses()
    assert losses(0, 0) == losses(20, 10) == losses(1000, 0) == everything


def test_chunks_of_few_tokens_and_many_buckets(spark, monkeypatch):
    """Texts that end chunks, bigrams of one bucket from many chunks."""
    docs = documents(spark).repartition(3)

    def losses():
        got = L.score(docs, labels(spark), 1000, 0).collect()
        return sorted((str(r["doc_id"]), r["n_tokens"], round(r["background_loss"], 9), round(r["score"], 9)) for r in got)

    whole = losses()
    monkeypatch.setattr(L, "CHUNK", 7)
    monkeypatch.setattr(L, "BUCKET_TOKENS", 1)
    assert losses() == whole
    # More trusted ids than are sent to tasks.
    marked = L.marked
    monkeypatch.setattr(L, "marked", lambda docs, labels, path: marked(docs, labels, path, small=0))
    assert losses() == whole


def test_tables_come_back_whole():
    frequent = pd.DataFrame({"h": [7, -3, 1 << 62], "ub": [5, 1 << 40, 1], "ut": [0, 1, 1], "hb": [2, 2, 0], "ht": [0, 1, 0]})
    keys = np.array([-(1 << 63), -5, 4, (1 << 63) - 1], dtype=np.int64)
    sent = L.Tables(frequent, keys, np.arange(8).reshape(4, 2) << 33, np.array([9.0, 4.0]), 20)
    got = pickle.loads(pickle.dumps(sent))
    for name in ("number", "words", "p1", "loss1", "share", "keys", "bigrams"):
        assert (getattr(got, name) == getattr(sent, name)).all(), name
    empty = L.Tables(frequent[:0], keys[:0], np.zeros((0, 2), np.int64), np.array([0.0, 0.0]), 20)
    assert len(pickle.loads(pickle.dumps(empty)).words) == 0


def test_packed_rows_come_back_whole():
    keys = np.array([3, 3, 9, (1 << 40) - 1], dtype=np.int64)
    places = np.array([0, 1, 1, (1 << 20) - 1], dtype=np.int64)
    n = np.array([2, 3, 1 << 33, 4], dtype=np.int64)
    rid = np.array([5, (1 << 63) - 1, 0, 1 << 33], dtype=np.int64)
    assert (L.unpack(L.pack(keys << L.SHIFT | places, n, rid)) == np.stack([keys, n, rid])).all()


def test_license_mentions_over_line_ends_and_other_sentences_between(spark):
    wrapped = "Notes. This work is licensed under the GNU General\nPublic License version 3. More."
    grant = next(k for k, v in C.SENTENCES.items() if v == "gpl3-grant")
    warranty = next(k for k, v in C.SENTENCES.items() if v == "gpl-no-warranty")
    mention = "Released under the MIT License."
    texts = [
        wrapped,
        wrapped + "\n" + wrapped + "\nThis work is licensed under the GNU General Public License version 3.",
        f"{grant}. {mention} {warranty}.",
        f"{grant}. {grant}. {warranty}. {warranty}.",
        f"{grant}. One. Two. {mention} {warranty}.",
        f"Intro. {mention} Outro.",
        'Licensed under the Apache License, Version 2.0\n(the "License");',
    ]
    docs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    got = sorted((r["doc_id"], r["rule"], r["first"], r["last"]) for r in C.scan(docs).collect())
    assert got == [
        (0, "gpl3-mention", 1, 1),
        (1, "gpl3-mention", 1, 1),
        (1, "gpl3-mention", 4, 4),
        (1, "gpl3-mention", 8, 8),
        (2, "gpl3-header", 0, 2),
        (2, "mit-mention", 1, 1),
        (3, "gpl3-header", 1, 2),
        (4, "mit-mention", 3, 3),
        (5, "mit-mention", 1, 1),
        (6, "apache-mention", 0, 0),
    ]


def test_own_catalogue_is_searched_in_every_text(spark):
    docs = documents(spark, [(1, "First. You may share this freely. Last.", None, None, None)])
    own = {"you may share this freely": "share"}
    (row,) = C.scan(docs, own, [("own", "Own-1", False, ["share"])]).collect()
    assert (row["doc_id"], row["licence"]) == (1, "Own-1")
    assert C.scan(docs, own, [("own", "Own-1", False, ["share"])], hint="nowhere").count() == 0


def test_queries_send_texts_to_python_in_small_batches(spark):
    from silverline.session import apply_defaults

    session = spark.newSession()
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    apply_defaults(session)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(batch)], pa.int64())})

    got = session.range(0, 5000, 1, 1).mapInArrow(sizes, "n long").collect()
    assert max(r["n"] for r in got) <= 1000 and sum(r["n"] for r in got) == 5000


def test_word_tables_hold_no_losses_beside_the_probabilities():
    frame = pd.DataFrame({c: np.arange(1, 9) for c in ("h", "ub", "ut", "hb", "ht")})
    held = L.Tables(frame, np.zeros(0, np.int64), np.zeros((0, 2), np.int64), np.array([36.0, 36.0]), 10)
    assert "loss1" not in vars(held) and (held.loss1 == -np.log(held.p1)).all()


def test_words_are_those_between_ascii_white_space():
    texts = [" a  b\x0b\x1c\n\tc ", "", None, "  ", "a a", "é\x85x y z", "a\x00b\x0c\x1f"]
    want = [[L.word_hash(w) for w in (t or "").encode().split()] for t in texts]
    assert [x.tolist() for x in L.word_hashes(texts)] == want
    assert L.word_hashes(["x", ""])[1].dtype == np.int64


def test_rows_of_losses_rise_with_the_documents_alone():
    """As long as a bucket has room, five times the tokens are dealt to as many buckets."""
    assert L.bucket_count(28e6) == L.bucket_count(5 * 28e6) == L.BUCKETS
    assert L.bucket_count(8.4e9) * L.BUCKET_TOKENS >= 8.4e9


def test_packed_rows_of_a_block_go_out_together(spark, monkeypatch):
    monkeypatch.setattr(L, "BUCKETS", 1 << 4)
    frequent = pd.DataFrame({"h": np.sort([L.START, *(L.word_hash(w) for w in (b"a", b"b", b"c", b"d"))]),
                             "ub": 9, "ut": 1, "hb": 9, "ht": 1})
    tables = L.Tables(frequent, np.zeros(0, np.int64), np.zeros((0, 2), np.int64), np.array([36.0, 4.0]), 20)
    rows = spark.createDataFrame([(1, 1, "a b c d a c b d", False)], "rid long, doc_id long, text string, trusted boolean")
    seen = []
    rows_of = SimpleNamespace(
        schema=rows.schema, columns=rows.columns, mapInArrow=lambda run, _: seen.extend(run(rows.toArrow().to_batches()))
    )
    L._emitted(rows_of, SimpleNamespace(value=tables), L.bucket_count(1.0))
    assert len(seen) == 2 and seen[1].column("packed").null_count == 0 and seen[1].num_rows > 1


def test_long_words_of_any_bytes_are_told_apart():
    """Words of one to forty bytes, also alike but for a zero byte at their end or for their last byte."""
    words = [b"a" * n + last for n in range(40) for last in (b"a", b"b", b"\0", b"\xc3\xa9")]
    assert len({L.word_hash(w) for w in words}) == len(set(words))
    text = b" ".join(words).decode()
    assert [x.tolist() for x in L.word_hashes([text, text[1:], None])] == [
        [L.word_hash(w) for w in t.encode().split(b" ") if w] for t in (text, text[1:], "")
    ]


def test_packed_numbers_of_documents_take_few_bytes():
    """Of 4,096 bigrams in 64 documents: some three and a half bytes for a step, and less than one for count and document."""
    rng = np.random.default_rng(4)
    keys = np.sort(rng.integers(0, 1 << 36, 4096))
    packed = L.pack(keys << L.SHIFT, np.full(4096, 2), (7 << 33) + rng.integers(0, 64, 4096))
    assert len(packed) < 4096 * 4.5


def test_rows_of_other_words_carry_no_factors(spark):
    """The factors of the word that the tables hold are looked up where the row arrives."""
    frequent = pd.DataFrame({"h": np.sort([L.START, L.word_hash(b"a")]), "ub": 9, "ut": 1, "hb": 9, "ht": 1})
    tables = L.Tables(frequent, np.zeros(0, np.int64), np.zeros((0, 2), np.int64), np.array([36.0, 4.0]), 20)
    rows = spark.createDataFrame([(1, 1, "a x y a", False)], "rid long, doc_id long, text string, trusted boolean")
    got = L._emitted(rows, spark.sparkContext.broadcast(tables), L.bucket_count(1.0)).where(f"kind < {L.HEAD}").collect()
    assert len(got) == 3 and all(r["more"]["b"] is None and r["more"]["t"] is None for r in got)
    assert [r["more"]["known"] is None for r in got].count(True) == 1
