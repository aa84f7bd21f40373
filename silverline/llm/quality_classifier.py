"""Operator 1: quality classifier on random-indexing vectors.

1. Word vectors. Tokens are hashed to ``BUCKETS``; each bucket has a fixed sparse ternary index
   vector, and its word vector sums the index vectors of the tokens up to
   ``WINDOW`` places away, over all documents. The sums are whole numbers, so they
   do not depend on how the documents are dealt. The table has a fixed size.
2. Pooling. A document is the mean vector of its tokens, the mean of its
   distinct tokens, and two numbers on its length and variety.
3. A two-layer network in numpy, fitted by Adam on at most ``MAX_FIT`` labelled
   documents (those with the smallest id hashes) outside the held-out fifth. A
   fifth of those is set apart, and the temperature that gives the least log loss on
   it divides the logits.

Labels, lang, source and doc_id are no inputs of a score. Defined results: a null text is
empty, and an empty text has the zero vector and that vector's score; repeated rows get
equal scores; several labels of a document count as good if any is; a null doc_id counts as
held out; with no usable labels every score is 0.5.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm.common import read, with_results

BUCKETS = 1 << 13
DIMENSIONS = 32
NONZERO = 4
WINDOW = 2
HIDDEN = 32
MAX_FIT = 20_000
EPOCHS = 40
THRESHOLD = 0.3
SEED = 11
CHUNK = 1 << 18
TOKENS = re.compile(r"\w+|[^\w\s]+").findall


class Buckets(dict):
    """Bucket of each token, remembered up to a bound."""

    def __missing__(self, token: str) -> int:
        if len(self) > 300_000:
            self.clear()
        bucket = zlib.crc32(token.encode("utf-8", "replace")) % BUCKETS
        self[token] = bucket
        return bucket


def index_vectors() -> np.ndarray:
    """Sparse ternary vectors of the buckets; the last row, for no token, is zero."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((BUCKETS + 1, DIMENSIONS), dtype=np.int8)
    places = rng.random((BUCKETS, DIMENSIONS)).argsort(axis=1)[:, :NONZERO]
    np.put_along_axis(out[:BUCKETS], places, rng.choice([-1, 1], (BUCKETS, NONZERO)), axis=1)
    return out


def token_ids(text, buckets: Buckets) -> np.ndarray:
    tokens = TOKENS(text) if isinstance(text, str) else []
    return np.fromiter(map(buckets.__getitem__, tokens), dtype=np.int32, count=len(tokens))


def add_contexts(ids: np.ndarray, index: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    """Add the contexts of a run of tokens; BUCKETS stands between documents."""
    context = np.zeros((len(ids), DIMENSIONS), dtype=np.int8)  # at most 2 * WINDOW
    for k in range(1, WINDOW + 1):
        context[k:] += index[ids[:-k]]
        context[:-k] += index[ids[k:]]
    order = np.argsort(ids, kind="stable")
    sorted_ids = ids[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]]))
    sums[sorted_ids[starts]] += np.add.reduceat(context[order], starts, axis=0, dtype=np.int32)
    counts += np.bincount(ids, minlength=BUCKETS + 1)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """(BUCKETS + 1, DIMENSIONS) unit word vectors, each with its own index vector added."""
    dims = [f"d{i}" for i in range(DIMENSIONS)]

    def run(frames):
        buckets, index = Buckets(), index_vectors()
        sums = np.zeros((BUCKETS + 1, DIMENSIONS), dtype=np.int64)
        counts = np.zeros(BUCKETS + 1, dtype=np.int64)
        gap = np.full(WINDOW, BUCKETS, dtype=np.int32)
        run_, size = [gap], 0
        for pdf in frames:
            for text in pdf["text"]:
                ids = token_ids(text, buckets)
                run_ += [ids, gap]
                size += len(ids)
                if size > CHUNK:
                    add_contexts(np.concatenate(run_), index, sums, counts)
                    run_, size = [gap], 0
        add_contexts(np.concatenate(run_), index, sums, counts)
        seen = np.flatnonzero(counts[:BUCKETS])
        out = pd.DataFrame(sums[seen], columns=dims)
        out.insert(0, "bucket", seen)
        out.insert(1, "n", counts[seen])
        yield out

    schema = ", ".join(["bucket int", "n long", *[f"{d} long" for d in dims]])
    parts = docs.select("text").mapInPandas(run, schema)
    rows = parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ["n", *dims]]).collect()  # BUCKETS at most
    out = np.zeros((BUCKETS + 1, DIMENSIONS))
    n = np.zeros(BUCKETS + 1)
    for r in rows:
        n[r["bucket"]] = r["n"]
        out[r["bucket"]] = r[2:]
    mean = out.sum(axis=0) / max(1.0, n.sum())
    out = out / np.maximum(n, 1)[:, None] - mean
    own = index_vectors() / np.sqrt(NONZERO)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    out = np.where((n > 0)[:, None] & (norm > 0), out / np.maximum(norm, 1e-12), 0.0) + own
    out[BUCKETS] = 0
    return out.astype(np.float32)


def pool(text, vectors: np.ndarray, buckets: Buckets) -> np.ndarray:
    """The features of one document."""
    ids = token_ids(text, buckets)
    out = np.zeros(2 * DIMENSIONS + 2, dtype=np.float32)
    if len(ids):
        counts = np.bincount(ids, minlength=1)
        seen = np.flatnonzero(counts)
        picked = vectors[seen]
        out[:DIMENSIONS] = counts[seen] @ picked / len(ids)
        out[DIMENSIONS:-2] = picked.mean(axis=0)
        out[-2] = np.log1p(len(ids)) / 10
        out[-1] = len(seen) / len(ids)
    return out


class Network:
    """Features to one hidden tanh layer to a logit, divided by a temperature."""

    def __init__(self, w1, b1, w2, b2, mean, scale, temperature=1.0):
        self.parts = [w1, b1, w2, b2]
        self.mean, self.scale, self.temperature = mean, scale, temperature

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.parts
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def log_loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit(x: np.ndarray, y: np.ndarray, apart: np.ndarray) -> Network:
    """Weights on the rows not ``apart``, temperature on those that are."""
    rng = np.random.default_rng(SEED)
    xt, yt = x[~apart], y[~apart]
    scale = xt.std(axis=0) + 1e-6
    net = Network(
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1), xt.mean(axis=0), scale,
    )
    z = (xt - net.mean) / scale
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts]
    step, size = 0, 128
    for _ in range(EPOCHS):
        order = rng.permutation(len(z))
        for i in range(0, len(z), size):
            at = order[i : i + size]
            w1, b1, w2, b2 = net.parts
            hidden = np.tanh(z[at] @ w1 + b1)
            error = 1 / (1 + np.exp(-np.clip(hidden @ w2 + b2[0], -30, 30))) - yt[at]
            back = np.outer(error, w2) * (1 - hidden**2)
            grads = [z[at].T @ back, back.sum(0), hidden.T @ error, error.sum(keepdims=True)]
            step += 1
            for p, g, (m, v) in zip(net.parts, grads, moments, strict=True):
                g = g / len(at) + 1e-4 * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    if apart.any():
        logits = net.logits(x[apart])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
        net.temperature = float(grid[np.argmin([log_loss(logits / t, y[apart]) for t in grid])])
    return net


def held_out():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 0


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, max_fit: int = MAX_FIT) -> Network | None:
    """Fit on at most ``max_fit`` labelled documents that are not held out."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_fit)
    )
    # max_fit ids and labels: 16 bytes each. Of several texts of an id the one with the
    # least hash, chosen before anything is gathered: at most max_fit rows in all.
    texts = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "y")
        .agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    )
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(frames):
        buckets = Buckets()
        for pdf in frames:
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"],
                    "y": pdf["y"],
                    "apart": [zlib.crc32(f"calibrate:{d}".encode()) % 5 == 0 for d in pdf["doc_id"]],
                    "x": [pool(t, shared.value, buckets) for t in pdf["text"]],
                }
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = texts.mapInPandas(run, f"doc_id {id_type}, y long, apart boolean, x array<float>").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (str(r["doc_id"]), r["x"]))
    x = np.array([r["x"] for r in rows])
    y = np.array([float(r["y"]) for r in rows])
    apart = np.array([r["apart"] for r in rows])
    if apart.all():
        apart = ~apart
    return fit(x, y, apart)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    vectors = word_vectors(docs)
    net = train(docs, labels, vectors)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))

    def setup():
        buckets = Buckets()
        table, network = shared.value

        def step(pdf):
            x = np.array([pool(t, table, buckets) for t in pdf["text"]]).reshape(len(pdf), -1)
            score = network.scores(x) if network is not None and len(pdf) else np.full(len(pdf), 0.5)
            return {"score": score, "predicted": (score >= threshold).astype(np.int32)}

        return step

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return with_results(rows, ["doc_id", "held_out"], "text", fields, setup)


def op1_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
