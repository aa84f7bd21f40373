import math
import re
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from silverline.llm import quality_rules as Q
from tests.llm.fixtures import documents, edge_rows, labels

WORD = re.compile("[^\x20\x09-\x0d]+")
TOKEN = re.compile(r"[^\W_]+|(?:[^\w\s]|_)+")


def base(t):
    t = t or ""
    w = WORD.findall(t)
    places = defaultdict(list)
    for i in range(len(w) - 4):
        places[tuple(w[i : i + 5])].append(i)
    again = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(w)
    failed = n < 10 or 100 * len(again) > 20 * n
    symbols = sum(c in "#*$%&|<>" for c in t)
    return n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again), failed


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def grams(t):
    """Buckets by Spark's xxhash64: a second column is hashed with the first's hash as seed."""
    tokens = [x.encode() for x in TOKEN.findall(t or "")]
    mask = Q.BUCKETS - 1
    one = [xxhash.xxh64_intdigest(x, seed=42) for x in tokens]
    two = [xxhash.xxh64_intdigest(b, seed=a) for a, b in zip(one, tokens[1:], strict=False)]
    return [h & mask for h in one + two]


def test_base_counts_and_verdict_equal_brute_force(spark):
    rows = edge_rows()
    got = Q.quality_rules(documents(spark, rows), labels(spark), threshold=0.0).collect()
    assert len(got) == len(rows)
    by_text = {(r[0], r[1]): base(r[1]) for r in rows}
    trusted = {i for i in range(40) if i % 4 != 0} - {3}
    raw, target = Counter(range(Q.BUCKETS)), Counter(range(Q.BUCKETS))
    for doc_id, t, *_ in rows:
        raw.update(grams(t))
        if doc_id in trusted:
            target.update(grams(t))
    weight = {b: math.log(target[b] / target.total()) - math.log(raw[b] / raw.total()) for b in raw}
    want = Counter()
    for (doc_id, t), b in by_text.items():
        g = grams(t)
        llr = sum(weight[x] for x in g) / len(g) if g else 0.0
        n = sum(1 for r in rows if (r[0], r[1]) == (doc_id, t))
        want[(doc_id, *b, round(llr, 9), not b[5] and llr >= 0)] += n
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    have = Counter((r["doc_id"], *[r[c] for c in names], round(r["llr"], 9), r["kept"]) for r in got)
    assert have == want


def test_filter_keeps_columns_and_empty_inputs(spark):
    docs = documents(spark)
    kept = Q.keep_good(docs, labels(spark))
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert Q.quality_rules(documents(spark, []), labels(spark)).count() == 0
    rows = Q.quality_rules(docs, labels(spark, [])).collect()
    assert all(r["llr"] == 0 for r in rows)


def test_every_trusted_document_counts(spark):
    """However many labels there are: those of other documents change nothing."""
    docs = documents(spark)
    few = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    many = few.unionByName(spark.range(1000, 61_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic"))
    assert Q.bucket_weights(docs, many) == Q.bucket_weights(docs, few)


def test_pairs_are_summed_without_a_test_for_the_last(spark):
    """The last token is added apart, so no pair's second token is tested; texts of few tokens score as before."""
    weights = [math.sin(i) for i in range(64)]
    column = Q.score(F.col("text"), weights)
    assert "isnotnull" not in str(column._jc.toString()).lower()
    texts = ["", " ", "a", "a b", "a, b", "中文 x_y 1"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select("text", column.alias("s")).collect()

    def bucket(*tokens):
        seed = 42
        for t in tokens:
            seed = xxhash.xxh64_intdigest(t.encode(), seed)
        return seed & 63

    for t, s in got:
        tokens = TOKEN.findall(t)
        total = 0.0
        for i, x in enumerate(tokens):
            total += weights[bucket(x)]
            if i + 1 < len(tokens):
                total += weights[bucket(x, tokens[i + 1])]
        assert s == (total / (2 * len(tokens) - 1) if tokens else 0.0), t
