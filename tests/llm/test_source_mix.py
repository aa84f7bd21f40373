from collections import defaultdict

from pyspark.sql import functions as F

from silverline.llm import source_mix as S
from tests.llm.fixtures import documents, edge_rows


def words(t):
    return len((t or "").encode().split())


def targets(rows):
    sizes = defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += words(t)
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in rest)) if rest else 0
        over = {s for s in rest if level * weight[s] > 3 * sizes[s]}
        if not over:
            return sizes, {s: 3 * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= over


def test_targets_and_taken_words(spark):
    rows = edge_rows() + [(900, "one two three", "en", "tiny", 13)]
    got = S.mix(documents(spark, rows), block_words=8, shard_words=200, keep=["source"]).collect()
    sizes, want = targets(rows)
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["_keep_source"]]
        assert abs(r["target"] - want[r["_keep_source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["_keep_source"]] += r["taken"]
    for s, t in want.items():
        shards = -(-sizes[s] // 200) + 1
        assert abs(taken[s] - t) <= 8 * shards + 8, (s, taken[s], t)


def test_reruns_agree_and_rows_hold_the_words_taken(spark):
    docs = documents(spark)
    once = sorted(map(str, S.mix(docs, 8, 200).collect()))
    assert once == sorted(map(str, S.mix(docs.repartition(5), 8, 200).collect()))
    out = S.materialise(docs, 8, 200)
    assert out.columns == docs.columns
    total = S.mix(docs, 8, 200).agg(F.sum("taken")).first()[0]
    assert sum(words(r["text"]) for r in out.collect()) == total


def test_sainte_lague_equals_seat_by_seat(spark):
    weights = [0, 3, 3, 5, 5, 5, 97, 1000, 12]
    for seats in (0, 1, 7, 50, 333):
        df = spark.createDataFrame([(1, i, float(w), seats) for i, w in enumerate(weights)], "g int, i int, w double, s long")
        got = {r["i"]: r["quota"] for r in S.sainte_lague(df, ["g"], "i", "w", "s").collect()}
        want = dict.fromkeys(range(len(weights)), 0)
        for _ in range(seats):
            best = max(want, key=lambda i: (weights[i] / (2 * want[i] + 1), -i))
            want[best] += 1
        assert got == want


def test_empty_table_and_no_words(spark):
    assert S.mix(documents(spark, [])).count() == 0
    (row,) = S.mix(documents(spark, [(1, None, None, None, None)])).collect()
    assert (row["size"], row["source_size"], row["target"], row["taken"]) == (0, 0, 0.0, 0)
