from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from silverline.llm import jaccard_join as J
from silverline.llm.components import components
from tests.llm.fixtures import documents, edge_rows


def shingles(t, k):
    w = (t or "").encode().lower().split()
    m = min(k, len(w))
    return frozenset(tuple(w[i : i + m]) for i in range(len(w) - m + 1)) if w else frozenset()


def brute(rows, k, percent):
    sets = [shingles(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and 100 * len(a & b) >= percent * len(a | b):
            root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)] if sets[i] else rows[i][0]) for i in range(len(rows))), key=str)


def near_copies():
    """A chain of copies, each a little further from the first, and copies around one text."""
    import random

    rng = random.Random(2)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        copy = words[:]
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(150)] = f"n{rng.random()}"
        rows.append(" ".join(copy))
    for i in range(30):
        rows.append(" ".join([*(f"c{j}" for j in range(100)), *(f"x{j}" for j in range(2 * i))]))
    return [(1000 - i, t, None, None, None) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, k, percent):
    rows = edge_rows() + near_copies()
    got = J.join(documents(spark, rows), k, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, k, percent)


def test_texts_of_common_passages_do_not_meet(spark, monkeypatch):
    """Every passage is in many texts, so most tokens are shared, but no two texts link but the copies."""
    import random

    rng = random.Random(3)
    passages = [" ".join(f"p{i}w{j}" for j in range(60)) for i in range(30)]
    texts = [" ".join(rng.sample(passages, 4)) for _ in range(60)]
    rows = [(i, t, None, None, None) for i, t in enumerate([*texts, texts[0] + " end", texts[1]])]
    folder = J.scratch_path(spark, "passages")
    monkeypatch.setattr(J, "scratch_path", lambda *_: folder)
    got = J.join(documents(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 3, 90)
    met = [spark.read.parquet(f"{folder}/pairs-{n}").count() for n in (1, 2)]
    assert 1 <= sum(met) < len(rows) / 2


def test_bitmaps_never_differ_in_more_than_the_sets():
    import random

    rng = random.Random(4)
    for _ in range(200):
        both = [rng.getrandbits(64) for _ in range(rng.randint(0, 300))]
        sets = [np.unique(np.array([*both, *(rng.getrandbits(64) for _ in range(rng.randint(0, 60)))], np.uint64)) for _ in "ab"]
        x, y = (J.parities(s) for s in sets)
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= len(np.setxor1d(*sets))


def test_rare_cells_come_before_cells_of_many_sets(spark):
    rows = [(i, f"all share this passage {i} a{i} b{i} c{i} d{i}", None, None, None) for i in range(300)]
    levels = np.frombuffer(J.token_levels(documents(spark, rows), 3), np.uint8)
    shingler = J.Shingler(levels.tobytes(), 3, 90)
    common = shingler.shingles("all share this passage") & np.uint64((1 << J.TABLE_BITS) - 1)
    assert (levels[common] >= int(J.STEPS * np.log2(300))).all()
    first = shingler.prefixes(shingler.shingles(rows[0][1]))
    assert not any(np.isin(p & np.uint64((1 << J.TABLE_BITS) - 1), common).any() for p in first)


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    rows = edge_rows()
    leaders = {(r[0], r[2]) for r in brute(rows, 5, 80)}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, c in leaders if i == c}
    assert J.join(documents(spark, [])).count() == 0


def test_rows_that_stay_as_a_multiset(spark):
    def text(name, n=40):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [
        (1, text("a"), "en", None, None),
        (None, text("a"), "en", None, None),  # copies a document with an id
        (None, text("b"), "en", None, None),  # alone, without an id
        (2, text("c"), "en", None, None),
        (5, text("c"), "en", None, None),  # one id on two texts
        (5, text("d"), "en", None, None),
        (7, text("d"), "en", None, None),
        *[(3, text("e"), "en", None, None)] * 3,  # equal rows
        (4, text("f", 60), "en", None, None),  # near copies with one id
        (4, text("f", 61), "en", None, None),
        (None, text("g"), "en", None, None),
        (None, text("g"), None, "en", None),  # differ in where the null is
        *[(6, "", "en", None, None)] * 2,  # no words
    ]
    got = [tuple(r)[:5] for r in J.keep_one(documents(spark, rows)).collect()]
    sure = [rows[0], rows[2], rows[3], rows[5], rows[7], rows[14], rows[14]]
    assert sorted((r for r in got if r[0] != 4 and r[1] != text("g")), key=str) == sorted(sure, key=str)
    assert len([r for r in got if r[0] == 4]) == len([r for r in got if r[1] == text("g")]) == 1


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (7, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(50))
