import hashlib
import re

from silverline.llm import pii as P
from tests.llm.fixtures import documents, edge_rows

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum((v := int(c) * (1 + i % 2)) - 9 * (v > 9) for i, c in enumerate(reversed(d))) % 10 == 0


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(x) <= 255 for x in m.split(".")),
        "card": lambda: 16 <= len(d) <= 19 and luhn(d),
        "phone": lambda: 8 <= len(d) <= 15,
    }[kind]()


def brute(t):
    return [
        (k, m.start(), m.end()) for k, q in BASE.items() for m in re.finditer(q, t or "") if passes(k, m.group())
    ]


HARD = [
    "a@b.c_d@e.f x@y x@@y.z a.b@c.d.e. @x.y a@b..c %@a.b-.c",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.004 999999999999.1.1.1 1.2.3 0.0.0.0.",
    "+1 (555) 123-4567) +123 é+12345678é 😀 +1+2345678 +1 2 3 4 5 6 7 8 9 0 ( ( +12(3)4.5-6 78",
    "4111 1111 1111 1111 4111-1111-1111-1111 x4111111111111111 4111  1111 4111111111111111-1",
    "1." * 3000 + "a" * 30000 + "@b" + ".c" * 3000,
    "9" * 50000,
]


def test_base_spans_equal_brute_force(spark, monkeypatch):
    rows = edge_rows() + [(100 + i, t, None, None, None) for i, t in enumerate(HARD)]
    docs = documents(spark, rows)
    monkeypatch.setattr(P, "read", lambda *a: docs)
    got = P.op3_pii_spans(spark, "").collect()
    assert len(got) == len(rows)
    want = {}
    for doc_id, t, *_ in rows:
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(t))
        want.setdefault(doc_id, set()).add(joined)
    for r in got:
        digests = {hashlib.sha256(j.encode()).hexdigest(): j for j in want[r["doc_id"]]}
        base = digests[r["base_sha256"]]
        spans = [x for x in base.split(",") if x]
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(x.startswith(k) for x in spans) for k in P.KINDS]
        assert set(spans) <= set(r["spans"].split(","))


PLANTED = {
    # Forms that no base rule takes; what the model must add.
    200: ("card 4111.1111.1111.1111 end", {("card", "4111.1111.1111.1111")}),
    201: ("mail jo.doe [at] host7 [dot] example [dot] com or", {("email", "jo.doe [at] host7 [dot] example [dot] com")}),
    202: ("host 10[.]2[.]3[.]44 now", {("ip", "10[.]2[.]3[.]44")}),
    203: ("or 001 (555) 010-7712 end", {("phone", "001 (555) 010-7712")}),
    204: ("card 5500.0000.0000.0004 or host 10[.]9[.]8[.]7 end", {("card", "5500.0000.0000.0004"), ("ip", "10[.]9[.]8[.]7")}),
    # The same formats, but not valid: a checksum, a part over 255, too many digits, no top-level name.
    210: ("card 4111.1111.1111.1112 end", set()),
    211: ("host 10[.]2[.]3[.]444 now", set()),
    212: ("or 001 (555) 010-7712 0000 000 end", set()),
    213: ("mail jo.doe [at] host7 [dot] 0 or", set()),
    214: ("nothing of the kind 12 and (at) home", set()),
}


def test_model_adds_what_base_rules_miss_and_nothing_else(spark):
    text = "mail jo.doe@host7.example.com or card 4111 1111 1111 1111 or +1 (555) 010-77{0:02d} host 10.2.3.{0} end"
    rows = [(i, text.format(i), None, None, None) for i in range(60)]
    rows += [(100 + i, f"order 1234 5678 9012 34{i:02d} of {i}.{i}.{i}", None, None, None) for i in range(60)]
    rows += [(i, t, None, None, None) for i, (t, _) in PLANTED.items()]
    docs = documents(spark, rows)
    out = P.detect(docs, ["doc_id"]).collect()
    for r in out:
        base, all_ = [tuple(x) for x in r["base"]], [tuple(x) for x in r["all"]]
        assert set(base) <= set(all_)
        added = {(P.KINDS[k], r["t"][s:e]) for k, s, e in set(all_) - set(base)}
        assert added == PLANTED.get(r["_doc_id"], ("", set()))[1], r["t"]
    again = P.detect(docs.repartition(7), ["doc_id"]).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_disguises_are_candidates_and_corruptions_are_not_valid(spark):
    """Every form the trees learn from is one that the kind's generator proposes, whole."""
    from pyspark.sql import functions as F

    plain = {
        "email": ["a.b@c.de", "jo+x@host-1.example.com"],
        "ip": ["10.2.3.4", "255.0.0.255"],
        "card": ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111"],
        "phone": ["+1 (555) 010-7712", "+49 30 1234567"],
    }
    for kind, texts in plain.items():
        df = spark.createDataFrame([(t,) for t in texts], "m string")
        forms = [how(F.col("m")) for how in P.DISGUISES[kind]]
        for r in df.select(
            F.array(*[P.PLAUSIBLE[kind](f) for f in forms]).alias("ok"),
            F.array(*[F.regexp_extract(f, P.GENERATORS[kind], 0) == f for f in forms]).alias("whole"),
            P.PLAUSIBLE[kind](P.CORRUPTED[kind](F.col("m"))).alias("broken_ok"),
            "m",
        ).collect():
            assert all(r["ok"]) and all(r["whole"]) and not r["broken_ok"], (kind, r)


def test_trees_as_columns_equal_numpy(spark):
    counts = [(k, a, b, 0, 0, 0, 1, 1, c, h, 5 * (a == b), 5 + c) for k in range(4) for a in range(4)
              for b in range(4) for c in range(2) for h in range(2)]
    model = P.fit(counts)
    import numpy as np
    from pyspark.sql import functions as F

    x = np.array([c[:9] for c in counts], dtype=float)
    want = 1 / (1 + np.exp(-model.margin(x)))
    df = spark.createDataFrame([(i, *map(int, c[:9])) for i, c in enumerate(counts)], ["i", "k", *P.FEATURES])
    for k in range(4):
        rows = df.where(f"k = {k}").select("i", model.score(k, F.struct(*P.FEATURES)).alias("s")).collect()
        assert all(abs(r["s"] - want[r["i"]]) < 1e-12 for r in rows)


def test_redaction(spark):
    docs = documents(spark)
    out = P.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    (text,) = [r["text"] for r in out.collect() if r["text"].startswith("mail")]
    assert text == "mail [EMAIL] or [PHONE], host [IP], card [CARD]."
    assert P.redact(documents(spark, [])).count() == 0
