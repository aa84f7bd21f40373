"""Operator 3: personal data by candidate gradient boosting. Built-in functions only.

1. High-recall generators, one regular expression per kind, propose spans; they
   are wider than the base rules (other separators, spelled-out marks, longer
   numbers) and may overlap between kinds. The base rules' spans are found too.
2. Each candidate gets small discrete features of its format (number of digits,
   validity once separators and marks are read as the plain ones, separators, marks, length)
   and of its context (the characters next to it, a cue word before it).
3. No labels are given, so they come from the base spans: each is written in its place in
   forms that only the generators know (DISGUISES), which are positives, and in a
   broken one (CORRUPTED), a negative. Candidates of the corpus that are not valid are
   negatives too; valid ones beside base spans are what is to be judged and have no label. One of ten
   numbers passes the card checksum by chance, so a ninth of the corpus's failing card candidates
   counts as valid ones that are no cards, with their own format and context. Labelled spans are counted by
   kind, feature vector and label; the features' values are few, so this table of counts over *all*
   of them is bounded (``FEATURE_BOUND``), whatever the input, and is all that the driver sees.
   Boosted regression trees (logistic loss) are fitted to the counts of one half of the texts, split by
   the text's hash, and the least score at which the other half is right ``PRECISION`` of the time
   becomes the kind's threshold; a kind without such a score, or with fewer than ``LEAST_SUPPORT``
   labelled spans above it, adds nothing.
4. The trees become CASE expressions. Candidates at or above their kind's
   threshold that do not overlap a base span of their kind are added; base spans
   always stay.

Base rules: leftmost non-overlapping matches per kind, failing ones dropped
without retry. Positions are code points, ends exclusive. The patterns use
possessive quantifiers and look-behinds that change no match; they keep long
runs linear.

Defined results: a null or empty text has no spans; repeated rows are judged
alike; an empty table gives an empty result and no model. Only ``text`` is read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import let, read, text_or_empty

KINDS = ("email", "ip", "card", "phone")
LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    # A local part starts at the start of its run, or where the last match ended.
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": (
        rf"(?:(?<!{LOCAL})|\G){LOCAL}++(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)[A-Za-z0-9-]++"
        r"(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]++)++"
    ),
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\.|\x20?[\[(]\.[\])]\x20?)[0-9]{1,3}+){3}(?![0-9.])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}+([\x20._/-]{0,3}+)[0-9]{4,6}+(?:\1[0-9]{2,6}+){1,3}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+|00)\x20?[0-9][\x20()./0-9-]{5,24}[0-9](?![0-9A-Za-z])",
}
# A text without this cannot hold the kind.
NEEDS = {"email": r"@|[\[(][aA][tT][\])]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
CUES = r"(?i)(e-?mail|mail|contact|write|tel|phone|call|fax|mobile|card|visa|iban|account|ip|host|address)\W{0,3}$"
FEATURES = ("length", "digits", "valid", "separators", "marks", "before", "after", "cue")
FEATURE_BOUND = len(KINDS) * 8 * 8 * 2 * 4 * 4 * 4 * 4 * 2 * 2 * 3
NATURAL, POSITIVE, BROKEN = 0, 1, 2
# Valid numbers by chance for each one that fails the checksum.
CHANCE = {"card": 1 / 9}
TREES, LEARNING_RATE, PRECISION, LEAST_SUPPORT = 20, 0.3, 0.95, 20


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(
        F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)),
        lambda d, i: let(
            d.cast("int") * (1 + i % 2), lambda v: F.when(v > 9, v - 9).otherwise(v)
        ),
    )
    return F.aggregate(each, F.lit(0), lambda a, v: a + v) % 10 == 0


def _card_digits_pass(c: Column) -> Column:
    d = _digits(c)
    return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False))


_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": _card_digits_pass,
    "phone": lambda m: F.length(_digits(m)).between(8, 15),
}


def spans(text: Column, pattern: str, valid: Callable[[Column], Column], needs: str) -> Column:
    """Array of (s, e, m) of the valid matches of ``pattern``, in order.

    The pieces between the matches and the matches themselves alternate, so
    their lengths add up to the positions.
    """
    empty = F.expr("cast(array() as array<struct<s:int,e:int,m:string>>)")
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(acc: Column, x: Column) -> Column:
        start = acc["p"] + F.length(x["0"])
        end = start + F.length(x["1"])
        span = F.struct(start.alias("s"), end.alias("e"), x["1"].alias("m"))
        return F.struct(
            end.alias("p"),
            F.when(valid(x["1"]), F.array_append(acc["k"], span)).otherwise(acc["k"]).alias("k"),
        )

    pairs = let(
        matches, lambda m: F.arrays_zip(F.slice(pieces, 1, F.size(m)), F.slice(m, 1, F.size(m)))
    )
    found = F.aggregate(pairs, F.struct(F.lit(0).alias("p"), empty.alias("k")), step)["k"]
    return F.when(text.rlike(needs), found).otherwise(empty)


def base_spans(text: Column, kind: str) -> Column:
    return spans(text, BASE[kind], VALID[kind], NEEDS[kind])


# The kind's own test of a candidate whose separators and marks are read as the plain ones.
PLAUSIBLE: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: m.rlike("[A-Za-z]{2,}$"),
    "ip": lambda m: VALID["ip"](F.regexp_replace(m, "[^0-9.]", "")),
    "card": lambda m: F.when(F.length(_digits(m)).between(13, 19), luhn(_digits(m))).otherwise(F.lit(False)),
    "phone": lambda m: F.length(_digits(F.regexp_replace(m, "^00", ""))).between(8, 15),
}


def _groups(m: Column, separator: str) -> Column:
    return F.regexp_replace(_digits(m), "([0-9]{4})(?=[0-9])", f"$1{separator}")


def _spelled(m: Column, at: str, dot: str) -> Column:
    name, host = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    return F.concat(name, F.lit(at), F.replace(host, F.lit("."), F.lit(dot)))


# A base span as it might be written elsewhere, and broken so that it is none.
DISGUISES: dict[str, list[Callable[[Column], Column]]] = {
    "email": [lambda m: _spelled(m, " [at] ", " [dot] "), lambda m: _spelled(m, "(at)", ".")],
    "ip": [lambda m: F.replace(m, F.lit("."), F.lit("[.]")), lambda m: F.replace(m, F.lit("."), F.lit(" (.) "))],
    "card": [lambda m: _groups(m, "."), lambda m: _groups(m, " / ")],
    "phone": [lambda m: F.replace(m, F.lit("+"), F.lit("00")), lambda m: F.translate(m, "+ ", "+/")],
}
CORRUPTED: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: _spelled(F.regexp_replace(m, "[^.]+$", "0"), " [at] ", " [dot] "),
    "ip": lambda m: F.replace(F.regexp_replace(m, "[0-9]+$", "999"), F.lit("."), F.lit("[.]")),
    # Another last digit never passes the checksum.
    "card": lambda m: F.concat(
        F.regexp_replace(_groups(m, "."), "[0-9]$", ""), F.translate(F.right(m, F.lit(1)), "0123456789", "1234567890")
    ),
    "phone": lambda m: F.concat(F.replace(m, F.lit("+"), F.lit("00")), F.lit("00000000")),
}


def _bins(c: Column, edges: list[int]) -> Column:
    out = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        out = F.when(c < edges[i], F.lit(i)).otherwise(out)
    return out


def _side(c: Column) -> Column:
    """Class of a neighbouring character: none, space, letter or digit, other."""
    return (
        F.when(F.length(c) == 0, F.lit(0))
        .when(c.rlike(r"^\s"), F.lit(1))
        .when(c.rlike(r"^[\p{L}\p{N}]"), F.lit(2))
        .otherwise(F.lit(3))
    )


def features(text: Column, span: Column, kind: str) -> Column:
    """Struct of the discrete features of one candidate of ``kind`` in its text."""
    m = span["m"]
    d = _digits(m)
    left = F.substr(text, F.greatest(span["s"] - 19, F.lit(1)), F.least(span["s"], F.lit(20)))
    return F.struct(
        _bins(F.length(m), [8, 11, 14, 17, 20, 24, 32]).alias("length"),
        _bins(F.length(d), [1, 4, 8, 10, 12, 16, 20]).alias("digits"),
        PLAUSIBLE[kind](m).cast("int").alias("valid"),
        _bins(F.size(F.split(m, r"[\x20._/-]", -1)) - 1, [1, 3, 5]).alias("separators"),
        _bins(F.length(F.regexp_replace(m, r"[^@+()\[\]]", "")), [1, 2, 3]).alias("marks"),
        _side(F.when(span["s"] == 0, F.lit("")).otherwise(F.substr(text, span["s"], F.lit(1)))).alias("before"),
        _side(F.substr(text, span["e"] + 1, F.lit(1))).alias("after"),
        left.rlike(CUES).cast("int").alias("cue"),
    )


def found(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the text and per kind the base spans and candidates with features.

    A candidate is (s, e, m, f, hit): hit tells that it overlaps a base span of its kind.
    """
    rows = docs.select(*[F.col(c).alias(f"_{c}") for c in keep], text_or_empty().alias("t"))
    rows = rows.select("*", *[base_spans(F.col("t"), k).alias(f"b_{k}") for k in KINDS],
                       *[spans(F.col("t"), GENERATORS[k], lambda m: F.lit(True), NEEDS[k]).alias(f"g_{k}")
                         for k in KINDS])

    def described(kind: str) -> Column:
        def one(x: Column, text: Column, base: Column) -> Column:
            hit = F.exists(base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
            return F.struct(
                x["s"].alias("s"), x["e"].alias("e"), features(text, x, kind).alias("f"), hit.alias("hit")
            )

        return F.transform(f"g_{kind}", lambda x: one(x, F.col("t"), F.col(f"b_{kind}")))

    return rows.select("*", *[described(k).alias(f"c_{k}") for k in KINDS]).drop(*[f"g_{k}" for k in KINDS])


class Model:
    """Boosted trees over the discrete features, and a threshold for each kind."""

    def __init__(self, bias: float, trees: list, thresholds: dict[str, float]):
        self.bias, self.trees, self.thresholds = bias, trees, thresholds

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for tree in self.trees:
            out += _apply(tree, x)
        return out

    def score(self, kind: int, f: Column) -> Column:
        """The candidate's calibrated score as a column."""
        margin = F.lit(self.bias)
        for tree in self.trees:
            margin = margin + _as_case(tree, kind, f)
        return 1.0 / (1.0 + F.exp(-margin))


def _apply(node, x: np.ndarray) -> np.ndarray:
    if not isinstance(node, tuple):
        return np.full(len(x), node)
    j, cut, low, high = node
    return np.where(x[:, j] < cut, _apply(low, x), _apply(high, x))


def _as_case(node, kind: int, f: Column) -> Column:
    if not isinstance(node, tuple):
        return F.lit(float(node))
    j, cut, low, high = node
    if j == 0:  # the kind is known where the expression is built
        return _as_case(low if kind < cut else high, kind, f)
    return F.when(f[FEATURES[j - 1]] < cut, _as_case(low, kind, f)).otherwise(_as_case(high, kind, f))


def _tree(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int):
    """A regression tree by gain over the binned features, with unit ridge."""
    g, h = grad.sum(), hess.sum()
    best, split = 1e-9, None
    for j in range(x.shape[1]) if depth else ():
        for cut in range(1, int(x[:, j].max()) + 1):
            low = x[:, j] < cut
            if low.all() or not low.any():
                continue
            gl, hl = grad[low].sum(), hess[low].sum()
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            if gain > best:
                best, split = gain, (j, cut, low)
    if split is None:
        return LEARNING_RATE * g / (h + 1)
    j, cut, low = split
    return (j, cut, _tree(x[low], grad[low], hess[low], depth - 1),
            _tree(x[~low], grad[~low], hess[~low], depth - 1))


def fit(counts: list[tuple], depth: int = 3) -> Model | None:
    """Trees and thresholds from rows (kind, features..., half, positives, all)."""
    if not counts:
        return None
    table = np.array(sorted(counts), dtype=float)
    x, half, pos, n = table[:, : 1 + len(FEATURES)], table[:, -3], table[:, -2], table[:, -1]
    # Candidates are fitted on half 0; if it is empty, on all.
    fit_on = half == 0 if (half == 0).any() else half >= 0
    xf, pf, nf = x[fit_on], pos[fit_on], n[fit_on]
    rate = (pf.sum() + 1) / (nf.sum() + 2)
    model = Model(math.log(rate / (1 - rate)), [], {})
    margin = np.full(len(xf), model.bias)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        tree = _tree(xf, pf - nf * p, nf * p * (1 - p), depth)
        model.trees.append(tree)
        margin += _apply(tree, xf)
    held = ~fit_on if (~fit_on).any() else fit_on
    score = 1 / (1 + np.exp(-model.margin(x[held])))
    for k, kind in enumerate(KINDS):
        mine = x[held][:, 0] == k
        order = np.argsort(-score[mine], kind="stable")
        s, good, all_ = score[mine][order], pos[held][mine][order].cumsum(), n[held][mine][order].cumsum()
        ok = (good >= PRECISION * all_) & (all_ >= LEAST_SUPPORT)
        # Only ends of runs of equal scores are real cuts.
        ok &= np.append(s[1:] < s[:-1], True) if len(s) else ok
        if ok.any():
            model.thresholds[kind] = float(max(0.5, s[np.flatnonzero(ok)[-1]]))
    return model


def train(rows: DataFrame) -> Model | None:
    """Fit on the counts of all labelled spans of ``rows`` from :func:`found`."""
    labelled = F.flatten(F.array(*[_natural(k, n) for n, k in enumerate(KINDS)], *[_written(k, n) for n, k in enumerate(KINDS)]))
    half = F.pmod(F.xxhash64("t"), F.lit(2))
    counts = (
        rows.select(half.alias("half"), F.explode(labelled).alias("c"))
        .groupBy(F.col("c")["k"].alias("k"), F.col("c")["f"].alias("f"), F.col("c")["label"].alias("label"), "half")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # at most FEATURE_BOUND rows
    )
    return fit(list(_weighted(counts)))


def _weighted(counts: list) -> Iterator[tuple]:
    """Rows for :func:`fit`; failing candidates also stand for those that pass by chance."""
    for r in counts:
        f = [r["f"][name] for name in FEATURES]
        yield (r["k"], *f, r["half"], r["n"] if r["label"] == POSITIVE else 0, r["n"])
        chance = CHANCE.get(KINDS[r["k"]], 0.0)
        if r["label"] == NATURAL and chance:
            f[FEATURES.index("valid")] = 1
            yield (r["k"], *f, r["half"], 0, r["n"] * chance)


def _labelled(number: int, f: Column, label: Column) -> Column:
    return F.struct(F.lit(number).alias("k"), f.alias("f"), label.alias("label"))


def _natural(kind: str, number: int) -> Column:
    """Candidates of the corpus that are none: not valid, and beside every base span."""
    none = F.filter(f"c_{kind}", lambda c: ~c["hit"] & (c["f"]["valid"] == 0))
    return F.transform(none, lambda c: _labelled(number, c["f"], F.lit(NATURAL)))


def _written(kind: str, number: int) -> Column:
    """Base spans in other forms and in a broken one, in the place where they stand."""

    def forms(b: Column) -> Column:
        made = [(how(b["m"]), POSITIVE) for how in DISGUISES[kind]] + [(CORRUPTED[kind](b["m"]), BROKEN)]
        return F.array(
            *[F.struct(b["s"].alias("s"), b["e"].alias("e"), m.alias("m"), F.lit(y).alias("y")) for m, y in made]
        )

    every = F.flatten(F.transform(f"b_{kind}", forms))
    return F.transform(every, lambda x: _labelled(number, features(F.col("t"), x, kind), x["y"]))


def selected(rows: DataFrame, model: Model | None) -> DataFrame:
    """``rows`` with ``added``: array of (k, s, e) that the model adds."""
    parts = []
    for number, kind in enumerate(KINDS):
        if model is None or kind not in model.thresholds:
            continue
        parts.append(_chosen(kind, number, model, model.thresholds[kind]))
    none = F.expr("cast(array() as array<struct<k:int,s:int,e:int>>)")
    return rows.withColumn("added", F.concat(none, *parts))


def _chosen(kind: str, number: int, model: Model, limit: float) -> Column:
    good = F.filter(f"c_{kind}", lambda c: ~c["hit"] & (model.score(number, c["f"]) >= limit))
    return F.transform(good, lambda c: F.struct(F.lit(number).alias("k"), c["s"].alias("s"), c["e"].alias("e")))


def _base_list() -> Column:
    """All base spans as (k, s, e), by kind and start."""

    def tagged(kind: str, number: int) -> Column:
        return F.transform(
            f"b_{kind}", lambda b: F.struct(F.lit(number).alias("k"), b["s"].alias("s"), b["e"].alias("e"))
        )

    return F.flatten(F.array(*[tagged(k, n) for n, k in enumerate(KINDS)]))


def _as_text(spans_: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans_,
            lambda x: F.concat(F.get(names, x["k"]), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string")),
        ),
        ",",
    )


def detect(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``_<keep>``, ``t``, ``base`` and ``all``: arrays of (k, s, e) per document."""
    rows = found(docs, keep)
    rows = selected(rows, train(rows))
    return rows.select(
        *[f"_{c}" for c in keep],
        "t",
        _base_list().alias("base"),
        F.array_sort(F.concat(_base_list(), F.col("added"))).alias("all"),
    )


def op3_pii_spans(spark, sf_dir: str) -> DataFrame:
    rows = detect(read(spark, sf_dir, "documents"), ["doc_id"])

    def number(k: int) -> Column:
        return F.size(F.filter("base", lambda x: x["k"] == k)).cast("bigint")

    return rows.select(
        F.col("_doc_id").alias("doc_id"),
        *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_as_text(F.col("base")), 256).alias("base_sha256"),
        _as_text(F.col("all")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; other columns stay.

    Overlapping spans are merged and named after the first. ``n_chars`` becomes the new length
    where the column exists.
    """
    keep = [c for c in docs.columns if c != "text"]
    rows = detect(docs, keep)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(
        F.transform("all", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k")))
    )

    def step(acc: Column, x: Column, text: Column) -> Column:
        fresh = x["s"] >= acc["p"]
        return F.struct(
            F.greatest(acc["p"], x["e"]).alias("p"),
            F.when(
                fresh,
                F.concat(acc["o"], F.array(F.substr(text, acc["p"] + 1, x["s"] - acc["p"]), F.get(names, x["k"]))),
            ).otherwise(acc["o"]).alias("o"),
        )

    start = F.struct(F.lit(0).alias("p"), F.expr("cast(array() as array<string>)").alias("o"))
    done = F.aggregate(
        ordered,
        start,
        lambda acc, x: step(acc, x, F.col("t")),
        lambda acc: F.concat(F.array_join(acc["o"], ""), F.substr(F.col("t"), acc["p"] + 1)),
    )
    text = F.when(F.size("all") > 0, done).otherwise(F.col("t"))
    out = rows.select(*[F.col(f"_{c}").alias(c) for c in keep], text.alias("text"))
    if "n_chars" in keep:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
