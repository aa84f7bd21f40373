"""Filter interaction audit over failing-id relations.

Every filter has a table of its own that holds nothing but the ids of the rows it
fails. What any order of the filters does follows from joins of those tables:
for a set of filters already applied (a prefix; order within it does not matter,
so 120 orders of five filters have 32 prefixes),

* the survivors of ``prefix + f`` are the survivors of ``prefix`` left-anti the ids of ``f``;
* what ``f`` removes is the survivors of ``prefix`` left-semi the ids of ``f``;
* what is redundant is the rows gone before, left-semi the ids of ``f``;
* label losses are counted on the removed rows.

Only rows that fail some filter are joined: the others survive every prefix and
are a number per part. The 32 relations are built level by level (prefixes of
one length together), each level written to the shared folder, so nothing is
recomputed and a lost executor costs one level's tasks. Joins are on a row id
that is unique per row, so no join key repeats. The two joins on values of the data
(text digest for copies, ``doc_id`` for labels) go through ``lookup``: keys on more than
a thousandth of the rows, of which there are under a thousand, are broadcast, and the
others are shuffled.

Edges: null text is the empty text (0 words: fails A only); null ``source`` is the part
``''``; a null ``doc_id`` has no label, and neither is a copy nor has copies (it has no
order); repeated rows of one ``doc_id`` are rows of their own and not copies of each
other (no smaller id); of several label rows of one id, any with the mark counts; an empty
table gives no rows. Further columns of the input are not read.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm.common import folder_exists, read, remove_folder, text_or_empty, union_all
from silverline.session import scratch_path

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 2
MARKUP = "[#$%&*|]"
BLANKS = r"[\x20\x09-\x0D]+"
# A key on more than this share of the rows is joined by broadcast: fewer than 1 / share such keys exist.
HOT_SHARE = 1 / 1000


def conditions(text: Column) -> dict[str, Column]:
    """What fails a document by itself, by filter; E needs the table."""
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    n_words = F.size(words)
    upper = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n_words < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * n_words,
        "C": 100 * upper > MAX_UPPER_PERCENT * F.length(text),
        "D": text.rlike(MARKUP),
    }


def lookup(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (one row per ``key``, with its ``rows_of_key``
    in ``rows``) that no frequent key sends to one task."""
    hot = table.filter(F.col("rows_of_key") > F.lit(total * HOT_SHARE)).drop("rows_of_key")
    rest = table.filter(F.col("rows_of_key") <= F.lit(total * HOT_SHARE)).drop("rows_of_key")
    few = F.broadcast(hot)  # below 1 / HOT_SHARE rows
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(few, key).unionByName(cold.join(rest, key))


def copies(facts: DataFrame, total: int) -> DataFrame:
    """Ids of rows whose text a row with a smaller ``doc_id`` has (filter E)."""
    known = facts.filter(F.col("doc_id").isNotNull()).select("rid", "doc_id", "digest")
    first = (
        known.groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("rows_of_key"))
        .filter("first_id < last_id")
        .drop("last_id")
    )
    return lookup(known, first, "digest", total).filter("doc_id > first_id").select("rid")


def marked(facts: DataFrame, labels: DataFrame, total: int) -> DataFrame:
    """(rid, good, toxic) of the rows with a label that marks them."""
    known = facts.filter(F.col("doc_id").isNotNull()).select("rid", "doc_id")
    marks = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(
            F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
        .filter("good OR toxic")
    )
    rows_of = known.groupBy("doc_id").agg(F.count("*").alias("rows_of_key"))
    return lookup(known, marks.join(rows_of, "doc_id"), "doc_id", total).select("rid", "good", "toxic")


def audit(docs: DataFrame, labels: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step; see the module's docstring.

    Columns: part, filter_order, step, filter, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "filter-audit")

    def staged(df: DataFrame, name: str, *by: str) -> DataFrame:
        df.write.partitionBy(*by).parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    text = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text_or_empty().alias("text"))
    alone = conditions(F.col("text"))
    facts = staged(
        text.select(
            F.monotonically_increasing_id().alias("rid"),  # read from the written table from here on
            "doc_id",
            "part",
            F.sha2("text", 256).alias("digest"),
            F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in alone.items() if k in filters])).alias("failed"),
        ),
        "facts",
    )
    total = facts.count()
    ids = facts.select("rid", F.explode("failed").alias("filter"))
    if "E" in filters:
        ids = ids.unionByName(copies(facts, total).withColumn("filter", F.lit("E")))
    staged(ids, "fails", "filter")
    fails = {f: _ids(spark, f"{folder}/fails/filter={f}") for f in filters}

    failing = spark.read.schema("rid long, filter string").parquet(f"{folder}/fails").select("rid")
    level = staged(
        facts.select("rid", "doc_id", "part")
        .join(failing, "rid", "left_semi")
        .join(marked(facts, labels, total), "rid", "left")
        .select(
            "rid",
            "part",
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
            F.lit(True).alias("alive"),
            F.lit("").alias("prefix"),
        ),
        "level-0",
    )
    levels, all_hits = [level], []
    for k in range(len(filters)):
        # Rows of every prefix that fail f: removed if alive, redundant if gone before.
        hits = staged(
            union_all([
                level.filter(~F.contains("prefix", F.lit(f))).join(fails[f], "rid", "left_semi").withColumn("filter", F.lit(f))
                for f in filters
            ]),
            f"hits-{k}",
        )
        all_hits.append(hits)
        if k + 1 == len(filters):
            break
        following = []
        for f in filters:
            # Each longer prefix once, its filters in the order given.
            grows = F.col("prefix").isin([p for p in _prefixes(filters, k) if p + f in _prefixes(filters, k + 1)])
            following += [
                level.filter(grows & F.col("alive")).join(fails[f], "rid", "left_anti"),
                hits.filter(grows & F.col("alive") & (F.col("filter") == f)).drop("filter").withColumn("alive", F.lit(False)),
                level.filter(grows & ~F.col("alive")),
            ]
            following[-3:] = [df.withColumn("prefix", F.concat("prefix", F.lit(f))) for df in following[-3:]]
        level = staged(union_all(following), f"level-{k + 1}")
        levels.append(level)
    out = _report(facts, union_all(all_hits), union_all(levels), filters)
    path = scratch_path(spark, "filter-audit-report")
    out.write.parquet(path)
    remove_folder(spark, folder)
    return spark.read.parquet(path)


def _report(facts: DataFrame, hits: DataFrame, levels: DataFrame, filters: str) -> DataFrame:
    """Counts per (part, prefix, filter), zeros included, on every order and step."""
    spark = facts.sparkSession
    lost = F.col("alive")
    steps = hits.groupBy("part", "prefix", "filter").agg(
        F.count_if(lost).alias("removed"),
        F.count_if(~lost).alias("redundant"),
        F.count_if(lost & F.col("good")).alias("good_lost"),
        F.count_if(lost & F.col("toxic")).alias("toxic_lost"),
    )
    before = levels.groupBy("part", "prefix").agg(F.count_if(~F.col("alive")).alias("gone_before"))
    n = len(filters)
    cases = [(p, f) for k in range(n) for p in _prefixes(filters, k) for f in filters if f not in p]
    case = F.explode(F.array(*[F.struct(F.lit(p).alias("prefix"), F.lit(f).alias("filter")) for p, f in cases]))
    counts = ("removed", "redundant", "good_lost", "toxic_lost")
    orders_with_prefix = F.element_at(F.lit([factorial(k) * factorial(n - 1 - k) for k in range(n)]), F.length("prefix") + 1)
    totals = facts.groupBy("part").agg(F.count("*").alias("total"))
    full = (
        totals.select("part", "total", case.alias("case"))
        .select("part", "total", "case.*")
        .join(steps, ["part", "prefix", "filter"], "left")
        .join(before, ["part", "prefix"], "left")
        .fillna(0, [*counts, "gone_before"])
    )
    sums = full.groupBy("part", "filter").agg(
        F.sum(F.when(F.length("prefix") == n - 1, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * orders_with_prefix).alias("shapley"),
    )
    places = [
        ("".join(o), step + 1, o[step], "".join(sorted(o[:step], key=filters.index)))
        for o in permutations(filters)
        for step in range(n)
    ]
    orders = spark.createDataFrame(places, "filter_order string, step int, filter string, prefix string")
    return (
        full.join(sums, ["part", "filter"])
        .join(F.broadcast(orders), ["filter", "prefix"])  # n! * n rows, whatever the data
        .select(
            "part",
            "filter_order",
            "step",
            "filter",
            (F.col("total") - F.col("gone_before") - F.col("removed")).alias("kept"),
            "removed",
            "redundant",
            "unique_fails",
            "good_lost",
            "toxic_lost",
            "shapley",
        )
    )


def _prefixes(filters: str, k: int) -> list[str]:
    return ["".join(c) for c in combinations(filters, k)]


def _ids(spark: SparkSession, path: str) -> DataFrame:
    if folder_exists(spark, path):
        return spark.read.schema("rid long").parquet(path)
    return spark.createDataFrame([], "rid long")  # a filter that fails nothing



def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 120 orders of five filters over every document, per source."""
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("filter")
