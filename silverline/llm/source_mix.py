"""Operator 9: mixing sources to target weights by Sainte-Laguë apportionment.

Tokens are words. The corpus is cut into equal blocks of ``block_words`` words;
the house of ``round(total / block_words)`` blocks is apportioned to the sources
by highest quotients ``target / (2 q + 1)``, and each source's integer quota is
apportioned to its shards in the same way. A shard lays its documents end to end
in a seeded order; it takes every block once for each full pass that its quota
holds, and the rest as a seeded, evenly spaced selection of its whole blocks. All of
it is grouping, windows over bounded groups and closed-form arithmetic; no row
per block is made.

Defined results: a null or empty text has size 0 and takes 0; a null source is a
source of its own, after all others; repeated rows are separate documents; a
source of size 0 has target 0; an empty table gives an empty result. Other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.llm.common import WORD

BLOCK_WORDS = 64
SHARD_WORDS = 1 << 20
MAX_REPEATS = 3
SEED = "mix-1"


def _hash32(*parts: Column) -> Column:
    """The first 7 hex digits of an MD5, as a long: the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 7), 16, 10).cast("bigint")


def source_targets(sized: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: rank, source_size, weight, target.

    Weights 1, 2, 3 repeat over the sources by code point, null last. A target
    stops at ``max_repeats`` times its source's size and the excess is shared
    again by weight. That ends at one level: target = min(cap, level * weight),
    found in one pass over the sources in the order of cap / weight.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy()
    sources = sources.select(
        "source", "source_size", F.row_number().over(by_name).alias("rank")
    ).withColumns(
        {
            "weight": ((F.col("rank") - 1) % 3 + 1).cast("bigint"),
            "cap": F.col("source_size") * max_repeats,
        }
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.withColumns(
        {
            "left_words": F.sum("source_size").over(everything)
            - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "left_weight": F.sum("weight").over(everything)
            - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    ).withColumn("level", F.col("left_words") / F.col("left_weight"))
    level = F.min(
        F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("rank_by_ratio", "level"))
    ).over(everything)
    sources = sources.withColumn("rank_by_ratio", F.row_number().over(by_ratio))
    sources = sources.withColumn("at", level["level"])
    return sources.select(
        "source",
        "rank",
        "source_size",
        F.least(F.col("cap").cast("double"), F.col("at") * F.col("weight")).alias("target"),
    )


def sainte_lague(df: DataFrame, group: list[str], item: str, weight: str, seats: str) -> DataFrame:
    """Integer quotas of each group's ``seats`` by highest quotients weight / (2 q + 1).

    Starts from the rounded shares, which are the apportionment of another house
    size, and then hands out or takes back the seats that differ, by quotient. A share
    of x out of s seats over n items can move by at most x * n / (2 s) + 1 seats,
    so the quotients listed are about 2.5 for each item, whatever the house.
    Returns ``group``, ``item`` and ``quota``; ties go to the smaller item.
    """
    g = Window.partitionBy(*group)
    shares = df.withColumn("_all", F.sum(weight).over(g)).withColumn(
        "_share",
        F.when(F.col("_all") > 0, F.col(weight) * F.col(seats) / F.col("_all")).otherwise(F.lit(0.0)),
    )
    shares = shares.withColumn("_q", F.floor(F.col("_share") + 0.5)).withColumns(
        {
            "_more": F.when(F.col("_all") > 0, F.col(seats) - F.sum("_q").over(g)).otherwise(F.lit(0)),
            "_reach": F.when(
                F.col(seats) > 0,
                F.floor(F.col("_share") * F.count(F.lit(1)).over(g) / (2 * F.col(seats))) + 2,
            ).otherwise(F.lit(1)),
        }
    )
    steps = shares.select(
        *group, item, weight, "_q", "_more", F.explode(F.expr("sequence(1L, _reach)")).alias("_k")
    ).withColumn(
        "_quotient",
        F.when(F.col("_more") > 0, F.col(weight) / (2 * (F.col("_q") + F.col("_k")) - 1))
        .when(
            (F.col("_more") < 0) & (F.col("_q") - F.col("_k") >= 0),
            -F.col(weight) / (2 * (F.col("_q") - F.col("_k")) + 1),
        )
    )
    # Of equal quotients the smaller item's seat comes first, so the larger item's goes first.
    tie = F.when(F.col("_more") < 0, -F.col(item)).otherwise(F.col(item))
    best = Window.partitionBy(*group).orderBy(F.col("_quotient").desc_nulls_last(), tie, "_k")
    moved = F.col("_quotient").isNotNull() & (F.row_number().over(best) <= F.abs(F.col("_more")))
    steps = steps.withColumn("_moved", F.when(moved, F.signum("_more").cast("bigint")).otherwise(F.lit(0)))
    return steps.groupBy(*group, item).agg((F.first("_q") + F.sum("_moved")).alias("quota"))


def mix(
    docs: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """Each document with its size, its source's size and target, and the words taken.

    ``first``, ``passes``, ``extra``, ``whole`` and ``phase`` describe the selection;
    ``keep`` names columns of ``docs`` to return as ``_keep_<name>``.
    """
    keep = keep or []
    sized = docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
    )
    sources = source_targets(sized, max_repeats).withColumn("_one", F.lit(1))
    house = sources.withColumn(
        "_seats", F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("bigint")
    )
    quotas = sainte_lague(house, ["_one"], "rank", "target", "_seats").select("rank", "quota")
    sources = sources.join(quotas, "rank").select(
        "source",
        "rank",
        "source_size",
        "target",
        "quota",
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).alias("shards"),
    )
    s, d = sources.alias("s"), sized.alias("d")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = d.join(s, F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "doc_id", "size", "rank", "source_size", "target", "quota",
        (_hash32(F.lit(f"{seed}:shard:"), key) % F.col("shards")).alias("shard"),
        *[f"_keep_{c}" for c in keep],
    )
    lengths = placed.groupBy("rank", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("quota").alias("quota")
    )
    shard_quota = sainte_lague(lengths, ["rank"], "shard", "shard_size", "quota").withColumnRenamed(
        "quota", "blocks"
    )
    plan = lengths.join(shard_quota, ["rank", "shard"]).select(
        "rank", "shard", "shard_size", "blocks",
        F.floor(F.col("shard_size") / block_words).alias("whole"),
        F.when(
            F.col("shard_size") > 0,
            F.least(F.lit(max_repeats), F.floor(F.col("blocks") * block_words / F.col("shard_size"))),
        ).otherwise(F.lit(0)).cast("bigint").alias("passes"),
    ).withColumn(
        "extra",
        F.when(
            F.col("passes") < max_repeats,
            F.least(
                F.col("whole"),
                F.floor(
                    (F.col("blocks") * block_words - F.col("passes") * F.col("shard_size")) / block_words + 0.5
                ),
            ),
        ).otherwise(F.lit(0)),
    ).withColumn(
        "phase",
        F.when(
            F.col("whole") > 0,
            _hash32(F.lit(f"{seed}:phase:"), F.col("rank").cast("string"), F.lit(":"), F.col("shard").cast("string"))
            % F.col("whole"),
        ).otherwise(F.lit(0)),
    )
    order = Window.partitionBy("rank", "shard").orderBy(
        F.md5(F.concat(F.lit(f"{seed}:order:"), key).cast("binary")), "doc_id", "size"
    )
    laid = placed.withColumn(
        "first",
        F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).join(plan, ["rank", "shard"])
    taken = F.col("passes") * F.col("size") + (
        _selected(F.col("first") + F.col("size"), block_words) - _selected(F.col("first"), block_words)
    )
    return laid.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"),
        "first", "passes", "extra", "whole", "phase", *[f"_keep_{c}" for c in keep],
    )


def _selected_blocks(i: Column) -> Column:
    """How many of the shard's first ``i`` whole blocks are selected."""
    return F.when(
        F.col("whole") > 0,
        F.floor((i * F.col("extra") + F.col("phase")) / F.col("whole"))
        - F.floor(F.col("phase") / F.col("whole")),
    ).otherwise(F.lit(0))


def _selected(x: Column, block_words: int) -> Column:
    """How many of the shard's first ``x`` words lie in selected blocks."""
    block = F.least(F.floor(x / block_words), F.col("whole"))
    rest = F.when(block < F.col("whole"), x - block * block_words).otherwise(F.lit(0))
    return _selected_blocks(block) * block_words + rest * (
        _selected_blocks(block + 1) - _selected_blocks(block)
    )


def materialise(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The mix as rows with the columns of ``docs``.

    A document gets a whole copy for every full pass, and one more row that holds
    its words in selected blocks, with the white space after each, if there are any.
    ``n_chars``, where it exists, is that of the row's text.
    """
    rows = mix(docs, block_words, shard_words, keep=list(dict.fromkeys(docs.columns)))
    part = F.col("taken") - F.col("passes") * F.col("size")
    # Each word with the white space around it that no other word has.
    text = F.col("_keep_text")
    words = F.regexp_extract_all(text, F.lit(rf"(?:^[\x20\x09-\x0D]*)?{WORD}[\x20\x09-\x0D]*"), F.lit(0))
    def is_chosen(i: Column) -> Column:
        block = F.floor((F.col("first") + i) / block_words)
        return (block < F.col("whole")) & (_selected_blocks(block + 1) > _selected_blocks(block))

    chosen = F.filter(words, lambda w, i: is_chosen(i))
    partial = F.when((part > 0) & (part < F.col("size")), F.array_join(chosen, ""))
    texts = F.concat(
        F.array_repeat(text, F.col("passes").cast("int")),
        F.when(part == F.col("size"), F.array(text)).when(partial.isNotNull(), F.array(partial)).otherwise(
            F.expr("cast(array() as array<string>)")
        ),
    )
    rows = rows.where("taken > 0").select(
        *[F.col(f"_keep_{c}").alias(c) for c in docs.columns if c != "text"], F.explode(texts).alias("text")
    )
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def op9_source_mix(spark, sf_dir: str) -> DataFrame:
    from silverline.llm.common import read

    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
