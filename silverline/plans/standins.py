"""Stand-ins: the driver's test tables shaped as the pipeline's inputs.

The test tables hold no NULLs or blanks, so dirt comes from the data itself
(small values become blank ids, large ones lose their timestamp). Every
stand-in reads its whole table; nothing is sampled or capped. Each stand-in has
a twin in :mod:`silverline.plans.oracle` written in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.contracts import (
    API_ITEM_SCHEMA,
    CATEGORY_PAYLOAD_SCHEMA,
    MAX_RESULTS_LIMITS,
    PROJECTED_VIDEO_COLUMNS,
    VIDEO_TYPES,
)
from silverline.functions.columns import json_text_field, safe_int, safe_long
from silverline.session import OPEN_FILES, settings
from silverline.sinks.folders import COMMIT_IN_TASKS, rename_all
from silverline.sinks.silver import spread
from silverline.sources.bronze import RECORD_SEPARATOR

SOURCE_FILE = "_source_file"


def _null(name: str):
    return F.lit(None).cast(VIDEO_TYPES[name]).alias(name)


def events_as_videos(events: DataFrame) -> DataFrame:
    """``events`` as raw video observations in the 25-column contract.

    user_id is the video, event_type the region (padded, so cleansing has work),
    the event day the trending date. Values below 1 get a blank video id and
    values from 300 up lose their timestamp: about 2 % invalid rows, under the
    5 % gate. ``_source_file`` orders copies like hourly Bronze files do.
    """
    value = F.col("value")
    columns = {
        "source": F.when(F.col("event_type") == "purchase", F.lit(" YouTube_API "))
        .otherwise(F.lit("kaggle")),
        "region": F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")),
        "video_id": F.when(value < 1, F.lit("  ")).otherwise(F.col("user_id").cast("string")),
        "trending_date": F.to_date(F.col("ts")),
        "published_at": F.when(value >= 300, F.lit(None)).otherwise(F.col("ts")),
        "channel_id": None,
        "channel_title": F.concat(
            F.lit("channel-"), F.floor(F.col("user_id") / 10).cast("string")
        ),
        "title": F.when(value < 2, F.lit("")).otherwise(
            F.concat(F.lit("  title "), F.col("event_type"), F.lit(" "))
        ),
        "description": F.col("props"),
        "category_id": safe_int(json_text_field("props", "$.k")),
        "tags": F.array(F.col("event_type"), F.col("user_id").cast("string")),
        "view_count": F.round(value * 100).cast("bigint"),
        "like_count": safe_long(json_text_field("props", "$.k")),
        "dislike_count": F.when(F.col("event_type") != "purchase", F.col("user_id")),
        "favorite_count": None,
        "comment_count": F.col("event_id"),
        "thumbnail_url": None,
        "comments_disabled": None,
        "ratings_disabled": None,
        "video_error_or_removed": None,
        "duration": None,
        "definition": None,
        "caption": None,
        "licensed_content": None,
        "silver_ingestion_timestamp": F.current_timestamp(),
    }
    select = []
    for name in PROJECTED_VIDEO_COLUMNS:
        expr = columns[name]
        select.append(_null(name) if expr is None else expr.cast(VIDEO_TYPES[name]).alias(name))
    select.append(
        F.concat(F.lit("bronze/events/part-"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
        .alias(SOURCE_FILE)
    )
    # published_at keeps the table's wall-clock value (timestamp_ntz -> the
    # session zone is UTC, so the instant is the same text).
    return events.select(*select)


def events_as_api_rows(events: DataFrame) -> DataFrame:
    """``events`` as a second source for the alignment and comparison queries."""
    return events.select(
        F.lit("youtube_api").alias("source"),
        F.upper(F.col("event_type")).alias("region"),
        F.col("user_id").cast("string").alias("video_id"),
        F.to_date(F.col("ts")).alias("trending_date"),
        F.round(F.col("value") * 100).cast("bigint").alias("view_count"),
    )


def nations_as_category_drops(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Nations as categories of three drops: all of them, then renamed ones of two drop days.

    The second day brings ids divisible by two under their region's name, and those divisible by
    four once more in a later file; the third day brings ids divisible by three with a suffix.
    """
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("category_id"), "n_name", "r_name"
    )

    def drop(day: str, hour: int, every: int, title) -> DataFrame:
        return rows.where(F.col("category_id") % every == 0).select(
            "category_id",
            title.alias("category_title"),
            F.lit(day).cast("date").alias("drop_date"),
            F.lit(f"categories/date={day}/hour={hour:02d}").alias("bronze_file"),
        )

    return (
        drop("2024-01-05", 3, 1, F.col("n_name"))
        .unionByName(drop("2024-01-12", 3, 2, F.col("r_name")))
        .unionByName(drop("2024-01-12", 9, 4, F.concat_ws(" ", "n_name", "r_name")))
        .unionByName(drop("2024-01-20", 3, 3, F.concat(F.col("n_name"), F.lit(" new"))))
    )


# An API response carries at most MAX_RESULTS items, so nested stand-ins
# (payloads, category files) are cut into pages of about that many items; no
# single array grows with the data.
PAGE_SIZE = MAX_RESULTS_LIMITS[1]


def orders_as_api_payloads(orders: DataFrame, lineitem: DataFrame, title: str = "part ") -> DataFrame:
    """``orders`` with their line items nested as API responses.

    Rows hold ``items`` typed exactly as the API schema reads them, so the
    real projection runs on them. An order with no line items is a response
    with an empty ``items`` list.

    A response carries ``PAGE_SIZE`` items on average: an order with
    n line items is split into ceil(n / 50) pages by a hash of the item, so a
    huge order becomes many bounded arrays instead of one (line numbers are
    not unique per order in the test data, so they cannot be the page key).
    Publish times are the ship date plus a millisecond offset from the part
    and supplier keys, which makes the dedup order total.
    """
    return _pages(orders, lineitem, _api_item(F.col, title))


def _api_item(c, title: str) -> Column:
    """The API item of a line; ``c`` gives the line's columns by name."""
    thumbnails_type = API_ITEM_SCHEMA["snippet"].dataType["thumbnails"].dataType
    return F.struct(
        F.concat_ws("-", c("l_orderkey").cast("string"), c("l_linenumber").cast("string")).alias("id"),
        F.struct(
            F.date_format(
                F.timestamp_add("MILLISECOND", c("l_partkey") * 100000 + c("l_suppkey"), c("l_shipdate")),
                "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
            ).alias("publishedAt"),
            c("l_suppkey").cast("string").alias("channelId"),
            F.concat(F.lit("supplier "), c("l_suppkey").cast("string")).alias("channelTitle"),
            F.concat(F.lit(title), c("l_partkey").cast("string")).alias("title"),
            c("l_returnflag").alias("description"),
            c("l_linenumber").cast("string").alias("categoryId"),
            F.array(c("l_returnflag"), c("l_linestatus")).alias("tags"),
            F.lit(None).cast(thumbnails_type).alias("thumbnails"),
        ).alias("snippet"),
        F.struct(
            F.format_string("%.2f", c("l_quantity")).alias("viewCount"),
            c("l_partkey").cast("string").alias("likeCount"),
            c("l_suppkey").cast("string").alias("favoriteCount"),
            c("l_linenumber").cast("string").alias("commentCount"),
        ).alias("statistics"),
        F.struct(
            F.concat(F.lit("PT"), c("l_linenumber").cast("string"), F.lit("M")).alias("duration"),
            F.when(c("l_linestatus") == "O", F.lit("hd")).otherwise(F.lit("sd")).alias("definition"),
            F.when(c("l_returnflag") == "R", F.lit("true")).otherwise(F.lit("false")).alias("caption"),
            F.lit("true").alias("licensedContent"),
        ).alias("contentDetails"),
    )


# What an API item is made of: a tenth of its text.
LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus", "l_quantity",
)


def _pages(orders: DataFrame, l: DataFrame, item: Column) -> DataFrame:
    """Order pages with ``item`` of their lines as ``items``."""
    # Only orders over one page need their count; that list is short, and its
    # join keeps lineitem on the left, so a hot order can be split.
    large = (
        l.groupBy(F.col("l_orderkey").alias("_ok"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > PAGE_SIZE)
    )
    pages_of = F.ceil(F.col("_n") / F.lit(PAGE_SIZE))
    item_hash = F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    paged = l.join(large, l.l_orderkey == large._ok, "left").withColumn(
        "page", F.coalesce(F.pmod(item_hash, pages_of), F.lit(0)).cast("bigint")
    )
    # Lines meet per (order, page), so a hot order is dealt over its pages. Item
    # order inside a response does not matter to any consumer.
    filled = paged.groupBy("l_orderkey", "page").agg(F.collect_list(item).alias("items"))
    empty = F.array().cast(f"array<{filled.schema['items'].dataType.elementType.simpleString()}>")
    pages = orders.join(filled, orders.o_orderkey == filled.l_orderkey, "left").select(
        "o_orderkey",
        F.coalesce("page", F.lit(0)).alias("page"),
        "o_orderpriority",
        "o_orderdate",
        F.coalesce("items", empty).alias("items"),
    )
    return pages.select(
        F.col("o_orderkey"),
        F.col("page"),
        F.concat(
            F.lit("api_raw/videos/region="),
            F.lower(F.col("o_orderpriority").substr(3, 2)),
            F.lit("/date="),
            F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.lit("/hour=00/"),
            F.col("o_orderkey").cast("string"),
            F.lit(".json"),
        ).alias("_source_file"),
        F.col("items"),
    )


def parts_as_category_files(part: DataFrame) -> DataFrame:
    """``part`` as category JSON files: one file per brand and 50 part keys.

    Item ids are part sizes, so ids repeat inside a file and the last one must
    win. Files are JSON text parsed back with the category schema.
    """
    file_key = F.concat(
        F.lit("raw_reference_data/region="),
        # Brand digits spelled as letters: two-digit brands give a valid region,
        # one-digit brands a one-letter code that the region rule rejects.
        F.translate(
            F.regexp_replace(F.col("p_brand"), "[^0-9]", ""), "0123456789", "abcdefghij"
        ).substr(1, 2),
        F.lit("/"),
        F.regexp_replace(F.col("p_brand"), "#", "_"),
        F.lit("_"),
        F.floor(F.col("p_partkey") / PAGE_SIZE).cast("string"),
        F.lit("_category_id.json"),
    )
    items = part.select(
        file_key.alias("bronze_file"),
        F.struct(
            F.col("p_partkey").alias("_pos"),
            F.lit("youtube#videoCategory").alias("kind"),
            F.col("p_type").alias("etag"),
            F.col("p_size").cast("string").alias("id"),
            F.struct(
                F.col("p_type").alias("channelId"),
                F.col("p_name").alias("title"),
                (F.col("p_size") > 25).alias("assignable"),
            ).alias("snippet"),
        ).alias("item"),
    )
    files = items.groupBy("bronze_file").agg(
        F.array_sort(F.collect_list("item"), lambda a, b: F.signum(a["_pos"] - b["_pos"]).cast("int")).alias(
            "items"
        )
    )
    return files.select(
        "bronze_file",
        F.to_json(
            F.struct(
                F.lit("youtube#videoCategoryListResponse").alias("kind"),
                F.lit("etag").alias("etag"),
                F.transform("items", lambda x: x.dropFields("_pos")).alias("items"),
            )
        ).alias("value"),
    ).withColumn("payload", F.from_json("value", CATEGORY_PAYLOAD_SCHEMA))


# Bronze files written from the test tables ---------------------------------
def write_events_as_csv_bronze(events: DataFrame, root: str, compression: str = "lz4") -> str:
    """``events`` written as trending CSV files under ``region=<event_type>/``.

    Text exactly as the CSV contract has it: ``yy.dd.mm`` dates, ISO publish
    times, pipe-separated tags, counts and flags as text, JSON text (quotes,
    commas) in the description. Returns the CSV root.
    """
    value = F.col("value")
    k = json_text_field("props", "$.k")
    csv = events.select(
        F.col("event_type").alias("region"),
        F.when(value < 1, F.lit("  ")).otherwise(F.col("user_id").cast("string")).alias("video_id"),
        F.date_format("ts", "yy.dd.MM").alias("trending_date"),
        F.when(value < 2, F.lit("")).otherwise(F.concat(F.lit("title "), F.col("event_type"))).alias("title"),
        F.concat(F.lit("channel-"), F.floor(F.col("user_id") / 10).cast("string")).alias("channel_title"),
        k.alias("category_id"),
        F.when(value >= 300, F.lit(None))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("publish_time"),
        F.concat_ws("|", F.col("event_type"), F.col("user_id").cast("string")).alias("tags"),
        F.round(value * 100).cast("bigint").cast("string").alias("views"),
        k.alias("likes"),
        F.when(F.col("event_type") != "purchase", F.col("user_id").cast("string")).alias("dislikes"),
        F.col("event_id").cast("string").alias("comment_count"),
        F.concat(F.lit("https://i.example/"), F.col("event_id").cast("string")).alias("thumbnail_link"),
        F.when(value > 100, F.lit("True")).otherwise(F.lit("False")).alias("comments_disabled"),
        F.when(value > 50, F.lit("1")).otherwise(F.lit("0")).alias("ratings_disabled"),
        F.when(value > 200, F.lit("maybe"))
        .when(value > 20, F.lit("yes"))
        .otherwise(F.lit("NO"))
        .alias("video_error_or_removed"),
        F.col("props").alias("description"),
    )
    path = f"{root}/youtube/raw"
    (
        csv.write.mode("overwrite")
        .partitionBy("region")
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("compression", compression)
        .csv(path)
    )
    return path


def write_orders_as_api_bronze(
    orders: DataFrame, lineitem: DataFrame, root: str, compression: str = "lz4"
) -> str:
    """API responses as JSON Lines under ``region=/date=/hour=00/``.

    The folder's date is the order's own day. Rows are dealt by folder first, so a
    folder is one file where it is small. What is dealt are the lines; they become items where they are written.
    """
    pages = _pages(orders, lineitem, F.struct(*LINE_COLUMNS)).select(
        F.col("items"),
        F.regexp_extract("_source_file", "region=([^/]+)", 1).alias("region"),
        F.regexp_extract("_source_file", "date=([0-9-]+)", 1).alias("date"),
    )
    docs = pages.hint("rebalance", "region", "date").select(
        F.lit("youtube#videoListResponse").alias("kind"),
        F.transform("items", lambda line: _api_item(line.getField, "part ")).alias("items"),
        "region",
        "date",
        F.lit("00").alias("hour"),
    )
    path = f"{root}/youtube/api_raw/videos"
    docs.write.mode("overwrite").partitionBy("region", "date", "hour").option("compression", compression).json(path)
    return path


def write_orders_as_drifting_api_bronze(orders: DataFrame, lineitem: DataFrame, root: str) -> str:
    """API responses with fields beyond the contract, in one daily drop per order status.

    ``likeCount`` is a number on returned lines, ``tags`` a plain string on second
    lines; third lines have a ``shareCount``, fourth ones a ``status`` object.
    """
    docs = orders_as_api_payloads(orders, lineitem).join(orders.select("o_orderkey", "o_orderstatus"), "o_orderkey")

    def text(x):
        line, out = x["snippet"]["categoryId"], F.to_json(x)
        numeric = F.regexp_replace(out, '"likeCount":"([0-9]+)"', '"likeCount":$1')
        out = F.when(x["snippet"]["description"] == "R", numeric).otherwise(out)
        plain = F.regexp_replace(out, r'"tags":\[[^\]]*\]', '"tags":"plain"')
        out = F.when(line == "2", plain).otherwise(out)
        shared = F.regexp_replace(out, r'"favoriteCount":"([0-9]+)"', '"favoriteCount":"$1","shareCount":$1')
        out = F.when(line == "3", shared).otherwise(out)
        public = F.regexp_replace(out, r"\}$", ',"status":{"privacyStatus":"public"}}')
        return F.when(line == "4", public).otherwise(out)

    day = F.when(F.col("o_orderstatus") == "F", "2024-01-02").when(F.col("o_orderstatus") == "O", "2024-01-03")
    path = f"{root}/youtube/api_raw/videos"
    texts = docs.select(
        F.concat(
            F.lit('{"kind":"youtube#videoListResponse","items":['), F.concat_ws(",", F.transform("items", text)), F.lit("]}")
        ).alias("value"),
        F.regexp_extract("_source_file", "region=([^/]+)", 1).alias("region"),
        day.otherwise("2024-01-04").alias("date"),
        F.lit("00").alias("hour"),
    )
    # A handful of folders: every task writes to each of them, and no text is shuffled or sorted for that.
    with settings(orders.sparkSession, OPEN_FILES):
        texts.write.mode("overwrite").partitionBy("region", "date", "hour").text(
            path, lineSep=RECORD_SEPARATOR, compression="lz4"
        )
    return path


def write_category_drop(files: DataFrame, root: str, drop: str) -> None:
    """Category files (region, file, value) as ``<drop>/region=<region>/<file>.json``.

    Spark names the files it writes, so they are renamed, some 50 items each. A file costs a task more than
    its text, so files are dealt over all of them.
    """
    spark = files.sparkSession
    folder = f"{root}/{drop}"
    spread(files, "region", "file").write.options(**COMMIT_IN_TASKS).partitionBy("region", "file").text(
        f"{folder}-parts", lineSep=RECORD_SEPARATOR
    )
    path = spark._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    made, pairs = set(), []
    # Spark lists the folders, so a file costs the driver its rename and no listing.
    for row in spark.read.format("binaryFile").load(f"{folder}-parts").select("path").collect():
        region, name = row["path"].split("/")[-3:-1]
        if region not in made:
            fs.mkdirs(path(f"{folder}/{region}"))
            made.add(region)
        pairs.append((row["path"], f"{folder}/{region}/{name.partition('=')[2]}.json"))
    rename_all(spark, pairs)
    fs.delete(path(f"{folder}-parts"), True)
