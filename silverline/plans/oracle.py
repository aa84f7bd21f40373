"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on the driver's pre-registered views and must give the same
rows and column names as the Spark query of the same key.
"""

from __future__ import annotations

TS_TEXT = "'%Y-%m-%d %H:%M:%S.%f'"

# The events stand-in, as raw observations.
EVENTS_AS_VIDEOS = """
SELECT
  CASE WHEN event_type = 'purchase' THEN ' YouTube_API ' ELSE 'kaggle' END AS source,
  ' ' || event_type || ' ' AS region,
  CASE WHEN value < 1 THEN '  ' ELSE CAST(user_id AS VARCHAR) END AS video_id,
  CAST(ts AS DATE) AS trending_date,
  CASE WHEN value >= 300 THEN NULL ELSE ts END AS published_at,
  'channel-' || CAST(CAST(floor(user_id / 10) AS BIGINT) AS VARCHAR) AS channel_title,
  CASE WHEN value < 2 THEN '' ELSE '  title ' || event_type || ' ' END AS title,
  props AS description,
  TRY_CAST(regexp_replace(json_extract_string(props, '$.k'), '([0-9])\\.[0-9]*\\s*$', '\\1') AS INTEGER)
    AS category_id,
  event_type || '|' || CAST(user_id AS VARCHAR) AS tags,
  CAST(round(value * 100) AS BIGINT) AS view_count,
  TRY_CAST(regexp_replace(json_extract_string(props, '$.k'), '([0-9])\\.[0-9]*\\s*$', '\\1') AS BIGINT)
    AS like_count,
  CASE WHEN event_type <> 'purchase' THEN CAST(user_id AS BIGINT) END AS dislike_count,
  CAST(event_id AS BIGINT) AS comment_count,
  event_id
FROM events
"""

# Cleansing: lower/upper + trim, trim text columns, blanks to NULL.
CLEANSED_EVENTS = f"""
WITH raw AS ({EVENTS_AS_VIDEOS})
SELECT
  NULLIF(lower(trim(source)), '') AS source,
  NULLIF(upper(trim(region)), '') AS region,
  NULLIF(trim(video_id), '') AS video_id,
  trending_date,
  published_at,
  NULLIF(trim(channel_title), '') AS channel_title,
  NULLIF(trim(title), '') AS title,
  trim(description) AS description,
  category_id, tags, view_count, like_count, dislike_count, comment_count, event_id
FROM raw
"""

INVALID = """(video_id IS NULL OR category_id IS NULL OR source IS NULL OR region IS NULL
  OR trending_date IS NULL OR published_at IS NULL)"""
NEGATIVE = """((view_count IS NOT NULL AND view_count < 0) OR (like_count IS NOT NULL AND like_count < 0)
  OR (dislike_count IS NOT NULL AND dislike_count < 0) OR (comment_count IS NOT NULL AND comment_count < 0))"""

METRIC_AGGS = f"""
  count(*) AS input_rows,
  count(*) FILTER (WHERE {INVALID}) AS invalid_critical_rows,
  count(*) FILTER (WHERE {NEGATIVE}) AS invalid_numeric_rows,
  count(*) FILTER (WHERE video_id IS NULL) AS missing_video_id,
  count(*) FILTER (WHERE category_id IS NULL) AS missing_category_id,
  count(*) FILTER (WHERE region IS NULL) AS missing_region,
  count(*) FILTER (WHERE trending_date IS NULL) AS missing_trending_date,
  count(*) FILTER (WHERE published_at IS NULL) AS missing_published_at,
  count(*) FILTER (WHERE title IS NULL) AS missing_title,
  count(*) FILTER (WHERE channel_title IS NULL) AS missing_channel_title
"""

VERDICT = """CASE WHEN input_rows = 0 THEN 'no_rows'
  WHEN CAST(invalid_critical_rows AS DOUBLE) / input_rows > 0.05 THEN 'invalid_ratio'
  WHEN invalid_numeric_rows > 0 THEN 'negative_metrics'
  WHEN input_rows - invalid_critical_rows = 0 THEN 'no_valid_rows'
  ELSE 'pass' END"""

RATIO = """CASE WHEN input_rows > 0 THEN CAST(invalid_critical_rows AS DOUBLE) / input_rows END"""


def _flat_videos(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return f"""{p}source, {p}region, {p}video_id,
  strftime({p}trending_date, '%Y-%m-%d') AS trending_date,
  strftime({p}published_at, {TS_TEXT}) AS published_at,
  {p}channel_title, {p}title, {p}description, {p}category_id, {p}tags,
  {p}view_count, {p}like_count, CAST({p}dislike_count AS DOUBLE) AS dislike_count,
  {p}comment_count"""


ORACLE: dict[str, str] = {}

ORACLE["silver_videos"] = f"""
WITH clean AS ({CLEANSED_EVENTS}),
valid AS (SELECT * FROM clean WHERE NOT {INVALID}),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY source, region, video_id, trending_date
    ORDER BY published_at DESC NULLS LAST, event_id DESC) AS rn
  FROM valid)
SELECT {_flat_videos()} FROM ranked WHERE rn = 1
"""

ORACLE["dedup_latest_per_day"] = f"""
WITH raw AS ({EVENTS_AS_VIDEOS}),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY source, region, video_id, trending_date
    ORDER BY published_at DESC NULLS LAST, event_id DESC) AS rn
  FROM raw)
SELECT source, region, video_id, strftime(trending_date, '%Y-%m-%d') AS trending_date,
  strftime(published_at, {TS_TEXT}) AS published_at, event_id
FROM ranked WHERE rn = 1
"""

ORACLE["dq_metrics"] = f"""
WITH clean AS ({CLEANSED_EVENTS}),
m AS (SELECT {METRIC_AGGS} FROM clean)
SELECT *, {RATIO} AS invalid_critical_row_ratio, {VERDICT} AS verdict FROM m
"""

ORACLE["missing_by_column"] = f"""
WITH clean AS ({CLEANSED_EVENTS}),
m AS (SELECT {METRIC_AGGS} FROM clean)
SELECT 'video_id' AS column_name, missing_video_id AS missing_rows FROM m
UNION ALL SELECT 'category_id', missing_category_id FROM m
UNION ALL SELECT 'region', missing_region FROM m
UNION ALL SELECT 'trending_date', missing_trending_date FROM m
UNION ALL SELECT 'published_at', missing_published_at FROM m
UNION ALL SELECT 'title', missing_title FROM m
UNION ALL SELECT 'channel_title', missing_channel_title FROM m
"""

ORACLE["gate_by_day"] = f"""
WITH clean AS ({CLEANSED_EVENTS}),
m AS (SELECT source, region, trending_date, {METRIC_AGGS} FROM clean
      GROUP BY source, region, trending_date)
SELECT source, region, strftime(trending_date, '%Y-%m-%d') AS trending_date,
  input_rows, invalid_critical_rows, {RATIO} AS invalid_critical_row_ratio,
  invalid_numeric_rows, {VERDICT} AS verdict
FROM m
"""

ORACLE["critical_filter"] = f"""
WITH clean AS ({CLEANSED_EVENTS})
SELECT source, region, video_id, strftime(trending_date, '%Y-%m-%d') AS trending_date,
  event_id
FROM clean WHERE NOT {INVALID}
"""

ORACLE["quarantine_reasons"] = f"""
WITH clean AS ({CLEANSED_EVENTS})
SELECT event_id, source, region,
  concat_ws(',',
    CASE WHEN video_id IS NULL THEN 'video_id' END,
    CASE WHEN category_id IS NULL THEN 'category_id' END,
    CASE WHEN source IS NULL THEN 'source' END,
    CASE WHEN region IS NULL THEN 'region' END,
    CASE WHEN trending_date IS NULL THEN 'trending_date' END,
    CASE WHEN published_at IS NULL THEN 'published_at' END) AS failed_columns
FROM clean WHERE {INVALID}
"""

ORACLE["negative_metric_rows"] = """
SELECT c_custkey, c_nationkey, c_acctbal FROM customer
WHERE c_acctbal IS NOT NULL AND c_acctbal < 0
"""

ORACLE["explode_items_outer"] = f"""
SELECT
  o.o_orderkey,
  CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS video_id,
  lower(substr(o.o_orderpriority, 3, 2)) AS region,
  strftime(o.o_orderdate, '%Y-%m-%d') AS trending_date,
  strftime(l.l_shipdate + to_milliseconds(l.l_partkey * 100000 + l.l_suppkey), {TS_TEXT})
    AS published_at,
  CAST(l.l_suppkey AS VARCHAR) AS channel_id,
  'supplier ' || CAST(l.l_suppkey AS VARCHAR) AS channel_title,
  'part ' || CAST(l.l_partkey AS VARCHAR) AS title,
  CAST(l.l_linenumber AS DOUBLE) AS category_id,
  CASE WHEN l.l_orderkey IS NULL THEN '' ELSE l.l_returnflag || '|' || l.l_linestatus END AS tags,
  CAST(TRY_CAST(regexp_replace(printf('%.2f', l.l_quantity), '([0-9])\\.[0-9]*\\s*$', '\\1') AS BIGINT) AS DOUBLE)
    AS view_count,
  CAST(l.l_partkey AS DOUBLE) AS like_count,
  CAST(l.l_suppkey AS DOUBLE) AS favorite_count,
  CAST(l.l_linenumber AS DOUBLE) AS comment_count,
  'PT' || CAST(l.l_linenumber AS VARCHAR) || 'M' AS duration,
  CASE WHEN l.l_orderkey IS NULL THEN NULL WHEN l.l_linestatus = 'O' THEN 'hd' ELSE 'sd' END
    AS definition,
  CASE WHEN l.l_orderkey IS NULL THEN NULL WHEN l.l_returnflag = 'R' THEN 'true' ELSE 'false' END
    AS caption,
  CASE WHEN l.l_orderkey IS NULL THEN NULL ELSE 'true' END AS licensed_content
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
"""

ORACLE["path_extract"] = """
SELECT page_id,
  lower(regexp_extract(url, 'page=([^/]+)', 1)) AS page_value,
  lower(regexp_extract(url, 'ref=([^/]+)', 1)) AS ref_value,
  strftime(TRY_CAST(regexp_extract(url, 'date=([0-9-]+)', 1) AS DATE), '%Y-%m-%d') AS path_date,
  string_split(url, '/')[-1] AS last_segment,
  url_decode(replace(url, '+', ' ')) AS decoded_url
FROM pages
"""

ORACLE["split_tags"] = """
SELECT doc_id,
  CAST(len(string_split(coalesce(text, ''), '|')) AS INTEGER) AS n_tags,
  array_to_string(list_transform(string_split(coalesce(text, ''), '|'), lambda x: md5(x)), ',') AS tag_digests,
  CAST(length(string_split(coalesce(text, ''), '|')[-1]) AS INTEGER) AS last_tag_chars
FROM documents
"""

ORACLE["json_field"] = """
SELECT event_id,
  TRY_CAST(regexp_replace(json_extract_string(props, '$.k'), '([0-9])\\.[0-9]*\\s*$', '\\1') AS BIGINT) AS k,
  strftime(ts, '%Y-%m-%d') AS day,
  strftime(ts, '%H') AS hour
FROM events
"""

ORACLE["cleanse_text"] = """
SELECT
  NULLIF(lower(trim(CASE WHEN c_acctbal < 0 THEN ' YouTube_API ' ELSE ' Kaggle ' END)), '') AS source,
  NULLIF(upper(trim('  ' || lower(c_mktsegment) || ' ')), '') AS region,
  NULLIF(trim(' ' || CAST(c_custkey AS VARCHAR) || ' '), '') AS video_id,
  NULLIF(trim(CASE WHEN c_acctbal < 0 THEN '   ' ELSE ' ' || c_name || '  ' END), '') AS title,
  NULLIF(trim(CASE WHEN c_acctbal > 9000 THEN '' ELSE c_mktsegment END), '') AS channel_title,
  trim(chr(9) || c_name || ' ') AS description
FROM customer
"""

_BOOL = """CASE WHEN lower({x}) IN ('true', '1', 'yes', 'y') THEN 'true'
  WHEN lower({x}) IN ('false', '0', 'no', 'n') THEN 'false' END"""

ORACLE["to_bool"] = f"""
WITH t AS (
  SELECT doc_id, quality,
    CASE WHEN toxic = 1 AND quality = 1 THEN 'maybe' WHEN toxic = 1 THEN 'Y'
         WHEN quality = 1 THEN 'YES' ELSE '0' END AS raw_text
  FROM labels)
SELECT doc_id, raw_text, {_BOOL.format(x='raw_text')} AS flag,
  {_BOOL.format(x='CAST(quality AS VARCHAR)')} AS quality_flag
FROM t
"""

ORACLE["safe_integer"] = """
WITH t AS (
  SELECT o_orderkey,
    CASE WHEN o_orderpriority = '1-URGENT' THEN '-' || printf('%.2f', o_totalprice)
         WHEN o_orderstatus = 'F' THEN printf('%.2f', o_totalprice)
         WHEN o_orderstatus = 'O' THEN ' ' || CAST(o_custkey AS VARCHAR) || ' '
         ELSE CAST(o_orderkey AS VARCHAR) || 'x' END AS raw_text
  FROM orders)
SELECT o_orderkey, raw_text,
  CAST(TRY_CAST(regexp_replace(raw_text, '([0-9])\\.[0-9]*\\s*$', '\\1') AS BIGINT) AS DOUBLE) AS as_long
FROM t
"""

ORACLE["ydm_date"] = """
WITH t AS (
  SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%y.%m')
         ELSE strftime(o_orderdate, '%y.%d.%m') END AS raw_text
  FROM orders),
p AS (
  SELECT o_orderkey, raw_text, string_split(raw_text, '.') AS parts FROM t),
s AS (
  SELECT o_orderkey, raw_text, parts,
    concat_ws('-', '20' || parts[1], parts[3], parts[2]) AS joined FROM p),
d AS (
  SELECT o_orderkey, raw_text,
    strftime(TRY_CAST(CASE WHEN len(parts) = 2 THEN joined || '-01' ELSE joined END AS DATE),
             '%Y-%m-%d') AS parsed
  FROM s)
SELECT o_orderkey, raw_text, parsed,
  CASE WHEN regexp_matches(raw_text, '^\\d{2}\\.\\d{2}\\.\\d{2}$') THEN parsed END AS strict_parsed
FROM d
"""

ORACLE["align_sources"] = """
SELECT 'kaggle' AS source, upper(event_type) AS region, CAST(user_id AS VARCHAR) AS video_id,
  strftime(CAST(ts AS DATE), '%Y-%m-%d') AS trending_date,
  CAST(round(value * 100) AS BIGINT) AS view_count, CAST(20 AS INTEGER) AS null_columns
FROM events
UNION ALL
SELECT 'youtube_api', upper(substr(o_orderpriority, 3, 2)), CAST(o_custkey AS VARCHAR),
  strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d'),
  CAST(trunc(o_totalprice) AS BIGINT), CAST(20 AS INTEGER)
FROM orders
"""

ORACLE["keep_last"] = """
SELECT conv_id, role, turn, text FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) AS rn
  FROM conversations) WHERE rn = 1
"""

ORACLE["region_filter"] = """
SELECT c_custkey, c_mktsegment FROM customer
WHERE upper(c_mktsegment) IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
"""

ORACLE["manifest_counts"] = """
SELECT 'documents' AS dataset, source, lang, count(*) AS record_count
FROM documents GROUP BY source, lang
"""

ORACLE["payload_items"] = """
WITH o AS (
  SELECT o.o_orderkey, upper(substr(o.o_orderpriority, 3, 2)) AS region,
    count(l.l_orderkey) AS n
  FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  GROUP BY o.o_orderkey, region)
SELECT 'trending_videos' AS dataset, region, 'youtube_data_api_v3' AS source,
  '20240101T000000Z_00000000' AS run_id,
  CAST(sum(CASE WHEN n = 0 THEN 1 ELSE CAST(ceil(n / 50) AS BIGINT) END) AS BIGINT) AS payloads,
  CAST(sum(n) AS BIGINT) AS items
FROM o GROUP BY region
"""

ORACLE["run_report"] = """
WITH a AS (
  SELECT strftime(ts, '%Y%m%d') AS run_id, event_type AS region,
    CASE WHEN value < 50 THEN 'trending_videos' ELSE 'video_categories' END AS dataset,
    value > 200 AS failed
  FROM events),
r AS (
  SELECT run_id, region,
    max(CASE WHEN dataset = 'trending_videos' AND failed THEN 1 ELSE 0 END) AS vf,
    max(CASE WHEN dataset = 'trending_videos' THEN 1 ELSE 0 END) AS va,
    max(CASE WHEN dataset = 'video_categories' AND failed THEN 1 ELSE 0 END) AS cf,
    max(CASE WHEN dataset = 'video_categories' THEN 1 ELSE 0 END) AS ca
  FROM a GROUP BY run_id, region)
SELECT run_id, upper(region) AS region,
  CASE WHEN va = 0 THEN 'not_attempted' WHEN vf = 1 THEN 'failed' ELSE 'ok' END AS videos_status,
  CASE WHEN vf = 1 THEN 'skipped' WHEN cf = 1 THEN 'failed' WHEN ca = 1 THEN 'ok'
       ELSE 'not_fetched' END AS categories_status,
  CAST(max(CASE WHEN vf = 1 OR cf = 1 THEN 207 ELSE 200 END) OVER (PARTITION BY run_id) AS INTEGER)
    AS status_code
FROM r
"""

CATEGORY_FILE_PATH = """'raw_reference_data/region='
  || substr(translate(regexp_replace(p_brand, '[^0-9]', '', 'g'), '0123456789', 'abcdefghij'), 1, 2)
  || '/' || replace(p_brand, '#', '_') || '_'
  || CAST(CAST(floor(p_partkey / 50) AS BIGINT) AS VARCHAR) || '_category_id.json'"""

ORACLE["category_file_status"] = f"""
WITH f AS (SELECT {CATEGORY_FILE_PATH} AS bronze_file FROM part)
SELECT bronze_file,
  CASE WHEN regexp_extract(bronze_file, 'region=([a-z]{{2}})', 1) = '' THEN 'missing_region'
       ELSE 'ok' END AS status,
  CAST(count(*) AS INTEGER) AS item_count
FROM f GROUP BY bronze_file
"""

ORACLE["flatten_categories"] = f"""
WITH f AS (SELECT {CATEGORY_FILE_PATH} AS path, * FROM part),
r AS (
  SELECT *, regexp_extract(path, 'region=([a-z]{{2}})', 1) AS region,
    row_number() OVER (PARTITION BY path, p_size ORDER BY p_partkey DESC) AS rn
  FROM f)
SELECT regexp_replace(string_split(path, '/')[-1], '\\.[A-Za-z0-9]+$', '') AS bronze_file,
  region, CAST(p_size AS BIGINT) AS category_id, p_name AS category_title,
  p_type AS channel_id, CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END AS assignable
FROM r WHERE rn = 1 AND region <> ''
"""

SILVER_EVENTS = f"""
WITH clean AS ({CLEANSED_EVENTS}),
valid AS (SELECT * FROM clean WHERE NOT {INVALID}),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY source, region, video_id, trending_date
    ORDER BY published_at DESC NULLS LAST, event_id DESC) AS rn
  FROM valid)
SELECT * FROM ranked WHERE rn = 1
"""

ORACLE["trending_analytics"] = f"""
WITH s AS ({SILVER_EVENTS})
SELECT source, region, strftime(trending_date, '%Y-%m-%d') AS trending_date,
  count(*) AS videos, count(DISTINCT channel_title) AS channels,
  CAST(sum(view_count) AS BIGINT) AS total_views, avg(view_count) AS avg_views,
  CASE WHEN sum(view_count) <> 0
       THEN CAST(sum(like_count) AS DOUBLE) / CAST(sum(view_count) AS DOUBLE) END AS like_ratio
FROM s GROUP BY source, region, trending_date
"""

ORACLE["channel_analytics"] = f"""
WITH s AS ({SILVER_EVENTS}),
c AS (
  SELECT region, channel_title, count(DISTINCT video_id) AS videos,
    count(DISTINCT trending_date) AS days_trending,
    CAST(sum(view_count) AS BIGINT) AS total_views
  FROM s GROUP BY region, channel_title)
SELECT *, dense_rank() OVER (PARTITION BY region ORDER BY total_views DESC) AS view_rank FROM c
"""

ORACLE["category_analytics"] = f"""
WITH s AS ({SILVER_EVENTS}),
pc AS (
  SELECT region, CAST(category_id AS BIGINT) AS category_id, count(*) AS videos,
    CAST(sum(view_count) AS BIGINT) AS total_views
  FROM s GROUP BY region, category_id)
SELECT pc.region, pc.category_id, n.n_name AS category_title, pc.videos, pc.total_views,
  CAST(pc.total_views AS DOUBLE) / CAST(sum(pc.total_views) OVER (PARTITION BY pc.region) AS DOUBLE)
    AS view_share
FROM pc LEFT JOIN nation n ON pc.category_id = n.n_nationkey
"""

ORACLE["compare_sources"] = f"""
WITH s AS ({SILVER_EVENTS}),
a AS (SELECT region, video_id, trending_date, max(view_count) AS v FROM s
      GROUP BY region, video_id, trending_date),
b AS (SELECT upper(event_type) AS region, CAST(user_id AS VARCHAR) AS video_id,
        CAST(ts AS DATE) AS trending_date, max(CAST(round(value * 100) AS BIGINT)) AS v
      FROM events GROUP BY 1, 2, 3)
SELECT coalesce(a.region, b.region) AS region, coalesce(a.video_id, b.video_id) AS video_id,
  strftime(coalesce(a.trending_date, b.trending_date), '%Y-%m-%d') AS trending_date,
  CAST(a.v AS DOUBLE) AS silver_views, CAST(b.v AS DOUBLE) AS raw_views,
  CASE WHEN a.region IS NOT NULL AND b.region IS NOT NULL THEN 'both'
       WHEN a.region IS NOT NULL THEN 'silver_only' ELSE 'raw_only' END AS presence
FROM a FULL OUTER JOIN b
  ON a.region = b.region AND a.video_id = b.video_id AND a.trending_date = b.trending_date
"""

ORACLE["gold_refresh"] = f"""
WITH s AS (SELECT * FROM ({SILVER_EVENTS}) WHERE region <> 'CLICK'),
t AS (
  SELECT 'trending' AS gold_table, region, strftime(trending_date, '%Y-%m-%d') AS key, count(*) AS videos,
    CAST(sum(view_count) AS BIGINT) AS total_views
  FROM s GROUP BY source, region, trending_date
  UNION ALL
  SELECT 'channel', region, channel_title, count(DISTINCT video_id), CAST(sum(view_count) AS BIGINT)
  FROM s GROUP BY region, channel_title)
SELECT *, (SELECT count(DISTINCT region) FROM ({SILVER_EVENTS})) AS first_regions,
  CAST(2 AS BIGINT) AS second_regions, CAST(0 AS BIGINT) AS third_regions
FROM t
"""

ORACLE["quality_by_partition"] = f"""
WITH clean AS ({CLEANSED_EVENTS}),
m AS (SELECT source, region, {METRIC_AGGS} FROM clean GROUP BY source, region)
SELECT *, {RATIO} AS invalid_critical_row_ratio FROM m
"""

ORACLE["category_rollup"] = """
WITH c AS (
  SELECT c_nationkey, count(*) AS customers,
    count(*) FILTER (WHERE c_acctbal IS NOT NULL AND c_acctbal < 0) AS negative_balances
  FROM customer GROUP BY c_nationkey)
SELECT r.r_name AS region_name, n.n_name AS nation_name, c.customers, c.negative_balances
FROM c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

ORACLE["current_categories"] = f"""
WITH f AS (SELECT {CATEGORY_FILE_PATH} AS path, * FROM part),
r AS (
  SELECT *, regexp_extract(path, 'region=([a-z]{{2}})', 1) AS region,
    row_number() OVER (PARTITION BY path, p_size ORDER BY p_partkey DESC) AS rn
  FROM f),
s AS (
  SELECT regexp_replace(string_split(path, '/')[-1], '\\.[A-Za-z0-9]+$', '') AS bronze_file,
    region, CAST(p_size AS BIGINT) AS category_id, p_name AS category_title, p_type AS channel_id
  FROM r WHERE rn = 1 AND region <> ''),
c AS (
  SELECT *, row_number() OVER (PARTITION BY region, category_id ORDER BY bronze_file DESC) AS rn
  FROM s)
SELECT region, category_id, category_title, channel_id FROM c WHERE rn = 1
"""

ORACLE["csv_bronze_videos"] = f"""
WITH raw AS (
  SELECT 'kaggle' AS source, upper(event_type) AS region,
    CASE WHEN value < 1 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS video_id,
    CAST(ts AS DATE) AS trending_date,
    CASE WHEN value >= 300 THEN NULL ELSE ts END AS published_at,
    CASE WHEN value < 2 THEN NULL ELSE 'title ' || event_type END AS title,
    'channel-' || CAST(CAST(floor(user_id / 10) AS BIGINT) AS VARCHAR) AS channel_title,
    TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS category_id,
    event_type || '|' || CAST(user_id AS VARCHAR) AS tags,
    CAST(round(value * 100) AS BIGINT) AS view_count,
    TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS like_count,
    CASE WHEN event_type <> 'purchase' THEN CAST(user_id AS DOUBLE) END AS dislike_count,
    CAST(event_id AS BIGINT) AS comment_count,
    CASE WHEN value > 100 THEN 'true' ELSE 'false' END AS comments_disabled,
    CASE WHEN value > 50 THEN 'true' ELSE 'false' END AS ratings_disabled,
    CASE WHEN value > 200 THEN NULL WHEN value > 20 THEN 'true' ELSE 'false' END
      AS video_error_or_removed,
    props AS description,
    'https://i.example/' || CAST(event_id AS VARCHAR) AS thumbnail_url
  FROM events),
valid AS (
  SELECT * FROM raw WHERE video_id IS NOT NULL AND category_id IS NOT NULL
    AND trending_date IS NOT NULL AND published_at IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY source, region, video_id, trending_date ORDER BY published_at DESC) AS rn
  FROM valid)
SELECT source, region, video_id, strftime(trending_date, '%Y-%m-%d') AS trending_date,
  strftime(published_at, {TS_TEXT}) AS published_at, title, channel_title, category_id, tags,
  view_count, like_count, dislike_count, comment_count, comments_disabled, ratings_disabled,
  video_error_or_removed, description, thumbnail_url
FROM ranked WHERE rn = 1
"""

ORACLE["api_bronze_videos"] = f"""
WITH raw AS (
  SELECT 'youtube_api' AS source, upper(substr(o.o_orderpriority, 3, 2)) AS region,
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS video_id,
    CAST(o.o_orderdate AS DATE) AS trending_date,
    l.l_shipdate + to_milliseconds(l.l_partkey * 100000 + l.l_suppkey) AS published_at,
    CAST(l.l_suppkey AS VARCHAR) AS channel_id,
    'supplier ' || CAST(l.l_suppkey AS VARCHAR) AS channel_title,
    'part ' || CAST(l.l_partkey AS VARCHAR) AS title,
    CAST(l.l_linenumber AS INTEGER) AS category_id,
    l.l_returnflag || '|' || l.l_linestatus AS tags,
    TRY_CAST(regexp_replace(printf('%.2f', l.l_quantity), '([0-9])\\.[0-9]*\\s*$', '\\1') AS BIGINT)
      AS view_count,
    CAST(l.l_partkey AS BIGINT) AS like_count,
    CAST(l.l_suppkey AS BIGINT) AS favorite_count,
    CAST(l.l_linenumber AS BIGINT) AS comment_count,
    'PT' || CAST(l.l_linenumber AS VARCHAR) || 'M' AS duration,
    CASE WHEN l.l_linestatus = 'O' THEN 'hd' ELSE 'sd' END AS definition,
    CASE WHEN l.l_returnflag = 'R' THEN 'true' ELSE 'false' END AS caption,
    'true' AS licensed_content
  FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey),
valid AS (
  SELECT * FROM raw WHERE video_id IS NOT NULL AND category_id IS NOT NULL
    AND trending_date IS NOT NULL AND published_at IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY source, region, video_id, trending_date ORDER BY published_at DESC) AS rn
  FROM valid)
SELECT source, region, video_id, strftime(trending_date, '%Y-%m-%d') AS trending_date,
  strftime(published_at, {TS_TEXT}) AS published_at, channel_id, channel_title, title,
  category_id, tags, view_count, like_count, favorite_count, comment_count, duration,
  definition, caption, licensed_content
FROM ranked WHERE rn = 1
"""

ORACLE["landed_payloads"] = """
SELECT upper(substr(o.o_orderpriority, 3, 2)) AS region, 'trending_videos' AS dataset,
  count(DISTINCT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)) AS silver_rows,
  '2024-01-02' AS landed_date
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY ALL
UNION ALL
SELECT region, 'video_categories', CAST(sum(n) AS BIGINT), '2024-01-02' FROM (
  SELECT 'm' || substr(translate(regexp_replace(p_brand, '[^0-9]', '', 'g'), '0123456789', 'abcdefghij'), 1, 1) AS region,
    p_brand, p_partkey // 50, count(DISTINCT p_size) AS n
  FROM part GROUP BY ALL)
GROUP BY region
"""

ORACLE["ingestion_runs"] = """
WITH r(st, run_id) AS (VALUES ('F', '20240102T030000Z_00000000'), ('O', '20240103T030000Z_00000000'),
  ('P', '20240104T030000Z_00000000')),
o AS (
  SELECT st, run_id, upper(substr(o_orderpriority, 3, 2)) AS region, count(l_orderkey) AS n
  FROM orders JOIN r ON o_orderstatus = st LEFT JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY o_orderkey, st, run_id, region),
v AS (
  SELECT st, run_id, region, sum(greatest(1, ceil(n / 50))) AS p, sum(n) AS i FROM o
  WHERE st <> 'P' OR region IN ('UR', 'ME') GROUP BY ALL),
f AS (
  SELECT p_partkey // 50 AS k, ['UR', 'HI', 'ME', 'NO', 'LO'][(p_partkey // 50) % 5 + 1] AS region, count(*) AS n
  FROM part GROUP BY ALL),
c AS (
  SELECT st, run_id, region, count(*) AS p, sum(n) AS i FROM f, r
  WHERE (st <> 'P' OR region IN ('UR', 'ME')) AND NOT (st = 'O' AND region = 'NO') GROUP BY ALL),
a AS (
  SELECT run_id, region, coalesce(v.p, 0) AS vp, coalesce(v.i, 0) AS vi, coalesce(c.p, 0) AS cp, coalesce(c.i, 0) AS ci,
    v.p IS NOT NULL AND coalesce(v.st, c.st) = 'F' AND region = 'HI' AS vf,
    c.p IS NOT NULL AND coalesce(v.st, c.st) = 'O' AND region = 'LO' AS cf
  FROM v FULL JOIN c USING (run_id, region))
SELECT run_id, region, CASE WHEN vp = 0 THEN 'not_attempted' WHEN vf THEN 'failed' ELSE 'ok' END AS videos_status,
  CASE WHEN vf THEN 'skipped' WHEN cf THEN 'failed' WHEN cp > 0 THEN 'ok' ELSE 'not_fetched' END AS categories_status,
  CAST(max(CASE WHEN vf OR cf THEN 207 ELSE 200 END) OVER (PARTITION BY run_id) AS INTEGER) AS status_code,
  CAST(CASE WHEN vf THEN 0 ELSE vp END AS BIGINT) AS video_payloads,
  CAST(CASE WHEN vf THEN 0 ELSE vi END AS BIGINT) AS video_items,
  CAST(CASE WHEN vf OR cf THEN 0 ELSE cp END AS BIGINT) AS category_payloads,
  CAST(CASE WHEN vf OR cf THEN 0 ELSE ci END AS BIGINT) AS category_items,
  CAST(CASE WHEN vf THEN vp WHEN cf THEN cp ELSE 0 END AS BIGINT) AS failures,
  CAST(CASE WHEN vf THEN 0 ELSE vp END + CASE WHEN vf OR cf THEN 0 ELSE cp END AS BIGINT) AS landed
FROM a
"""

ORACLE["category_job"] = """
WITH f AS (
  SELECT 'Brand_11_' || CAST(p_partkey // 50 AS VARCHAR) || '_category_id' AS file,
    (p_partkey // 50) % 8 AS k, count(*) AS n, count(DISTINCT p_size) AS ids
  FROM part GROUP BY ALL),
g AS (
  SELECT file, CASE k WHEN 1 THEN 'invalid_json' WHEN 2 THEN 'items_not_list' WHEN 3 THEN 'invalid_category_id'
      WHEN 4 THEN 'no_rows' WHEN 5 THEN 'missing_region' WHEN 6 THEN 'items_not_list' ELSE 'ok' END AS status,
    CAST(CASE WHEN k IN (1, 2, 4, 6) THEN 0 WHEN k = 3 THEN 1 ELSE n END AS BIGINT) AS item_count,
    k IN (0, 7) AS good, ids
  FROM f)
SELECT file, status, item_count, CASE WHEN good THEN 'kaggle' END AS source,
  CASE WHEN good THEN 'us' END AS region, CASE WHEN good THEN CAST(ids AS DOUBLE) END AS record_count,
  TRUE AS counts_agree
FROM g
"""

ORACLE["video_job_record"] = """
WITH e AS (
  SELECT event_type, user_id, ts, value, value < 1 AS no_id, value >= 300 AS no_time,
    TRY_CAST(regexp_replace(json_extract_string(props, '$.k'), '([0-9])\\.[0-9]*\\s*$', '\\1') AS INTEGER) IS NULL
      AS no_category
  FROM events),
v AS (SELECT DISTINCT event_type, user_id, CAST(ts AS DATE) FROM e WHERE NOT (no_id OR no_time OR no_category)),
c AS (
  SELECT count(*) AS input_rows, count(*) FILTER (no_id OR no_time OR no_category) AS invalid,
    count(*) FILTER (no_id) AS no_id, count(*) FILTER (no_time) AS no_time FROM e)
SELECT 'kaggle_videos' AS dataset, input_rows, invalid AS invalid_rows_removed,
  input_rows - invalid - (SELECT count(*) FROM v) AS duplicate_rows_removed,
  (SELECT count(*) FROM v) AS output_rows, invalid / input_rows AS invalid_critical_row_ratio,
  CAST(0 AS BIGINT) AS invalid_numeric_rows, invalid AS rejected_rows, no_id AS rejected_video_id,
  no_time AS rejected_published_at
FROM c
"""

ORACLE["stream_landed_videos"] = f"""
WITH lines AS (
  SELECT 'youtube_api' AS source, upper(substr(o.o_orderpriority, 3, 2)) AS region,
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS video_id,
    DATE '2024-01-02' AS trending_date,
    l.l_shipdate + to_milliseconds(l.l_partkey * 100000 + l.l_suppkey) AS published_at,
    CAST(l.l_partkey AS VARCHAR) AS part, CAST(l.l_linenumber AS INTEGER) AS category_id,
    TRY_CAST(regexp_replace(printf('%.2f', l.l_quantity), '([0-9])\\.[0-9]*\\s*$', '\\1') AS BIGINT)
      AS view_count,
    CAST(l.l_linenumber AS BIGINT) AS comment_count
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey),
raw AS (
  SELECT *, 9 AS hour, 'part ' || part AS title FROM lines
  UNION ALL SELECT *, 3, 'late ' || part FROM lines WHERE category_id = 1
  UNION ALL SELECT *, 15, 'update ' || part FROM lines WHERE category_id = 2),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY source, region, video_id, trending_date ORDER BY published_at DESC, hour DESC) AS rn
  FROM raw)
SELECT source, region, video_id, strftime(trending_date, '%Y-%m-%d') AS trending_date,
  strftime(published_at, {TS_TEXT}) AS published_at, title, category_id, view_count, comment_count
FROM ranked WHERE rn = 1
"""

_LINES = """
  SELECT 'youtube_api' AS source, upper(substr(o.o_orderpriority, 3, 2)) AS region,
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS video_id,
    DATE '2024-01-02' AS trending_date,
    l.l_shipdate + to_milliseconds(l.l_partkey * 100000 + l.l_suppkey) AS published_at,
    CAST(l.l_partkey AS VARCHAR) AS part, CAST(l.l_linenumber AS INTEGER) AS category_id,
    TRY_CAST(regexp_replace(printf('%.2f', l.l_quantity), '([0-9])\\.[0-9]*\\s*$', '\\1') AS BIGINT) AS view_count
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey"""

ORACLE["stream_latest_videos"] = f"""
WITH lines AS ({_LINES}),
raw AS (
  SELECT *, 9 AS hour, 'part ' || part AS title FROM lines
  UNION ALL SELECT *, 3, 'late ' || part FROM lines WHERE category_id = 1
  UNION ALL SELECT *, 15, 'update ' || part FROM lines WHERE category_id = 2),
ranked AS (
  SELECT *, count(DISTINCT hour) OVER (PARTITION BY source, region, video_id, trending_date) AS changes,
    row_number() OVER (
      PARTITION BY source, region, video_id, trending_date ORDER BY published_at DESC, hour DESC) AS rn
  FROM raw)
SELECT source, region, video_id, strftime(trending_date, '%Y-%m-%d') AS trending_date,
  strftime(published_at, {TS_TEXT}) AS published_at, title, category_id, view_count, changes,
  CAST(0 AS BIGINT) AS idle_changes
FROM ranked WHERE rn = 1
"""

ORACLE["stream_recovered_videos"] = f"""
WITH lines AS ({_LINES}),
raw AS (
  SELECT *, 9 AS hour, 'part ' || part AS title FROM lines
  UNION ALL SELECT *, 15, 'update ' || part FROM lines WHERE category_id = 2),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY source, region, video_id, trending_date ORDER BY published_at DESC, hour DESC) AS rn
  FROM raw)
SELECT region, video_id, strftime(published_at, {TS_TEXT}) AS published_at, title, view_count
FROM ranked WHERE rn = 1
"""

_DRIFT = """
  SELECT upper(substr(o.o_orderpriority, 3, 2)) AS region,
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS video_id,
    CASE o.o_orderstatus WHEN 'F' THEN '2024-01-02' WHEN 'O' THEN '2024-01-03' ELSE '2024-01-04' END AS trending_date,
    unnest([
      CASE WHEN l.l_returnflag = 'R' THEN {'path': 'statistics.likeCount', 'status': 'retyped', 'seen_type': 'BIGINT',
        'json': CAST(l.l_partkey AS VARCHAR)} END,
      CASE WHEN l.l_linenumber = 2 THEN {'path': 'snippet.tags', 'status': 'retyped', 'seen_type': 'STRING',
        'json': '"plain"'} END,
      CASE WHEN l.l_linenumber = 3 THEN {'path': 'statistics.shareCount', 'status': 'unknown', 'seen_type': 'BIGINT',
        'json': CAST(l.l_suppkey AS VARCHAR)} END,
      CASE WHEN l.l_linenumber = 4 THEN {'path': 'status', 'status': 'unknown', 'seen_type': 'OBJECT<privacyStatus: STRING>',
        'json': '{"privacyStatus":"public"}'} END]) AS d
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey"""

ORACLE["api_drift"] = f"""
SELECT trending_date, d.path AS path, d.status AS status, d.seen_type AS seen_type, count(*) AS items
FROM ({_DRIFT}) WHERE d IS NOT NULL GROUP BY ALL
"""

ORACLE["api_rescued"] = f"""
SELECT region, video_id, trending_date, d.path AS path, d.json AS json FROM ({_DRIFT}) WHERE d IS NOT NULL
"""

ORACLE["stream_categories"] = """
WITH reference AS (
  SELECT 'kaggle' AS source, 'us' AS region, 'Brand_11_' || CAST(p_partkey // 50 AS VARCHAR) || '_category_id' AS file,
    (p_partkey // 50) % 4 AS k, p_size FROM part),
kept AS (
  SELECT source, region, file, p_size FROM reference WHERE k <> 0 OR p_size > 25),
landed AS (
  SELECT 'youtube_api' AS source, lower(substr(r_name, 1, 2)) AS region, 'landed' AS file, n_nationkey AS id
  FROM nation JOIN region ON n_regionkey = r_regionkey),
all_rows AS (
  SELECT DISTINCT source, region, file, p_size AS id FROM kept
  UNION ALL SELECT source, region, file, id FROM landed),
seen AS (
  SELECT count(DISTINCT file) FILTER (k < 3) AS files, count(DISTINCT file) FILTER (k = 2) AS failed FROM reference)
SELECT source, region, file, count(*) AS silver_rows, CAST(sum(id) AS BIGINT) AS id_sum,
  any_value(files) AS reference_files_seen, any_value(failed) AS failed_then, CAST(0 AS BIGINT) AS idle_files
FROM all_rows, seen GROUP BY source, region, file
"""

ORACLE["source_differences"] = f"""
WITH a AS (SELECT region, video_id, trending_date, max(view_count) AS views FROM ({SILVER_EVENTS}) GROUP BY ALL),
b AS (SELECT upper(event_type) AS region, CAST(user_id AS VARCHAR) AS video_id, CAST(ts AS DATE) AS trending_date,
    max(CAST(round(value * 100) AS BIGINT)) AS views
  FROM events GROUP BY ALL)
SELECT region, video_id, strftime(trending_date, '%Y-%m-%d') AS trending_date, views,
  CAST(sum(l) AS BIGINT) AS left_rows, CAST(sum(1 - l) AS BIGINT) AS right_rows
FROM (SELECT *, 1 AS l FROM a UNION ALL SELECT *, 0 FROM b)
GROUP BY ALL HAVING sum(l) <> sum(1 - l)
"""

_RANKS = ", ".join(
    f"vals[CAST(ceil({rank} * len(vals)) AS BIGINT)] AS {name}"
    for name, rank in (("p25", "0.25"), ("p50", "0.5"), ("p75", "0.75"), ("p90", "0.9"), ("p99", "0.99"))
)

ORACLE["view_distribution"] = f"""
WITH g AS (
  SELECT source, region, trending_date, count(view_count) AS "values",
    count(*) - count(view_count) AS nulls, min(view_count) AS lowest, max(view_count) AS highest,
    list_sort(list(view_count) FILTER (WHERE view_count IS NOT NULL)) AS vals
  FROM ({CLEANSED_EVENTS}) GROUP BY source, region, trending_date),
q AS (SELECT *, list_transform(range(1, 17), lambda i: vals[CAST(ceil(i / 16.0 * len(vals)) AS BIGINT)]) AS grid FROM g),
p AS (
  SELECT *, lag(trending_date) OVER w AS before_day, lag(grid) OVER w AS before_grid
  FROM q WINDOW w AS (PARTITION BY source, region ORDER BY trending_date))
SELECT source, region, strftime(trending_date, '%Y-%m-%d') AS trending_date, "values", nulls, lowest, highest, {_RANKS},
  strftime(before_day, '%Y-%m-%d') AS previous_day,
  CASE WHEN before_grid IS NOT NULL THEN
    CAST(list_sum(list_transform(range(1, 17), lambda i: abs(grid[i] - before_grid[i]))) AS DOUBLE) / 16 END AS shift
FROM p
"""

ORACLE["category_history"] = f"""
WITH n AS (SELECT n.*, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
v AS (
  SELECT n_nationkey AS id, n_name AS title, DATE '2024-01-05' AS valid_from FROM n
  UNION ALL SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN n_name || ' ' || r_name ELSE r_name END,
    DATE '2024-01-12' FROM n WHERE n_nationkey % 2 = 0
  UNION ALL SELECT n_nationkey, n_name || ' new', DATE '2024-01-20' FROM n WHERE n_nationkey % 3 = 0),
w AS (SELECT *, lead(valid_from) OVER (PARTITION BY id ORDER BY valid_from) AS valid_to FROM v)
SELECT s.region, CAST(s.category_id AS BIGINT) AS category_id, w.title AS category_title,
  strftime(w.valid_from, '%Y-%m-%d') AS valid_from, strftime(w.valid_to, '%Y-%m-%d') AS valid_to,
  strftime(min(s.trending_date), '%Y-%m-%d') AS first_day, strftime(max(s.trending_date), '%Y-%m-%d') AS last_day,
  count(*) AS videos, CAST(sum(s.view_count) AS BIGINT) AS total_views
FROM ({SILVER_EVENTS}) s LEFT JOIN w ON s.category_id = w.id AND s.trending_date >= w.valid_from
  AND (w.valid_to IS NULL OR s.trending_date < w.valid_to)
GROUP BY s.region, s.category_id, w.title, w.valid_from, w.valid_to
"""

ORACLE["bucketed_sources"] = f"""
WITH a AS (
  SELECT region, video_id, count(DISTINCT trending_date) AS silver_days, CAST(sum(view_count) AS BIGINT) AS silver_views
  FROM ({SILVER_EVENTS}) GROUP BY region, video_id),
b AS (
  SELECT upper(event_type) AS region, CAST(user_id AS VARCHAR) AS video_id,
    count(DISTINCT CAST(ts AS DATE)) AS raw_days, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS raw_views
  FROM events GROUP BY 1, 2)
SELECT b.region, b.video_id, raw_days, raw_views, silver_days, silver_views
FROM b LEFT JOIN a ON a.region = b.region AND a.video_id = b.video_id
"""
