"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from silverline.llm import source_mix as mix

ORACLE: dict[str, str] = {}


def _sainte_lague(src: str, grp: str, item: str, weight: str, seats: str) -> str:
    """Highest-quotient apportionment over ``src``: seat by seat from nothing."""
    return f"""
  SELECT {grp} AS grp, {item} AS item, count(q) FILTER (q IS NOT NULL) AS quota FROM (
    SELECT {grp}, {item}, CASE WHEN row_number() OVER (
        PARTITION BY {grp} ORDER BY quotient DESC NULLS LAST, {item}, k) <= {seats}
      THEN quotient END AS q
    FROM (SELECT {grp}, {item}, {seats}, k, CASE WHEN {weight} > 0 THEN {weight} / (2 * k + 1) END AS quotient
      FROM (SELECT *, unnest(range(CAST(ceil({seats} * {weight} /
              greatest(sum({weight}) OVER (PARTITION BY {grp}), 1e-300)) AS BIGINT) + 3)) AS k FROM {src})))
  GROUP BY ALL"""


def _hash(text: str) -> str:
    return f"CAST(('0x' || substr(md5({text}), 1, 7)) AS BIGINT)"


_B, _S = mix.BLOCK_WORDS, mix.SHARD_WORDS
_SEL = f"""(CASE WHEN whole = 0 THEN 0 ELSE
   CAST(floor((least(x // {_B}, whole) * extra + phase) / whole) - floor(phase / whole) AS BIGINT) * {_B}
   + CASE WHEN x // {_B} < whole THEN (x % {_B}) * CAST(
       floor(((x // {_B} + 1) * extra + phase) / whole) - floor(((x // {_B}) * extra + phase) / whole) AS BIGINT)
     ELSE 0 END END)"""


def _sel(x: str) -> str:
    return _SEL.replace("x //", f"({x}) //").replace("x %", f"({x}) %")


ORACLE["op9_source_mix"] = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
src AS (
  SELECT source, rank, source_size, CAST((rank - 1) % 3 + 1 AS BIGINT) AS w, {mix.MAX_REPEATS} * source_size AS cap
  FROM (SELECT source, sum(size)::BIGINT AS source_size,
      row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM sized GROUP BY source)),
rounds AS (
  SELECT 0 AS n, rank, w, cap, FALSE AS capped,
    CAST(sum(source_size) OVER () AS DOUBLE) / sum(w) OVER () AS level FROM src
  UNION ALL
  SELECT n + 1, rank, w, cap, now_capped,
    (total - coalesce(sum(CASE WHEN now_capped THEN cap END) OVER (), 0))
      / sum(CASE WHEN NOT now_capped THEN w END) OVER ()
  FROM (SELECT *, capped OR level * w > cap AS now_capped, (SELECT sum(source_size) FROM src) AS total
    FROM rounds WHERE n < (SELECT count(*) FROM src))),
src2 AS (
  SELECT s.*, CASE WHEN r.capped OR r.level * r.w > r.cap THEN CAST(r.cap AS DOUBLE) ELSE r.level * r.w END AS target,
    1 AS one FROM src s JOIN rounds r USING (rank) WHERE r.n = (SELECT max(n) FROM rounds)),
house AS (SELECT *, CAST(round(sum(target) OVER () / {_B}) AS BIGINT) AS seats FROM src2),
quotas AS ({_sainte_lague("house", "one", "rank", "target", "seats")}),
placed AS (
  SELECT d.doc_id, d.size, h.rank, h.source_size, h.target, q.quota, coalesce(CAST(d.doc_id AS VARCHAR), '') AS key,
    {_hash(f"'{mix.SEED}:shard:' || coalesce(CAST(d.doc_id AS VARCHAR), '')")}
      % greatest(1, CAST(ceil(h.source_size / {_S}) AS BIGINT)) AS shard
  FROM sized d JOIN house h ON d.source IS NOT DISTINCT FROM h.source JOIN quotas q ON q.item = h.rank),
lengths AS (SELECT rank, shard, sum(size)::BIGINT AS len, any_value(quota) AS quota FROM placed GROUP BY rank, shard),
blocks AS ({_sainte_lague("lengths", "rank", "shard", "len", "quota")}),
passes AS (
  SELECT l.rank, l.shard, l.len, b.quota AS blocks, l.len // {_B} AS whole,
    CASE WHEN l.len > 0 THEN least({mix.MAX_REPEATS}, (b.quota * {_B}) // l.len) ELSE 0 END AS passes
  FROM lengths l JOIN blocks b ON b.grp = l.rank AND b.item = l.shard),
plan AS (
  SELECT *, CASE WHEN passes < {mix.MAX_REPEATS}
      THEN least(whole, CAST(floor((blocks * {_B} - passes * len) / {_B} + 0.5) AS BIGINT)) ELSE 0 END AS extra,
    CASE WHEN whole > 0 THEN {_hash(f"'{mix.SEED}:phase:' || rank || ':' || shard")} % whole ELSE 0 END AS phase
  FROM passes),
laid AS (
  SELECT p.*, l.whole, l.passes, l.extra, l.phase, CAST(coalesce(sum(size) OVER (
      PARTITION BY p.rank, p.shard ORDER BY md5('{mix.SEED}:order:' || key), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a
  FROM placed p JOIN plan l USING (rank, shard))
SELECT doc_id, size, source_size, target,
  CAST(passes * size + {_sel("a + size")} - {_sel("a")} AS BIGINT) AS taken
FROM laid
"""

# Failing sets as bit masks: bit i is the i-th filter of ABCDE.
ORACLE["op11_filter_audit"] = """
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY text) AS first_id FROM docs),
masked AS (
  SELECT doc_id, part,
    (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, FALSE)::INT AS mask
  FROM worded),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
grouped AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM masked LEFT JOIN marks USING (doc_id) GROUP BY part, mask),
letters AS (SELECT unnest(range(5)) AS i),
orders AS (
  SELECT '' AS filter_order, 0 AS used, 0 AS len
  UNION ALL
  SELECT filter_order || chr(CAST(65 + i AS INT)), used + (1 << i), len + 1
  FROM orders, letters WHERE (used >> i) & 1 = 0 AND len < 5),
places AS (
  SELECT o.filter_order, CAST(s.step AS INT) AS step, ascii(o.filter_order[s.step]) - 65 AS f,
    list_sum(list_transform(range(1, s.step), lambda j: 1 << (ascii(o.filter_order[j]) - 65)))  AS before
  FROM (SELECT * FROM orders WHERE len = 5) o, (SELECT unnest(range(1, 6)) AS step) s),
counted AS (
  SELECT g.part, p.filter_order, p.step, p.f,
    sum(n) FILTER (mask & (coalesce(before, 0) | (1 << f)) = 0) AS kept,
    sum(n) FILTER (mask & coalesce(before, 0) = 0 AND (mask >> f) & 1 = 1) AS removed,
    sum(n) FILTER (mask & coalesce(before, 0) <> 0 AND (mask >> f) & 1 = 1) AS redundant,
    sum(n) FILTER (mask = 1 << f) AS unique_fails,
    sum(good) FILTER (mask & coalesce(before, 0) = 0 AND (mask >> f) & 1 = 1) AS good_lost,
    sum(toxic) FILTER (mask & coalesce(before, 0) = 0 AND (mask >> f) & 1 = 1) AS toxic_lost
  FROM grouped g, places p GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM counted
"""

ORACLE["op12_ranked_search"] = """
WITH cut AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
docs AS (SELECT row, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM cut WHERE len(terms) > 0),
total AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM docs),
tfs AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) GROUP BY row, term),
asked AS (
  SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), total),
scored AS (
  SELECT a.item_id, d.row, any_value(d.doc_id) AS doc_id,
    sum(a.q * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + ((75 * d.n * total.nn) // total.l)))))::BIGINT AS score
  FROM asked a JOIN weights w USING (term) JOIN tfs t USING (term) JOIN docs d USING (row), total GROUP BY a.item_id, d.row)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
