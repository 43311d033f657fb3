"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import chat_repair, decontam, langid, lm_scoring, mixing, near_dup, quality_rank, quality_rules, revisits, sharding, spelling, token_count, vector_dup
from shelfmark.session import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(_table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.pseudo_likelihood(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), token_count.read_vocabulary())


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rank.quality_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_digest(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.revisit_digest(_table(spark, sf_dir, "pages"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair_digest(_table(spark, sf_dir, "conversations"))


def op13_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dup.vector_duplicates(_table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_sharding, op2_lm_scoring, op3_token_counts, op4_mixing, op5_quality_rules,
            op6_quality_classifier, op7_language, op8_decontamination, op9_revisits, op10_near_duplicates,
            op11_spelling_variants, op12_conversation_repair, op13_vector_duplicates,
        )
    }


NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
edges AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT e.v, r.root FROM reach r JOIN edges e ON e.u = r.node)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.root AS component_id, d.doc_id = c.root AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) c ON c.node = d.doc_id
"""

MIXING_SQL = r"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '\N')), 1, 15) AS BIGINT) AS mark
  FROM documents),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY mark, doc_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM rows_),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM rows_ GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(place % 3 + 1)::INT] AS weight FROM per),
ratios AS (SELECT *, 3.0::DOUBLE * source_size / weight AS ratio FROM weighed),
levels AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER w, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM ratios WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first_free AS (SELECT level FROM levels WHERE ratio > level ORDER BY ratio, place LIMIT 1),
targets AS (
  SELECT source, place, source_size,
         coalesce(CASE WHEN ratio > level THEN weight * (SELECT level FROM first_free) ELSE 3.0::DOUBLE * source_size END, 0.0) AS target
  FROM levels),
cuts AS (SELECT place, source_size, target, greatest(ceil(source_size / 64.0), least(source_size, 32))::BIGINT AS n FROM targets WHERE source_size > 0),
slots AS (SELECT *, least(3 * n, floor(target * n / source_size + 0.5))::BIGINT AS slots FROM cuts),
labels AS (SELECT *, (sum(slots) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - slots)::BIGINT AS low,
                  (sum(slots) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS high FROM slots),
labelled AS (SELECT place, unnest(range(low, high)) AS label FROM labels),
marked AS (SELECT *, CAST('0x' || substr(md5('draw|0|' || label), 1, 15) AS BIGINT) AS mark FROM labelled),
drawn AS (SELECT place, (row_number() OVER (ORDER BY mark, label) - 1) // 1024 AS shard FROM marked),
numbered AS (SELECT place, shard, row_number() OVER (PARTITION BY place ORDER BY shard) - 1 AS k FROM drawn),
sized AS (SELECT place, n, slots FROM labels WHERE slots > 0),
indexed AS (SELECT place, n, slots, pass, unnest(range(0, n)) AS index FROM (SELECT *, unnest(range(0, 3)) AS pass FROM sized)),
keyed AS (SELECT *, CAST('0x' || substr(md5('block|' || place || '|' || pass || '|' || index), 1, 15) AS BIGINT) AS mark FROM indexed),
ordered AS (
  SELECT place, index, pass * n + row_number() OVER (PARTITION BY place, pass ORDER BY mark, index) - 1 AS k FROM keyed),
times AS (SELECT o.place, o.index, count(*) AS times FROM ordered o JOIN numbered s ON s.place = o.place AND s.k = o.k GROUP BY ALL),
spans AS (  -- the words of each block: the first source_size % n blocks have one more
  SELECT place, index, index * (source_size // n) + least(index, source_size % n) AS low, (index + 1) * (source_size // n) + least(index + 1, source_size % n) AS high
  FROM (SELECT *, unnest(range(0, n)) AS index FROM cuts)),
blocks AS (
  SELECT p.doc_id, s.place, b.index, least(p.start + p.size, b.high) - greatest(p.start, b.low) AS words
  FROM placed p JOIN targets s ON s.source IS NOT DISTINCT FROM p.source
  JOIN spans b ON b.place = s.place AND b.low < p.start + p.size AND b.high > p.start WHERE p.size > 0),
taken AS (
  SELECT b.doc_id, sum(b.words * t.times)::BIGINT AS taken
  FROM blocks b JOIN times t ON t.place = b.place AND t.index = b.index GROUP BY b.doc_id)
SELECT p.doc_id, p.size::BIGINT AS size, s.source_size, s.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM placed p JOIN targets s ON s.source IS NOT DISTINCT FROM p.source LEFT JOIN taken t ON t.doc_id = p.doc_id
"""

REVISITS_SQL = r"""
WITH p AS (
  SELECT page_id, url, html, 1700000000 + page_id * 600 AS t0, '"' || substr(md5(html), 1, 16) || '"' AS tag, sha1(html) AS digest FROM pages),
canon AS (
  SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS plain FROM p),
named AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(plain, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
            || CASE WHEN regexp_extract(plain, '^[^/?]*([^?]*)', 1) = '' THEN '/' ELSE regexp_extract(plain, '^[^/?]*([^?]*)', 1) END AS base,
         list_sort(list_filter(string_split(regexp_extract(plain, '\?(.*)$', 1), '&'),
                               lambda x: x <> '' AND NOT regexp_matches(x, '^(ref|utm_[a-z]+)='))) AS q
  FROM canon),
full_ AS (
  SELECT *, base || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS canonical_url FROM named),
again AS (
  SELECT *, (page_id + n) % 7 AS c,
         CASE WHEN (page_id + n) % 7 = 6 THEN t0 - n * 60 ELSE t0 + n * (86400 - 977) + 1 END AS ts
  FROM (SELECT *, unnest([1, 2, 3]) AS n FROM full_)),
joined AS (
  SELECT 'again-' || a.page_id || '-' || a.n AS record_id, a.canonical_url, a.ts, a.n, a.c, a.tag, a.t0, a.digest,
         f.page_id AS f_id, f.tag AS f_tag, f.t0 AS f_t0, f.digest AS f_digest, f.html AS f_html,
         row_number() OVER (PARTITION BY a.page_id, a.n ORDER BY f.t0 DESC NULLS LAST, 'full-' || f.page_id DESC) AS rn
  FROM again a LEFT JOIN full_ f ON f.canonical_url = a.canonical_url AND f.t0 < a.ts),
checked AS (
  SELECT *, CASE WHEN f_id IS NULL THEN 'no_earlier_response' WHEN c = 3 THEN 'no_validator'
                 WHEN c = 0 THEN 'validator_mismatch' WHEN c = 1 AND t0 = f_t0 THEN 'resolved'
                 WHEN c = 2 AND digest = f_digest THEN 'resolved' WHEN c IN (4, 5, 6) AND tag = f_tag THEN 'resolved'
                 ELSE 'validator_mismatch' END AS status
  FROM joined WHERE rn = 1)
SELECT record_id, canonical_url, ts, 'full-' || f_id AS response_id, status,
       CASE WHEN status = 'resolved' THEN 'cache-control: max-age=' || n * 10 || '; content-type: text/html; date: '
            || strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S') || '; etag: ' || f_tag END AS headers,
       CASE WHEN status = 'resolved' THEN length(f_html) END AS payload_chars, CASE WHEN status = 'resolved' THEN md5(f_html) END AS payload_md5
FROM checked
"""


VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, e FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
reach AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION
  SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.node)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, c.root AS component_id, e.vec_id = c.root AS kept
FROM embeddings e LEFT JOIN (SELECT u, count(*) AS n FROM links GROUP BY u) k ON k.u = e.vec_id
JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) c ON c.node = e.vec_id
"""

#: The CRC-32 table is made by its rule; the bytes are those of code points below 0x800.
_CRC_TABLE = str([zlib.crc32(bytes([i ^ 0xFF])) ^ 0xFF000000 for i in range(256)])
SPELLING_SQL = r"""
WITH RECURSIVE crc AS (SELECT CRC_TABLE::BIGINT[] AS t),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{6,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
per AS (SELECT doc_id, run, count(*) AS k FROM runs GROUP BY ALL),
bytes AS (
  SELECT *, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [(192 + ord(c) // 64)::BIGINT, (128 + ord(c) % 64)::BIGINT] END)) AS b FROM per),
hashed AS (
  SELECT doc_id, run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(t[xor(c, x) % 256 + 1], c // 256)), 4294967295::BIGINT) AS h FROM bytes, crc),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
  GROUP BY word HAVING sum(k) >= 5 AND length(word) >= 6),
gone AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word)))::INT AS i FROM words)),
near AS (
  SELECT a.word AS a, b.word AS b, b.n FROM gone a JOIN gone b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN gone b ON b.rest = a.word
  UNION SELECT b.word, a.word, a.n FROM words a JOIN gone b ON b.rest = a.word),
best AS (SELECT a, count(*) AS n_near, min(struct_pack(less := -n, b := b)) AS x FROM near GROUP BY a),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -x.less >= 5 * w.n THEN x.b END AS form, CASE WHEN -x.less >= 5 * w.n THEN -x.less END AS form_n
  FROM words w LEFT JOIN best ON best.a = w.word),
way AS (
  SELECT word, form AS root FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT way.word, f.form FROM way JOIN formed f ON f.word = way.root WHERE f.form IS NOT NULL),
ends AS (SELECT way.word, way.root FROM way JOIN formed f ON f.word = way.root WHERE f.form IS NULL)
SELECT formed.word, form, coalesce(root, formed.word) AS root, n, n_near, form_n FROM formed LEFT JOIN ends ON ends.word = formed.word
""".replace("CRC_TABLE", _CRC_TABLE)


def oracle_sql() -> dict[str, str]:
    return {
        "op4_mixing": MIXING_SQL, "op9_revisits": REVISITS_SQL, "op10_near_duplicates": NEAR_DUPLICATES_SQL,
        "op11_spelling_variants": SPELLING_SQL, "op13_vector_duplicates": VECTORS_SQL,
    }
