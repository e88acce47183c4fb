"""Queries op2, op5 and op6 with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlathe.llm import mixing, shards, url_filter
from textlathe.llm.common import table

# FIXED VALUES: the rules of the URL query, as (host, path, verdict).
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block"))
N_SHARDS = 16


def op2_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards by jump consistent hash of doc_id."""
    return shards.shard_slots(table(spark, sf_dir, "documents"), n_shards=N_SHARDS)


def op5_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by rules, then by the weighted vocabulary."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules=URL_RULES).drop("url")


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to capped source targets along the curriculum."""
    placed = mixing.curriculum(table(spark, sf_dir, "documents"))
    first = F.try_element_at("positions", F.lit(1))
    order = [F.col("first_position").asc_nulls_last(), F.xxhash64("doc_id", "size")]  # spreads what is not taken
    return (placed.select("doc_id", "size", "source_size", "target",
                          (F.col("size") * F.size("positions")).alias("taken"), first.alias("first_position"))
            .repartitionByRange(*order).sortWithinPartitions(*order))


def _term_sum(terms: tuple[str, ...]) -> str:
    hit = "CASE WHEN regexp_matches(u, '(^|[^a-z0-9]){}($|[^a-z0-9])') THEN 1 ELSE 0 END"
    return " + ".join(hit.format(t) for t in terms)


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP5_SQL = f"""
WITH p AS (
  SELECT page_id, translate(coalesce(url, ''), '{_UP}', '{_LOW}') AS u,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), '{_UP}', '{_LOW}') AS host,
         regexp_extract(regexp_extract(rest, '^[^/?#]*(.*)$', 1, 's'), '^[^?#]*') AS path FROM p
), r AS (
  SELECT *, {_term_sum(url_filter.STRICT_TERMS)} AS n_strict, {_term_sum(url_filter.SOFT_TERMS)} AS n_soft,
    host = 'org' OR host LIKE '%.org' AS in_org, host = 'com' OR host LIKE '%.com' AS in_com,
    host = 'example.org' OR host LIKE '%.example.org' AS in_example FROM h
), m AS (
  SELECT *, CASE WHEN in_example AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                 WHEN in_example AND starts_with(path, '/es/') THEN 'example.org/es/'
                 WHEN in_org AND starts_with(path, '/') THEN 'org/'
                 WHEN in_com AND starts_with(path, '/fr/') THEN 'com/fr/'
                 WHEN in_com AND starts_with(path, '/de/') THEN 'com/de/' END AS rule FROM r
)
SELECT page_id, host, path, rule, n_strict, n_soft,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN n_strict >= 1 OR n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict
FROM m
"""

OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(concat(coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))) AS o FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST)) - 1) % 3 AS cls FROM s
), c AS (
  SELECT *, [5.0, 2.0, 1.0][cls + 1]::DOUBLE AS w, source_size * 3.0::DOUBLE AS cap FROM w
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
  FROM c
), t AS (
  SELECT source, source_size, cls, least(cap, max(lv) OVER () * w) AS target FROM l
), m AS (
  SELECT doc_id, size, source_size, target, cls, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS mid
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 OR mid > target THEN 0
       ELSE size * (1 + (source_size + mid <= target)::INT + (2 * source_size + mid <= target)::INT) END::BIGINT AS taken,
  CASE WHEN size > 0 AND mid <= target THEN
    CASE cls WHEN 0 THEN 2 * (mid / target) / (1.5 + sqrt(2.25 - 2 * (mid / target)))
             WHEN 1 THEN mid / target
             ELSE 2 * (mid / target) / (0.5 + sqrt(0.25 + 2 * (mid / target))) END END AS first_position
FROM m
"""

# CRC-32 by its published polynomial; jump consistent hash by its published
# loop, on 64-bit keys in HUGEINT arithmetic.
OP2_SQL = f"""
WITH RECURSIVE tbl AS (
  SELECT list_transform(list_transform(range(256), lambda i: i::UBIGINT), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, i)) AS t
), b AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS h,
         md5(concat(coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))) AS o,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16))::UBIGINT::HUGEINT AS k FROM documents
), l AS (
  SELECT doc_id, size, o, k, list_transform(range(1, size),
    lambda i: ('0x' || substr(h, 2 * i - 1, 2))::UBIGINT) AS bytes FROM b
), c AS (
  SELECT doc_id, size, o, k, xor(list_reduce(bytes, lambda a, x: xor(a >> 8, t[(xor(a, x) % 256 + 1)::BIGINT]),
    4294967295::UBIGINT), 4294967295::UBIGINT)::BIGINT AS text_crc32 FROM l, tbl
), jump AS (
  SELECT DISTINCT k AS start, n, k, -1::BIGINT AS b, 0::BIGINT AS j FROM c, (VALUES ({N_SHARDS}), ({N_SHARDS + 1})) v(n)
  UNION ALL
  SELECT start, n, k2, j, floor((j + 1) * (2147483648::DOUBLE / (k2 // 8589934592 + 1)::DOUBLE))::BIGINT
  FROM (SELECT start, n, j, (k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS k2
        FROM jump WHERE j < n)
), s AS (
  SELECT start, n, max(b) AS shard FROM jump GROUP BY start, n
)
SELECT doc_id, size, text_crc32, 'key' AS law, a.shard,
       row_number() OVER (PARTITION BY a.shard ORDER BY o, doc_id) - 1 AS slot, g.shard AS grown_shard
FROM c JOIN s a ON a.start = c.k AND a.n = {N_SHARDS} JOIN s g ON g.start = c.k AND g.n = {N_SHARDS + 1}
"""

QUERIES = {"op2_jump_shards": op2_jump_shards, "op5_url_vocabulary": op5_url_vocabulary,
           "op6_curriculum_mix": op6_curriculum_mix}
ORACLE = {"op2_jump_shards": OP2_SQL, "op5_url_vocabulary": OP5_SQL, "op6_curriculum_mix": OP6_SQL}
