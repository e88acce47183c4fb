"""Query of the Merkle manifest (op13), and its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlathe.llm import merkle
from textlathe.llm.common import table

LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def manifest_report(docs: DataFrame) -> DataFrame:
    """Proof of every row, and whether it still verifies after line feeds were
    deleted from the texts of rows whose id has an even CRC-32 (a null id is
    left alone)."""
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    cut = F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))
    cut = F.coalesce(F.concat(F.octet_length(cut).cast("string"), F.lit(":"), cut), F.lit("-"))
    m = merkle.manifest(docs, merkle.leaf_digest(LEAF), group="source", key="doc_id",
                        carry={"doc_id": F.col("doc_id"), "tampered": F.when(even, merkle.leaf_digest(LEAF, text=cut))})
    one = F.struct("doc_id", "siblings", "path", *[merkle.hex_text(c).alias(c) for c in ("leaf", "subroot", "root")],
                   merkle.hex_text(F.coalesce("tampered", "leaf")).alias("now"))
    m = m.select(F.inline(F.array(one)))  # a generator keeps fold() from evaluating these again a level
    return (m.withColumn("folded_root", merkle.fold("now", "siblings", "path"))
            .select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.hex_text("siblings"), 256).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proof of every document, checked against tampered texts."""
    return manifest_report(table(spark, sf_dir, "documents"))


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE concat(octet_length(encode({x}::VARCHAR)), ':', {x}::VARCHAR) END"


def _leaf(text: str) -> str:
    return f"sha256(concat({', '.join(_field(c) for c in (*LEAF[:-1], text))}))"


# Trees level by level; every leaf then climbs twice, with the original digest
# and with the tampered one. CRC-32 by its published polynomial.
OP13_SQL = f"""
WITH RECURSIVE tbl AS (
  SELECT list_transform(list_transform(range(256), lambda i: i::UBIGINT), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, i)) AS t
), d AS (
  SELECT *, coalesce('s' || source, 'n') AS g, replace(text, chr(10), '') AS cut, {_leaf('text')} AS leaf,
    list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
      lambda a, x: xor(a >> 8, t[(xor(a, x) % 256 + 1)::BIGINT]), 4294967295::UBIGINT) AS crc FROM documents, tbl
), l AS (
  SELECT doc_id, g, leaf, CASE WHEN xor(crc, 4294967295::UBIGINT) % 2 = 0 THEN {_leaf('cut')} ELSE leaf END AS now,
         row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d
), n AS (
  SELECT g, 0 AS lvl, pos, leaf AS h FROM l
  UNION ALL
  SELECT g, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS many FROM n) WHERE many > 1 GROUP BY g, lvl, pos // 3
), sub AS (
  SELECT g, arg_max(h, lvl) AS h, max(lvl) AS lvl FROM n GROUP BY g
), u AS (
  SELECT 0 AS lvl, row_number() OVER (ORDER BY g) - 1 AS pos, h FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS many FROM u) WHERE many > 1 GROUP BY lvl, pos // 3
), root AS (
  SELECT arg_max(h, lvl) AS root, max(lvl) AS top FROM u
), a AS (
  SELECT g, lvl, pos, h FROM n UNION ALL SELECT '', lvl, pos, h FROM u
), s AS (
  SELECT g, lvl, pos, coalesce(string_agg(h, '') OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER (b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM a WINDOW b AS (PARTITION BY g, lvl, pos // 3 ORDER BY pos)
), place AS (
  SELECT sub.g, sub.h AS subroot, sub.lvl AS high, row_number() OVER (ORDER BY sub.g) - 1 AS pos FROM sub
), climb AS (
  SELECT doc_id, leaf, l.g AS home, l.g, 0 AS lvl, l.pos, '' AS proof, now AS h FROM l
  UNION ALL
  SELECT c.doc_id, c.leaf, c.home, CASE WHEN c.g <> '' AND c.lvl = p.high THEN '' ELSE c.g END,
         CASE WHEN c.g <> '' AND c.lvl = p.high THEN 0 ELSE c.lvl + 1 END,
         CASE WHEN c.g <> '' AND c.lvl = p.high THEN p.pos ELSE c.pos // 3 END,
         CASE WHEN c.g <> '' AND c.lvl = p.high THEN c.proof ELSE c.proof || s.before || s.after END,
         CASE WHEN c.g <> '' AND c.lvl = p.high THEN c.h ELSE sha256(s.before || c.h || s.after) END
  FROM climb c JOIN place p ON p.g = c.home JOIN s ON s.g = c.g AND s.lvl = c.lvl AND s.pos = c.pos, root
  WHERE c.g <> '' OR c.lvl < root.top
)
SELECT c.doc_id, c.leaf, p.subroot, root.root, sha256(c.proof) AS proof_sha256, c.h AS folded_root,
       c.h = root.root AS verified
FROM climb c JOIN place p ON p.g = c.home, root WHERE c.g = '' AND c.lvl = root.top
"""

QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}
ORACLE = {"op13_merkle_manifest": OP13_SQL}
