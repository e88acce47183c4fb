"""Scans (A1-A5, A15).

* JSON in record form (splittable with ``multiLine`` off, one record per
  line; ``multiLine`` on for a top-level array) or column form (one object of
  equal-length arrays, zipped back into rows).
* CSV with an encoding ladder: each file's encoding is detected from its
  bytes (valid UTF-8 or ISO-8859-1), files are read in one scan per encoding
  group and unioned. Detection reads files line-split, so it is splittable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import constants as K

TEXT_LABEL_SCHEMA = "text string, sentiment string"


def scan_json(spark: SparkSession, paths, schema: str | None = None, multiline: bool = False) -> DataFrame:
    """A1, record form: one JSON object per row."""
    r = spark.read.option("multiLine", multiline)
    if schema:
        r = r.schema(schema)
    return r.json(paths)


def scan_json_columns(spark: SparkSession, paths, columns: list[str], schema: str,
                      multiline: bool = True) -> DataFrame:
    """A1, column form: ``{"col": [..], ...}`` objects (a whole file, or one
    per line with ``multiline=False``); arrays are zipped back into rows.
    ``schema`` is the per-row schema."""
    arr = ", ".join(f"{c} array<{t}>" for c, t in (x.strip().split(" ", 1) for x in schema.split(",")))
    raw = spark.read.option("multiLine", multiline).schema(arr).json(paths)
    return raw.select(F.inline(F.arrays_zip(*[F.col(c) for c in columns])))


def detect_encoding(spark: SparkSession, paths) -> DataFrame:
    """A4: (file_path, encoding). UTF-16 when the file starts with a UTF-16
    byte-order mark, else UTF-8 when every line is valid UTF-8, else ISO-8859-1
    (every byte sequence is valid Latin-1). The scan is line-split; the mark is
    looked for in the part that starts the file."""
    t = spark.read.format("text").load(paths).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("_start"))
    mark = F.substring(F.col("value").cast("binary"), 1, 2)
    at_start = (F.col("_start") == 0) & mark.isin(F.lit(bytes([255, 254])), F.lit(bytes([254, 255])))
    return (t.groupBy("file_path").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
                                       F.bool_or(at_start).alias("utf16"))
             .select("file_path", F.when(F.col("utf16"), F.lit("UTF-16")).when(F.col("utf8"), F.lit("UTF-8"))
                     .otherwise(F.lit("ISO-8859-1")).alias("encoding")))


def scan_csv(spark: SparkSession, paths, schema: str | None = None, header: bool = True,
             null_tokens: bool = True, multiline: bool = True) -> DataFrame:
    """A2/A3: CSV with per-file encoding. ``multiline`` allows quoted line
    breaks, and then a file is read by one task; without it UTF-8 files are
    split over tasks (:func:`scan_csv_split` does both). Only the per-file encoding list (one row per file)
    reaches the driver."""
    enc = detect_encoding(spark, paths).select(
        "encoding", F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B"))).alias("file_path")).collect()
    groups: dict[str, list[str]] = {}
    for r in enc:
        groups.setdefault(r["encoding"], []).append(r["file_path"])
    parts = []
    for e, files in sorted(groups.items()):
        rd = (spark.read.option("header", header).option("escape", '"').option("encoding", e)
              .option("multiLine", multiline or e == "UTF-16"))
        rd = rd.schema(schema) if schema else rd.option("inferSchema", False)
        parts.append(rd.csv(files))
    if not parts:
        raise ValueError("no input files")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if null_tokens:
        from ..operators.cleaning import normalize_nulls
        out = normalize_nulls(out)
    return out


def scan_csv_split(spark: SparkSession, paths, schema: str, header: bool = True, null_tokens: bool = True,
                   encoding: str = "UTF-8") -> DataFrame:
    """A2 for large files with quoted line breaks: one file is read by many
    tasks. Files follow RFC 4180 (a quote stands only around a field or doubled
    inside one; lines end in LF or CRLF) in UTF-8 or a one-byte ``encoding``.

    A physical line starts a record when the quotes before it in its file are
    even in number. Splits are counted first (one row a split), which gives
    every split its number of quotes before; inside a split a running sum does
    the rest. Records of one line are parsed where they stand; lines of longer
    records are grouped by (file, first line), also across splits. Fields that do
    not fit ``schema`` are null, like in the plain reader. A file whose quotes
    are odd in number ends inside a field: its last record runs to the end."""
    raw = spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_at"))
    if encoding.upper() not in ("UTF-8", "UTF8"):
        raw = raw.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))
    lines = raw.withColumn("_q", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    where = ["_file", "_split"]
    # text files are cut by the same sizes in every job, so splits agree
    totals = lines.groupBy(*where).agg(F.sum("_q").alias("_t"), F.min_by(F.endswith("value", F.lit("\r")), "_at").alias("_r"))
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    # the first line's end is the file's; CRLF becomes LF inside fields too
    crlf = F.first("_r").over(Window.partitionBy("_file").orderBy("_split"))
    carry = totals.select(*where, F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_c"), crlf.alias("_r"))
    inside = Window.partitionBy(*where).orderBy("_at")
    before = F.coalesce(F.sum("_q").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumn("_b", before).join(carry, where).withColumn("_b", F.col("_b") + F.col("_c")).drop("_c")
    lines = lines.withColumn("value", F.when(F.col("_r"), F.regexp_replace("value", r"\r\z", "")).otherwise(F.col("value")))
    starts, whole = F.col("_b") % 2 == 0, F.col("_q") % 2 == 0
    first_line = (F.col("_split") == 0) & (F.row_number().over(inside) == 1)
    lines = lines.withColumn("_first", first_line)
    single = lines.where(starts & whole).select("value", "_first")
    # an odd line opens or closes a long record: the quotes before it tell which,
    # and the records opened so far in the file number them
    long = lines.where(~(starts & whole))
    opened = F.when(starts, 1).otherwise(0)
    sums = long.groupBy(*where).agg(F.sum(opened).alias("_t"))
    base = sums.select(*where, F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_c"))
    number = F.sum(opened).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    long = long.withColumn("_n", number).join(base, where).withColumn("_n", F.col("_n") + F.col("_c"))
    joined = long.groupBy("_file", "_n").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_split", "_at", "value"))),
                                 lambda x: x["value"]), "\n").alias("value"),
        F.bool_or("_first").alias("_first")).select("value", "_first")
    records = single.unionByName(joined)
    if header:
        records = records.where(~F.col("_first"))
    records = records.where(F.col("value") != "")
    out = records.select(F.from_csv("value", F.lit(schema), {"escape": '"', "multiLine": "true"}).alias("_r")).select("_r.*")
    if null_tokens:
        from ..operators.cleaning import normalize_nulls
        out = normalize_nulls(out)
    return out


def one_value_a_line(spark: SparkSession, path: str) -> bool:
    """Whether the JSON under ``path`` is one value a line, judged by its first
    line that is not blank: whole there, or the start of a longer value. Only
    that verdict reaches the driver."""
    line = spark.read.text(path).where(F.trim("value") != "").limit(1)
    first = line.select(F.try_parse_json("value").isNotNull()).first()
    return first is not None and first[0]


def download_raw(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Dispatch like the reference: names ending ``.csv`` use the CSV ladder,
    everything else is read as JSON records. Files with one value a line are
    read in splits; a value of several lines (an indented array) is read whole,
    a file a task. A folder holds files of one form."""
    if path.lower().rstrip("/").endswith(".csv"):
        return scan_csv(spark, path, schema)
    return scan_json(spark, path, schema, multiline=not one_value_a_line(spark, path))


def sample_data(ids: DataFrame, id_col: str = "id", seed: int = 42) -> DataFrame:
    """Synthetic rows for the given ids: the first hex digit of
    md5("<seed>:<id>") is a coin for the class, the second picks one of the
    eight phrases of that class."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    coin = F.conv(F.substring(digest, 1, 1), 16, 10).cast("int") % 2
    pick = F.conv(F.substring(digest, 2, 1), 16, 10).cast("int") % 8 + 1
    pos = F.array(*[F.lit(t) for t in K.SAMPLE_POSITIVE])
    neg = F.array(*[F.lit(t) for t in K.SAMPLE_NEGATIVE])
    return ids.select(F.col(id_col).alias("id"),
                      F.when(coin == 0, F.element_at(pos, pick)).otherwise(F.element_at(neg, pick)).alias("text"),
                      F.when(coin == 0, F.lit(1)).otherwise(F.lit(0)).alias("sentiment"),
                      F.current_timestamp().alias("created_at"))
