import os

from pyspark.sql import functions as F

from textlathe.operators import evaluation as EV
from textlathe.sources import readers


def test_roc_auc_with_ties_matches_pairs(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (1, 0.5), (0, 0.5), (0, 0.7)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = EV.roc_auc(df).first()[0]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    exp = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - exp) < 1e-12


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    m = EV.classification_metrics(df).first()
    assert m.accuracy == 1.0 and m.precision == 0.0 and m.recall == 0.0 and m.f1 == 0.0


def test_csv_encoding_ladder(spark, tmpdir_path):
    os.makedirs(tmpdir_path + "/a")
    os.makedirs(tmpdir_path + "/b")
    with open(tmpdir_path + "/a/u.csv", "w", encoding="utf-8") as f:
        f.write('text,sentiment\n"Grüße\nzwei Zeilen",1\nNA,0\n')
    with open(tmpdir_path + "/b/l.csv", "w", encoding="iso-8859-1") as f:
        f.write("text,sentiment\ncafé crème,0\n")
    enc = {os.path.basename(r.file_path): r.encoding for r in readers.detect_encoding(spark, tmpdir_path + "/*/*.csv").collect()}
    assert enc == {"u.csv": "UTF-8", "l.csv": "ISO-8859-1"}
    df = readers.scan_csv(spark, [tmpdir_path + "/a", tmpdir_path + "/b"], "text string, sentiment string")
    got = sorted(((r.text, r.sentiment) for r in df.collect()), key=str)
    assert got == sorted([("Grüße\nzwei Zeilen", "1"), (None, "0"), ("café crème", "0")], key=str)


def test_json_column_form(spark, tmpdir_path):
    with open(tmpdir_path + "/c.json", "w") as f:
        f.write('{"text": ["a", "b", "c"], "sentiment": [1, 0, 1]}')
    df = readers.scan_json_columns(spark, tmpdir_path + "/c.json", ["text", "sentiment"], "text string, sentiment int")
    assert sorted(map(tuple, df.collect())) == [("a", 1), ("b", 0), ("c", 1)]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["term", "score"] and 0 < len(rows) <= 50


def test_csv_encodings_and_odd_paths(spark, tmpdir_path):
    from textlathe.sources import readers
    text = 'text,sentiment\n"café, ""quoted""\nline two",pos\nplain,neg\n'
    for name, encoding in (("u 8+x%41.csv", "utf-8"), ("latin.csv", "latin-1"), ("u16.csv", "utf-16")):
        with open(f"{tmpdir_path}/{name}", "wb") as f:
            f.write(text.encode(encoding))
    found = {r.file_path.rsplit("/", 1)[1]: r.encoding for r in readers.detect_encoding(spark, tmpdir_path).collect()}
    assert sorted(found.values()) == ["ISO-8859-1", "UTF-16", "UTF-8"]
    rows = readers.scan_csv(spark, tmpdir_path, "text string, sentiment string").collect()
    assert sorted((r.text, r.sentiment) for r in rows) == sorted([('café, "quoted"\nline two', "pos"), ("plain", "neg")] * 3)


def test_csv_input_keeps_null_languages_and_other_characters(spark, tmpdir_path):
    import hashlib
    from textlathe.plans.catalog import QUERIES
    rows = [(1, "de", "s", "Stra\u00dfe"), (2, "fr", "s", "5 \u20ac \u2013 \u201cquoted\u201d \U0001f600"),
            (3, None, "s", "no language \u00e9"), (4, "en", "s", "caf\u00e9"), (5, "de", "\u0142", "plain")]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").write.parquet(
        f"{tmpdir_path}/documents.parquet")
    got = QUERIES["scan_csv"](spark, tmpdir_path).collect()
    assert sorted((r.doc_id, r.lang, r.source, r.text_md5) for r in got) == [
        (i, lang, source, hashlib.md5(text.encode()).hexdigest()) for i, lang, source, text in rows]
    found = QUERIES["detect_encoding"](spark, tmpdir_path).collect()
    assert {(r.folder, r.encoding) for r in found} >= {("latin1", "ISO-8859-1"), ("utf8", "UTF-8")}


def test_quoted_csv_is_read_in_splits_like_the_whole_reader(spark, tmpdir_path):
    from textlathe.sources.readers import scan_csv, scan_csv_split
    body = 'id,text\n'
    for i in range(400):
        body += f'{i},"line one of {i}\nsays ""{"x" * (i % 37)}"", then\r\n\n{"" if i % 5 else "word " * 90}"\n' if i % 3 else f'{i},plain {i}\n'
    body += '400,NA\n401,"last, ""open"" end"'
    for k, ending in enumerate(("\n", "\r\n")):
        for name, text in (("a", body), ("b", 'id,text\n7,"only\none"\n'), ("c", "id,text\n"), ("d", "")):
            with open(f"{tmpdir_path}/{name}{k}.csv", "wb") as f:
                f.write((text if k == 0 else text.replace("\r\n", "\n").replace("\n", ending)).encode())
    schema = "id bigint, text string"
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for k in (0, 1):
            files = [f"{tmpdir_path}/{n}{k}.csv" for n in "abcd"]
            got = scan_csv_split(spark, files, schema)
            assert spark.read.text(files[0]).rdd.getNumPartitions() > 10
            rows = sorted(map(tuple, got.collect()), key=str)
            assert len(rows) == 403
            want = sorted(map(tuple, scan_csv(spark, files[:3], schema).collect()), key=str)
            assert rows == want
            assert (400, None) in rows and (401, 'last, "open" end') in rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
