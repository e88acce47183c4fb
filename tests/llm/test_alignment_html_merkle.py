"""op11 to op13 against plain restatements, and their edge rows."""

import hashlib
import zlib
from collections import Counter

import public_tokenizers as P
import pytest

from textlathe.llm import align, html_text, merkle, queries_f, queries_g

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, pos int, leaf string"
TEXTS = ["the cat sat on the mat", "", None, "  two  spaces\n\nand\tlines", "<|endoftext|> is plain <s> text</s>",
         "naïve Straße 数学は楽しい 🙂🙂", "a" * 3000, "the cat sat on the mat", "▁ marks fail", "x", " ", "don't we'll",
         "zzxqv " * 400 + "end"]


def documents(spark, texts=TEXTS, sources=("s", None, "", "Ü")):
    rows = [(i, t, "en", sources[i % len(sources)], len(t or ""), "r", i, "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# --- op11 -------------------------------------------------------------------

def plain_alignment(texts):
    """Every token pair of overlapping byte ranges, from the libraries' ids."""
    import sentencepiece
    from tokenizers import Tokenizer
    a_lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    a_bytes = align.ByteLevelTokens(P.path("byte_bpe_50k.json"), P.PATTERN).bytes
    b_lib = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def piece(i):
        t = b_lib.id_to_piece(i)
        return bytes([int(t[3:5], 16)]) if b_lib.is_byte(i) else t.replace("▁", " ").encode()

    done = []
    for t in texts:
        a = a_lib.encode(" " + (t or ""), add_special_tokens=False).ids
        b = b_lib.encode(t or "")
        whole = (" " + (t or "")).encode()
        if not t or b"".join(a_bytes[i] for i in a) != whole or b"".join(piece(i) for i in b) != whole:
            done.append(None)
            continue
        spans, ends = {}, {}
        for name, ids, size in (("a", a, lambda i: len(a_bytes[i])), ("b", b, lambda i: len(piece(i)))):
            at, spans[name] = 0, []
            for i in ids:
                spans[name].append((at, at + size(i), i))
                at += size(i)
            ends[name] = {e for _, e, _ in spans[name]}
        links = [(x[2], y[2]) for x in spans["a"] for y in spans["b"] if x[0] < y[1] and y[0] < x[1]]
        groups, last = [], 0
        for e in sorted(ends["a"] & ends["b"]):
            groups.append("|".join(",".join(str(i) for s, f, i in spans[n] if last <= s and f <= e) for n in "ab"))
            last = e
        done.append((len(a), len(b), groups, links))
    counts = Counter(p for d in done if d for p in set(d[3]))
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (d[0], d[1], len(d[2]), len(d[3]), sum(counts[p] == top[p[0]] for p in d[3]), sum(counts[p] for p in d[3]),
             hashlib.sha256(";".join(d[2]).encode()).hexdigest()) for d in done]


def test_alignment_equals_every_overlapping_pair(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries_f.alignment_report(documents(spark)).collect()}
    want = plain_alignment(TEXTS)
    assert [got[i] for i in range(len(TEXTS))] == want
    assert sum(not w[0] for w in want) == 3 and want[0][:4] == want[7][:4]


def test_alignment_of_driver_documents_and_any_memory(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(25)
    texts = [r.text for r in docs.collect()]
    got = sorted(tuple(r) for r in queries_f.alignment_report(docs).collect())
    assert [g[1:] for g in got] == plain_alignment(texts)
    a, b = align.ByteLevelTokens(P.path("byte_bpe_50k.json"), P.PATTERN), align.PieceTokens(P.path("piece_bpe_32k.model"))
    runs = [[(*x[:4], x[4].tolist()) for x in align.Aligner(a, b, n).texts(texts)] for n in (0, 50, 10_000)]
    assert runs[0] == runs[1] == runs[2]
    whole = align.Aligner(a, b)
    whole._cuts = lambda x, y: tuple(align.np.array([len(i)]) for i in (x, y))  # one window a text
    assert [(*x[:4], x[4].tolist()) for x in whole.texts(texts)] == runs[0]


def test_alignment_counts_join_alike_by_broadcast_and_shuffle(spark, monkeypatch):
    docs = documents(spark)
    one = sorted(map(tuple, queries_f.alignment_report(docs).collect()))
    monkeypatch.setattr(align, "MAX_PAIRS", 0)
    assert sorted(map(tuple, queries_f.alignment_report(docs).collect())) == one


def test_alignment_of_empty_table_null_and_repeated_keys(spark):
    assert queries_f.alignment_report(documents(spark, [])).collect() == []
    rows = spark.createDataFrame([(None, "the cat"), (1, "the cat"), (1, "the cat")], "doc_id long, text string")
    got = queries_f.alignment_report(rows).collect()
    assert len(got) == 3 and {tuple(r)[1:] for r in got} == {tuple(got[0])[1:]} and got[0].count_sum == 3 * got[0].n_links


# --- op12 -------------------------------------------------------------------

PAGES = {
    "<html><body><header><h1>Site</h1></header><div id='main'><h1>Title</h1><p>First paragraph, long enough to count.</p>"
    "<p>Ok.</p><ul><li>one</li><li>two</li></ul></div><div class='user-comments'><p>I think, really, that this is a very "
    "long comment. And more, and more.</p></div><aside>Side</aside><form><p>Your mail, please.</p></form></body></html>":
        "Title First paragraph, long enough to count. Ok. one two",
    "<body class='has-sidebar'><div class='page-header nav-layout'><article><header><h1>T</h1></header><p>A&lt;b&gt; &amp;c; "
    "x&nbsp;y <br>z.</p><div class='ad'>Buy, now.</div></article></div><footer>f</footer>": "T A<b> &c; x y z.",
    "<h1>Head</h1><p>Some text here, and here. Again, so it is long.<p>More text follows here, long as well.<p>Third: of "
    "text, with marks.<div class='share'>Share it</div>":
        "Head Some text here, and here. Again, so it is long. More text follows here, long as well. Third: of text, with marks.",
    "<article>foo<b>bar</b> <span class='ad'>Ad!</span>baz</article>": "foobar baz",
    "<article><p>A.</p><script>if (a<b) '</p>'</script><p>B.</p><!-- c > d --><p>C</article>": "A. B. C",
    "<article><p>A</p><article class='comment'><p>Much longer text of a reader, who writes, and writes.</p></article></article>": "A",
    "<article><p><b>A\n<br> a<p>B</b> b</article><footer>&copy; x": "A a B b",
    "<nav><a href=/x>x</a></nav>": "", "plain text, without a tag": "plain text, without a tag", "": "", None: "",
    "<title>t</title><div class=cookie-notice>We use cookies, as all do.</div><main><p>Text.</p></main>": "Text.",
    "<article><p class=\"x>One.</p><p>Two</p>": "One. Two",  # a quote without an end
}


@pytest.mark.parametrize("html", PAGES)
def test_main_text_of_a_page(html):
    assert html_text.main_text(html) == PAGES[html]


def test_article_of_driver_pages_is_whole(spark):
    import re
    from html import unescape
    got = {r.page_id: r for r in queries_f.op12_main_text(spark, "/root/testdata/sf0.01").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        inside = re.search("<article>(.*?)</article>", p.html, re.S).group(1)
        inside = re.sub("<br>", " ", re.sub("</?b>", "", inside))
        blocks = [" ".join(unescape(b).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert got[p.page_id].text == " ".join(b for b in blocks if b)
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def test_pages_of_any_shape_in_bounded_time_and_clashing_names(spark):
    for odd in ("<div>" * 30000 + "x" + "</i>" * 30000, "<p" * 50000, "<!--" * 30000, "&" * 100000, "<a \"" * 30000,
                "<ul>" * 500 + "<li>" * 500, "\x00</p></p><", "<p>" + "x, " * 200000):
        html_text.main_text(odd)
    rows = spark.createDataFrame([(None, None, "<p>a", "t", 1), (1, "u", None, "t", 1), (1, "u", None, "t", 1)],
                                 "page_id long, url string, html string, text string, c0 int")
    got = html_text.extract(rows, carry=["url"])
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "u", "", 0), (1, "u", "", 0), (None, None, "a", 1)]
    assert html_text.extract(rows.limit(0)).collect() == []


# --- op13 -------------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """Root, and per leaf its (place in run, siblings) level by level."""
    proofs, level = [[] for _ in leaves], [(h, [i]) for i, h in enumerate(leaves)]
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for run in runs:
            for k, (_, below) in enumerate(run):
                for i in below:
                    proofs[i].append((k, [h for j, (h, _) in enumerate(run) if j != k]))
        level = [(H(*[h for h, _ in run]), [i for _, below in run for i in below]) for run in runs]
    return level[0][0], proofs


def plain_manifest(rows):
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        mine = sorted((r for r in rows if r.source == s), key=lambda r: r.doc_id)
        leaves = [H(*[field(r[c]) for c in queries_g.LEAF]) for r in mine]
        trees.append((mine, leaves, *tree(leaves)))
    root, upper = tree([t[2] for t in trees])
    out = {}
    for (mine, leaves, subroot, proofs), more in zip(trees, upper):
        for r, leaf, proof in zip(mine, leaves, proofs):
            proof, text = proof + more, r.text
            if text is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h = H(*[field(text if c == "text" else r[c]) for c in queries_g.LEAF])
            for k, siblings in proof:
                h = H(*siblings[:k], h, *siblings[k:])
            out[r.doc_id] = (leaf, subroot, root, H(*[x for _, s in proof for x in s]), h, h == root)
    return out


@pytest.mark.parametrize("n, sources", [(1, ("s",)), (13, ("s", None, "", "Ü")), (40, tuple("abcdefghijk"))])
def test_manifest_equals_plain_trees(spark, n, sources):
    docs = documents(spark, [TEXTS[i % len(TEXTS)] for i in range(n)], sources)
    got = {r.doc_id: tuple(r)[1:] for r in queries_g.manifest_report(docs).collect()}
    assert got == plain_manifest(docs.collect())


def test_manifest_of_nulls_repeats_and_no_rows(spark):
    assert queries_g.manifest_report(documents(spark, [])).collect() == []
    rows = spark.createDataFrame([(None, None, None, None, None), (1, "a\nb", "x", "s", 3), (1, "a\nb", "x", "s", 3),
                                  (2, None, None, "s", None)], "doc_id long, text string, lang string, source string, n_chars long")
    got = queries_g.manifest_report(rows).collect()
    assert len(got) == 4 and len({r.root for r in got}) == 1 and len({r.proof_sha256 for r in got if r.doc_id == 1}) == 1
    changed = zlib.crc32(b"1") % 2 == 0
    assert all(r.verified == (not changed if r.doc_id == 1 else True) for r in got)


def test_proofs_join_alike_by_broadcast_and_shuffle_and_arity(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    leaf = merkle.leaf_digest(queries_g.LEAF)

    def run(arity):
        from pyspark.sql import functions as F
        m = merkle.manifest(docs, leaf, group="source", key="doc_id", carry={"doc_id": F.col("doc_id")}, arity=arity)
        m = m.select("doc_id", "siblings", "path", merkle.hex_text("leaf").alias("leaf"), merkle.hex_text("root").alias("root"))
        return m.select("doc_id", "root", merkle.fold("leaf", "siblings", "path").alias("up")).collect()

    one = sorted(run(3))
    assert len(one) == 200 and all(r.root == r.up for r in one)
    assert all(r.root == r.up for r in run(2))
    monkeypatch.setattr(merkle, "SMALL_LEVEL", 0)
    monkeypatch.setattr(merkle, "bounded_broadcast", lambda df, n, most: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(run(3)) == one
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
