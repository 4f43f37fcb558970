"""Text, HTML and helper functions on hand-written rows."""

import functools
import gzip

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import helpers, text


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("&amp;lt;", "<"), ("&#x4e2d;&#20013;", "中中"), ("&sect;", "&sect;"), ("&#x110000;&#xD800;", "��"), ("&LDQUO;a&rdquo;", "“a”"), ("", ""), ("&#38;#65;", "&#65;"),
    ],
)
def test_decode_entities(spark, given, wanted):
    assert one(spark, given, text.decode_entities) == wanted


@pytest.mark.parametrize(
    ("given", "wanted"),
    [("a b", "a b"), ("a\r\nb", "a\n\nb"), ("a \t b", "a b"), ("a\n\n\n\nb", "a\n\nb"), ("　a \n b　", "a\nb"), ("&amp;amp;", "&amp;")],
)
def test_clean_text(spark, given, wanted):
    got = one(spark, given, text.clean_text)
    assert got == wanted
    if "&" not in got:
        assert one(spark, got, text.clean_text) == got


def test_html_to_lines(spark):
    lines = lambda html: one(spark, html, text.html_to_lines)
    assert lines("<ul><li>a<li>b</ul><script>x</p></script><!-- <p>no</p> -->") == ["- a", "- b"]
    assert lines("<p>-</p><p>x</p><p>-</p><p>-</p><p>y</p><p>-</p>") == ["- x", "-", "- y", "-"]
    assert lines(f"<p>a</p><pre>{'b' * 499}</pre>") == ["a", "b" * 499]
    assert lines(f"<p>a</p><pre>{'b' * 501}</pre>") == ["b" * 501]
    assert lines("<p>" * 3000) == []
    assert len(lines("<p>" + "word " * 200_000 + "</p>")) == 1


def test_linked_lines(spark):
    from corpusloom.operators import links

    cases = [
        ('<a href="/p?a=1">t <b>u</b></a><a href="#x">v</a>', ["[t u](https://h.org/p?a=1) v"]), ('x<a href="">t</a><a href="/q"> </a><a href="mailto:m">m</a>y', ["x t m y"]),
        ("<a href='../c?x=1'>up</a> <a href='?y'>q</a> <a href='//k.org/(z)'>p</a>", ["[up](https://h.org/c?x=1) [q](https://h.org/a/b?y) [p](https://k.org/(z%29)"]),
        ('<p>a</p><a href="/local#f">in</a>', ["a", "[in](../x%29.html)"]), ('<a class=k href="/s"/> label here<p>b', ["[label here](https://h.org/s)", "b"]), (None, []), (f"<a href='/s'>t</a><pre>{'b' * 501}</pre>", ["b" * 501]),
    ]
    rows = [(k, [("", html)], "https://h.org/a/b") for k, (html, _) in enumerate(cases)] + [(99, [("", '<a href="/s">t</a><a href="https://k.org">k</a>')], None), (98, None, None)]
    df = spark.createDataFrame(rows, "k int, p array<struct<head:string,html:string>>, url string")
    targets = F.create_map(F.lit("scheme:h.org/local"), F.lit("../x).html"))
    got = {r.k: r.p and r.p[0].lines for r in links.linked_lines(df, "p", F.col("url"), targets).collect()}
    assert got == {k: want for k, (_, want) in enumerate(cases)} | {99: ["t [k](https://k.org/)"], 98: None}


def test_blanks_take_linear_time(spark):
    raw = "a" + " " * 1_000_000 + "b" + " " * 1_000_000
    assert one(spark, raw, text.clean_text) == "a b"
    assert one(spark, raw, text.trim) == raw.rstrip()


def test_help_article(spark):
    def cut(*lines):
        return spark.createDataFrame([(list(lines),)], "l array<string>").select(text.help_article(F.col("l")).alias("y")).first().y

    assert cut("menu", "-", "Title", "X's purpose is to serve the public conversation.", "May 2024", "Share this article", "z") == ["Title", "X's purpose is to serve the public conversation.", "May 2024"]
    assert cut("menu", "Title", "May 2024", "b") == ["Title", "May 2024", "b"]
    assert cut("May 2024", "overview", "b") == ["overview", "b"]
    assert cut("a", "b") == ["a", "b"]


def test_slice_lines(spark):
    def cut(start, end, include=False, skip=None):
        return one(spark, "a\nstart b\nc\n\nend d\ne", lambda c: text.slice_lines(F.split(c, "\n"), F.lit(start), F.lit(end), F.lit(include), F.array(*map(F.lit, skip)) if skip else F.lit(None).cast("array<string>")))

    assert cut("start", "end") == ["start b", "c"]
    assert cut("start", "end", True) == ["start b", "c", "end d"]
    assert cut("none", "") == ["a", "start b", "c", "end d", "e"]
    assert cut("", "start") == ["a"]
    assert cut("", "zzz") == ["a", "start b", "c", "end d", "e"]
    assert cut("end", "start") == ["end d", "e"]
    assert cut("", "", skip=["^C$", "B"]) == ["a", "end d", "e"]


def test_trim_chrome(spark):
    def trim(host):
        return one(spark, "a\nSkip to main content\nTumblr\nTags\nb\nPowered by\nc", lambda c: text.trim_chrome(F.split(c, "\n"), F.lit(host)))

    assert trim("x.org") == ["a", "Tumblr", "Tags", "b"]
    assert trim("discord.com") == ["a", "Tumblr"]
    assert trim("tumblr.com") == ["a", "Tags", "b"]


def test_pdf_lines(spark):
    raw = "*RGJ037* 03-15-2025 09:10:11 RGJ037\nPage 3\n-12-\n123456\nkeep\nHB12\nUtah Code\n"
    assert one(spark, raw, lambda c: text.clean_pdf_lines(c, F.lit(""))) == "keep\nUtah Code"
    assert one(spark, raw, lambda c: text.clean_pdf_lines(c, F.lit("le.utah.gov"))) == "keep"


def test_paragraphs_and_names(spark):
    assert one(spark, "<p> a <b>b</b></p><P class=x>c</P><p></p>", text.paragraphs) == ["a b", "c"]
    assert one(spark, "<p>中<b>国</b>&apos;<br>x　 y<script>n</script></p>", text.paragraphs) == ["中国&apos; x y"]

    def between(*found):
        rows = spark.createDataFrame([(list(found),)], "p array<string>")
        return tuple(rows.select(text.paragraphs_between(F.col("p"), F.lit("T"), F.lit("end"), F.lit(2)).alias("x")).first().x)

    assert between("a", "T", "b", "the end") == (["T", "b"], None)
    assert between("T", "T", "end")[1].startswith("duplicate") and between("T", "b")[1].startswith("could not") and between("T", "b", "c", "end")[1] == "expected 2 paragraphs, found 3"
    assert one(spark, "top/a/x.md", lambda c: text.relative_path(c, F.lit("top/b/y.html"))) == "../b/y.html"
    assert one(spark, "top/a/x.md", lambda c: text.relative_path(c, F.lit("top/a/s/y.html"))) == "s/y.html"
    assert one(spark, "https://www.A-b.org/x/Y%20z/q.html?u", lambda c: text.linked_artifact_name(F.lit("e"), F.lit(4), c, F.lit("pdf"))) == "e-linked-05-y-20z-q.a-b-org.pdf"
    assert one(spark, "https://www.A-b.org/x", lambda c: text.artifact_name(F.lit("e"), F.lit(1), F.lit(2), c, F.lit("html"))) == "e-02.a-b-org.html"


def test_metadata(spark):
    doc = "intro\n# Title \n\n- 司法辖区：中国\n- Language: a\n- Source URL:\n- https://a.org/1\n\n- https://a.org/1\n- https://b.org\n- Language: b\n\n## 正文\n\nbody: x\n\n"
    row = spark.createDataFrame([(doc,)], "d string").select(
        text.metadata_of(F.col("d")).alias("m"), text.first_heading(F.col("d"), F.lit("f")).alias("h"), text.body_of(F.col("d")).alias("b"), text.url_block(F.col("d"), "Source URL").alias("u")
    ).first()
    assert (row.m, row.h, row.b) == ({"jurisdiction": "中国", "language": "b"}, "Title", "body: x")
    assert row.u[0] == "https://a.org/1" and len(set(row.u)) == len(row.u)
    assert one(spark, "no marker", text.body_of) is None
    assert one(spark, "no heading", lambda c: text.first_heading(c, F.lit("file"))) == "file"


def test_helpers(spark):
    rows = spark.createDataFrame([(bytearray("é".encode()),), (bytearray(b"a\xffb"),), (bytearray(gzip.compress("gz".encode())),), (bytearray(b'<meta charset="windows-1252">\x93q\x94'),), (None,)], "x binary")
    assert [r.y for r in rows.select(helpers.decode_bytes("x").alias("y")).collect()] == ["é", "a�b", "gz", '<meta charset="windows-1252">“q”', None]
    html = "<div class='ztext'>a<div>b</div>c</div><main id='main'>d</main>"
    assert helpers.scope(html, "zhihu.com") == "<div class='ztext'>a<div>b</div>c</div>"
    assert helpers.scope(html, "discord.com") == "<main id='main'>d</main>"
    assert helpers.scope(html, "x.org") == html
    assert helpers.scope(html, "trust.douyin.com") == ""
    assert helpers.balanced("<a><a>", 0, "a") is None
    tree = '[{"title":"a","contentXML":"<p>x</p>","children":[{"title":"b"}]},{"contentXML":"y"}]'
    nodes = lambda x: one(spark, x, helpers.tree_nodes)
    assert [tuple(n) for n in nodes(tree)] == [(2, "a", "<p>x</p>"), (3, "b", None), (2, None, "y")]
    assert nodes("not json") is None and nodes('{"title":"no list"}') is None
    assert len(helpers.flatten([functools.reduce(lambda n, _: {"title": "t", "children": [n]}, range(5000), {})])) == 5001
    reddit = "<h1>T</h1><p>Reddit is a vast network of communities</p><footer>f</footer>"
    assert helpers.scope(f"<nav>n</nav>{reddit}", "redditinc.com") == reddit[: reddit.index("<footer")]
    assert helpers.scope("<div id=\"content\"><h1>H</h1><p>no</p><div class=\"article\">t</div></div>", "douban.com") == '<h1>H</h1>\n<div class="article">t</div>'
    assert helpers.scope("<div id=\"docViewer\"><script>s</script>a<div class=\"x jumpTo\">j</div></div>", "uscode.house.gov") == '<div id="docViewer">\na\n</div>'
    assert one(spark, r"a中\'\n\x41", helpers.unescape_literal) == "a中'\nA"
    page = "<script>JSON.parse('{\"b\":\"it\\'s\"}'); JSON.parse('{\"c\":\"\\u4e2d\"}')</script>"
    assert one(spark, page, lambda c: helpers.embedded_literal(c, "it")) == '{"b":"it\'s"}'
    assert one(spark, page, lambda c: helpers.embedded_literal(c, "中")) == '{"c":"中"}'


def test_references_are_decoded_once(spark):
    rows = spark.createDataFrame([("&#38;#65; &#65; &#x26;#66; &amp;lt; &#0; &#1114112; &#xD800; &#99999999999;",)], "x string")
    got = rows.select(text.decode_entities(F.col("x")).alias("y")).first().y
    assert got == "&#65; A B &lt; \0 \ufffd \ufffd \ufffd".replace("&lt;", "<")
    assert helpers.decoded(rows.first().x) == got


def test_many_metadata_lines(spark):
    """Lines of one document are read in a time that grows with their number, and the last of a field wins."""
    import time

    one = "- Language: l%d\n- 语言组：g%d\nprose - Language: no\n- Unknown: x\n"
    rows = spark.createDataFrame([("# H\n" + "".join(one % (k, k) for k in range(4000)),)], "d string").select(text.metadata_of(F.col("d")).alias("m"))
    rows.first()
    start = time.time()
    assert rows.first().m == {"language": "l3999", "language_group": "g3999"} and time.time() - start < 2


def test_damaged_and_huge_artifacts():
    """Every one-byte change of a stream ends in its text or in nothing; what unpacks beyond the bound does too."""
    import gzip
    import zlib

    plain = b"<p>some text</p>" * 9
    raw = gzip.compress(plain)
    assert helpers.inflate(raw, 1000) == plain and helpers.inflate(raw + raw + b"\0\0", 1000) == plain * 2 and helpers.inflate(raw + b"tail", 1000) == plain
    assert helpers.inflate(raw, len(plain)) == plain and helpers.inflate(raw, len(plain) - 1) is None and helpers.inflate(raw[:-1], 1000) is None
    for k in range(2, len(raw)):
        for bit in range(8):
            assert helpers.inflate(raw[:k] + bytes([raw[k] ^ 1 << bit]) + raw[k + 1 :], 1000) in (plain, None)
    packer = zlib.compressobj(9, zlib.DEFLATED, 31)
    bomb = b"".join(packer.compress(bytes(1 << 20)) for _ in range(200)) + packer.flush()
    assert helpers.inflate(bomb, helpers.MOST_BYTES) is None


def test_undecodable_artifacts_are_noted(spark):
    import gzip

    raw = gzip.compress("é".encode())
    rows = spark.createDataFrame([(1, raw), (2, raw[:-9] + b"x" * 9), (3, None)], "n int, x binary").withColumn("y", helpers.decode_bytes("x"))
    assert {r.n: (r.y, r.z is not None) for r in rows.select("n", "y", helpers.decoding_note(F.col("x"), F.col("y")).alias("z")).collect()} == {1: ("é", False), 2: (None, True), 3: (None, False)}


def test_elements_that_never_end(spark):
    """A page of starts without ends takes a time that grows with it, and is cut as a short page is."""
    import re
    import time

    parts = ["<script>a</script>x", "<SCRIPT src=1>", "<b>y</b>", "</script>", "<!-- c -->", "<!--", "<scripted>", "z\n"]
    import random

    rng = random.Random(3)
    long_ = ["".join(rng.choice(parts) for _ in range(12_000)) for _ in range(3)] + ["<script>" * 300_000, "<script>x</script>" + "<!--" * 300_000]
    rows = spark.createDataFrame([(k, h) for k, h in enumerate(long_)], "n int, h string").repartition(4)
    start = time.time()
    got = {r.n: r.y for r in rows.select("n", text.without_elements(text.without_elements(F.col("h"), r"<script\b", "</script>"), "<!--", "-->").alias("y")).collect()}
    assert time.time() - start < 20
    for k, h in enumerate(long_[:3]):
        assert len(h) > text.LONG_PAGE
        assert got[k] == re.sub(r"(?s)<!--.*?-->", "\n", re.sub(r"(?is)<script\b.*?</script>", "\n", h))
    assert got[3] == long_[3] and got[4] == "\n" + "<!--" * 300_000
