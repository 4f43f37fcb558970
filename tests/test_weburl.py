"""URLs as browsers parse them: stated results, and thousands of odd ones against the standard's state machine."""

import random

import pytest
import web_states
from pyspark.sql import functions as F

from corpusloom.functions import helpers, urls, weburl
from corpusloom.operators import links

STATED = [
    ("https://u:p@A.org:443/a/../b?x y#z", "https://u:p@a.org/b?x%20y#z"), ("http://[2001:DB8:0:0:1::1]:8080/", "http://[2001:db8::1:0:0:1]:8080/"), ("http://[::ffff:1.2.3.4]/", "http://[::ffff:102:304]/"), ("http://[::1", None), ("http://[1::2::3]/", None),
    ("http://0x7f.1/", "http://127.0.0.1/"), ("http://256/", "http://0.0.1.0/"), ("http://1.2.3.4.5/", None), ("http://09.1/", None), ("http://a.1/", None), ("http://1.2.3.4./", "http://1.2.3.4/"), ("http://0xffffffff/", "http://255.255.255.255/"), ("http://4294967296/", None),
    ("http://bücher.de/ä?ö#ü", "http://xn--bcher-kva.de/%C3%A4?%C3%B6#%C3%BC"), ("http://XN--BCHER-KVA.de", "http://xn--bcher-kva.de/"), ("http://Ａ.org/", "http://a.org/"), ("http://例え。jp/", "http://xn--r8jz45g.jp/"),
    ("http:\\\\a.org\\b\\..\\c", "http://a.org/c"), ("http:a.org", "http://a.org/"), ("https:////a.org/x", "https://a.org/x"), ("http://a.org:80", "http://a.org/"), ("http://a.org:0080/", "http://a.org/"), ("http://a.org:65536/", None), ("http://a.org:8a/", None), ("http://a.org:/", "http://a.org/"),
    ("http://a b/", None), ("http://a%20b/", None), ("http://%41.org/", "http://a.org/"), ("http://a.org/%7e%zz", "http://a.org/%7e%zz"), ("http://a.org/%2e%2E/b/%2e", "http://a.org/b/"), ("http://a.org/a/b/../../../c/.", "http://a.org/c/"), ("http://@a.org/", "http://a.org/"), ("http://a@b@c.org/", "http://a%40b@c.org/"),
    ("http://u:@a.org", "http://u@a.org/"), ("http://", None), ("http://?x", None), ("http://u@/x", None), ("  http://a.org/\n x ", "http://a.org/%20x"), ("ht\ttp://a.org", "http://a.org/"), ("HTTP://A.ORG/?", "http://a.org/?"), ("http://a.org/#", "http://a.org/#"), ("http://a.org?x'y", "http://a.org/?x%27y"),
    ("data:text/plain,a b#c d", "data:text/plain,a b#c%20d"), ("mailto:a@b", "mailto:a@b"), ("foo://H/p/../q?'", "foo://H/q?'"), ("foo:/a/..//b", "foo:/.//b"), ("foo:a/../b", "foo:a/../b"), ("file:///a/../b", "file:///b"), ("file://localhost/x", "file:///x"), ("no scheme", None), ("", None), ("//a.org/", None), ("1http://a", None),
    ("http://a.org/a|b[c]^{d}`\"<>", "http://a.org/a|b[c]%5E%7Bd%7D%60%22%3C%3E"), ("http://a..b/", "http://a..b/"), ("http://a_b.org/", "http://a_b.org/"), ("http://a.org/\U0001f600", "http://a.org/%F0%9F%98%80"),
]


@pytest.mark.parametrize(("given", "wanted"), STATED)
def test_stated(given, wanted):
    found = weburl.split(given, None)
    assert (found and found[0] + found[2] + found[3] + found[5]) == wanted


BASES = ("http://h.org/a/b?q#f", "https://u@h.org:81/", "foo://h/x/y", "foo:/x/y", "data:x", "http://h.org/a/./c/")


def odd_urls(n, seed=4):
    rng = random.Random(seed)
    pieces = ["http:", "https:", "HTTPS:", "foo:", "data:", "ws:", "//", "/", "\\", "?", "#", "@", ":", ".", "..", "/../", "/./", "%2e", "%2E%2e", "a", "b.org", "A.Org", "80", ":443", ":8080", "0x1f", "1.2", "300", "é", " ", "'", '"', "<", "{", "|", "^", "utm_x=1", "&", "=", "+", "%20", "%7", "~", "\t", "user:pw@", "x.html", "q=1"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 9))) for _ in range(n)] + [f"http://{x}" for x in ("".join(rng.choice(pieces[6:]) for _ in range(rng.randint(1, 7))) for _ in range(n))]


def whole(found):
    return found and found[0] + found[2] + found[3] + found[5]


def plain_host(url):
    """The state machine knows no mapping of hosts beyond ASCII, nor escapes in them."""
    return url is None or url[2] is None or (url[2].isascii() and "%" not in url[2])


def test_states():
    compared = 0
    for text in odd_urls(4000):
        for base in (None, *BASES):
            start = base and web_states.parse(base)
            wanted = web_states.parse(text, start)
            got = whole(weburl.split(text, base and weburl.parse(base)))
            if (wanted is None and got is not None and any(x in text for x in ("é", "%"))) or not plain_host(wanted):
                continue
            assert got == web_states.text_of(wanted), (text, base)
            compared += 1
    assert compared > 30_000


def test_expressions_agree(spark):
    """Expressions and helper split alike, whichever of them a row's URLs go through; entities are decoded before."""
    given = [u for u, _ in STATED] + odd_urls(300, 5) + ["https://a.org/x?utm_a=1&b=2", "https://a.org/x?b&utm_c=3&d=%20", "https://a.org/?x=1&amp;utm_y=2", "https://a.org/x?utm_a=1", "https://a.org/%75tm?%75tm_a=1&k=~", "HTTPS://A.Org/A'b?q#f'", "/r/x?y#z", "/r/../x", "//o.org/", "/é", None]
    rows = spark.createDataFrame([(given, base) for base in (None, *BASES)], "urls array<string>, base string")
    got = rows.select("base", urls.split_urls(F.col("urls"), F.col("base")).alias("s")).collect()
    for r in got:
        start = r.base and weburl.parse(r.base)
        assert [s and tuple(s) for s in r.s] == [u if u is None else weburl.split(helpers.decoded(u), start) for u in given]
    quick = sum(s is not None for s in spark.createDataFrame([(["https://a.org/b-c/d?e=f#g"] * 3,)], "u array<string>").select(urls.split_urls(F.col("u")).alias("s")).first().s)
    assert quick == 3


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("https://u:p@A.org:443/a/../b?x y#z", ["https://u:p@a.org/b?x%20y", "scheme:a.org/b?x%20y", "https://u:p@a.org/b", "scheme:a.org/b"]),
        ("https://a.org:8443/x?", ["https://a.org:8443/x?", "scheme:a.org/x", "https://a.org:8443/x"]),
        ("https://a.org/x?a&utm_b=c d&e=%7e", ["https://a.org/x?a=&e=%7E", "scheme:a.org/x?a&utm_b=c%20d&e=%7e", "https://a.org/x", "scheme:a.org/x"]),
        ("https://HELP.x.com/en/a/../rules-and-policies/hateful.HTML?x", ["https://help.x.com/en/rules-and-policies/hateful.HTML?x", "scheme:help.x.com/en/rules-and-policies/hateful.HTML?x", "https://help.x.com/en/rules-and-policies/hateful.HTML", "scheme:help.x.com/en/rules-and-policies/hateful.HTML", "x-policy:hateful", "https://help.x.com/en/rules-and-policies/hateful.html"]),
        ("https://www.bilibili.com/blackboard/help.html#/?id=1", ["https://www.bilibili.com/blackboard/help.html#/?id=1", "scheme:www.bilibili.com/blackboard/help.html#/?id=1"]),
        ("no url#a", ["no url"]), ("mailto:x@y#z", ["mailto:x@y", "scheme:x@y"]), (None, None),
    ],
)
def test_aliases(spark, given, wanted):
    row = spark.createDataFrame([(given,)], "u string").select(urls.url_aliases(F.col("u")).alias("a"), urls.aliases_all(F.array("u")).alias("b"), urls.canonical_url(F.col("u")).alias("c")).first()
    assert row.a == wanted and row.b == [wanted] and row.c == (wanted and wanted[0])


def test_odd_links_meet(spark):
    """Links to one page written in different ways have one target."""
    pairs = spark.createDataFrame([("https://a.org/b?x y#z", "p/1.md", 0)], "url string, target string, at int")
    wanted = spark.createDataFrame([(u,) for u in ("https://A.org:443/a/../b?x%20y", "http:\\\\a.org\\b?x y", "https://a.org/%2e/b?x y&amp;", "https://a.org/c")], "url string")
    got = {r.url: r.target for r in links.lookup_targets(wanted, links.build_link_map(pairs, ["at"])).collect()}
    assert set(got) == {"https://A.org:443/a/../b?x%20y", "http:\\\\a.org\\b?x y", "https://a.org/%2e/b?x y&amp;"}


def test_lines_of_several_pieces(spark):
    """References of each piece keep their places; local targets come by any alias."""
    html = ["<a href='x/../é'>one</a> <a href='#f'>two</a>", "<a href='mailto:q'>three</a><a href=\"//A.org/b\">four</a>"]
    rows = spark.createDataFrame([(1, html)], "id int, html array<string>")
    rows = rows.select("id", F.transform("html", lambda h: F.struct(F.lit("").alias("head"), h.alias("html"))).alias("p"))
    targets = F.create_map(F.lit("scheme:a.org/b"), F.lit("b.md"))
    got = links.linked_lines(rows, "p", F.lit("https://h.org/d/"), targets).first().p
    assert [p.lines for p in got] == [["[one](https://h.org/d/%C3%A9) two"], ["three [four](b.md)"]]
