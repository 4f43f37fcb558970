"""URLs and links on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import urls
from corpusloom.operators import links


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("HTTP://A.Org", "http://a.org/"), ("https://a.org:443/x?utm_source=1", "https://a.org/x"), ("https://a.org/x?utm_a=1&b=2&utm_c=3#top", "https://a.org/x?b=2"),
        ("https://www.bilibili.com/blackboard/help.html#/?id=1", "https://www.bilibili.com/blackboard/help.html#/?id=1"), ("not a url#x", "not a url"), ("https://a.org/?a=1&amp;b=2", "https://a.org/?a=1&b=2"),
    ],
)
def test_canonical(spark, given, wanted):
    assert one(spark, given, urls.canonical_url) == wanted


def test_aliases(spark):
    got = one(spark, "http://a.org/x?q=1&utm_m=2#h", urls.url_aliases)
    assert got == ["http://a.org/x?q=1", "scheme:a.org/x?q=1&utm_m=2", "http://a.org/x", "scheme:a.org/x"]
    slug = one(spark, "https://help.twitter.com/en/rules-and-policies/hateful.html", urls.url_aliases)
    assert slug[-2:] == ["x-policy:hateful", "https://help.x.com/en/rules-and-policies/hateful.html"]
    assert "youtube-answer:42" in one(spark, "https://support.google.com/youtube/answer/42?hl=en", urls.url_aliases)
    assert one(spark, "nonsense#a", urls.url_aliases) == ["nonsense"]


@pytest.mark.parametrize(
    ("href", "wanted"),
    [
        ("/x", "https://h.org/x"), ("?q", "https://h.org/a/b?q"), ("//o.org/y", "https://o.org/y"), ("c", "https://h.org/a/c"), ("mailto:a@b", None), ("javascript:x", None), ("", None), ("HTTPS://O.org", "https://o.org/"),
    ],
)
def test_resolve(spark, href, wanted):
    assert one(spark, href, lambda c: urls.resolve_url(c, F.lit("https://h.org/a/b"))) == wanted


def test_extract_links(spark):
    html = "<a href='/one'>A <b>b</b></a><a class=x href=\"https://o.org/two\">&amp;</a><a href='mailto:x'>m</a><a href=\"/three\"/> tail"
    rows = links.extract_links(spark.createDataFrame([(1, "https://h.org/p", html)], "page_id long, url string, html string")).orderBy("ordinal").collect()
    assert [(r.url, r.text) for r in rows][:2] == [("https://h.org/one", "A b"), ("https://o.org/two", "&")]
    assert ("https://h.org/three", "tail") in [(r.url, r.text) for r in rows]


def test_admit(spark):
    entries = spark.createDataFrame([(1, ["http://h.org/named?x=1"], ["/in"], ["out"]), (2, [], [], [])], "id long, linked_source_urls array<string>, include array<string>, exclude array<string>")
    found = spark.createDataFrame([(i, u) for i in (1, 2) for u in ("https://h.org/named?x=1", "https://h.org/IN/a", "https://h.org/in/out", "https://h.org/else")], "id long, url string")
    got = {(r.id, r.url) for r in links.admit_links(found, entries).collect()}
    assert got == {(1, "https://h.org/named?x=1"), (1, "https://h.org/IN/a")}


def test_discover(spark):
    entries = spark.createDataFrame([(1, ["https://h.org/a"], [], ["h.org"], [])], "id long, source_urls array<string>, linked_source_urls array<string>, include array<string>, exclude array<string>")
    edges = [("https://h.org/a", 0, "https://h.org/b"), ("https://h.org/a", 1, "http://h.org/b#x"), ("https://h.org/a", 2, "https://h.org/a?y"), ("https://h.org/b", 0, "https://h.org/c"), ("https://h.org/c", 0, "https://h.org/d")]
    found = spark.createDataFrame(edges, "page_url string, ordinal int, url string")
    assert {(r.url, r.depth) for r in links.discover_links(entries, found, 1).collect()} == {("https://h.org/b", 1)}
    assert {(r.url, r.depth) for r in links.discover_links(entries, found, 2).collect()} == {("https://h.org/b", 1), ("https://h.org/c", 2)}
    assert links.discover_links(entries, found, 2, cap=1).count() == 1


def walked(entries, edges, depth, cap=None):
    """The queue of each entry by a plain walk: (id, source_urls, linked, include, exclude) and (page, ordinal, url) rows."""
    import re

    from corpusloom.functions import helpers, weburl

    def aliases(url):
        p = weburl.split(helpers.decoded(url), None)
        if p is None:
            return [url.split("#")[0]]
        head, host, path, query, clean, _ = p
        return list(dict.fromkeys([head + path + clean, f"scheme:{host}{path}{query if query != '?' else ''}", head + path, f"scheme:{host}{path}"]))

    by_page = {}
    for page, ordinal, url in edges:
        by_page.setdefault(aliases(page)[0], []).append((ordinal, url))
    out = set()
    for id_, own, linked, include, exclude in entries:
        named, seen, queue = {a for u in linked for a in aliases(u)}, {a for u in own for a in aliases(u)}, []

        def add(url, level, named=named, seen=seen, queue=queue, include=include, exclude=exclude):
            let_in = named & set(aliases(url)) or (any(re.search(p, url, re.I) for p in include) and not any(re.search(p, url, re.I) for p in exclude))
            if let_in and not seen & set(aliases(url)) and (cap is None or len(queue) < cap):
                seen.update(aliases(url))
                queue.append((url, level))

        for u in linked:
            add(u, 1)
        pages = [(u, 0) for u in own]
        for page, level in pages:
            for _, u in sorted(by_page.get(aliases(page)[0], [])):
                add(u, level + 1)
        for page, level in queue:
            for _, u in sorted(by_page.get(aliases(page)[0], [])) if level < depth else ():
                add(u, level + 1)
        out |= {(id_, u, level, k) for k, (u, level) in enumerate(queue)}
    return out


@pytest.mark.parametrize("cap", [None, 4])
def test_discover_as_a_walk(spark, cap):
    """Rounds of joins take what a walk in order takes, also along chains of candidates that share aliases."""
    import random

    rng = random.Random(6)
    urls_ = [f"{rng.choice(['http', 'https'])}://h.org/{p}{q}{f}" for p in "abcdefghij" for q in ("", "?x=1", "?x=2", "?x=1&utm_a=b") for f in ("", "#z")]
    edges = [(rng.choice(urls_), n, rng.choice(urls_)) for n in range(700)]
    rows = [(k, rng.sample(urls_, 2), rng.sample(urls_, k % 3), [rng.choice(["h.org", "[a-f]", "x=", "nothing"])], ["[ij]$"]) for k in range(25)]
    entries = spark.createDataFrame(rows, "id long, source_urls array<string>, linked_source_urls array<string>, include array<string>, exclude array<string>")
    found = links.discover_links(entries, spark.createDataFrame(edges, "page_url string, ordinal int, url string"), 3, cap)
    want = walked(rows, edges, 3, cap)
    assert {tuple(r) for r in found.collect()} == want and len(want) > 60


def test_discovery_of_the_registered_query(spark):
    from corpusloom.jobs import queries

    root = "/root/testdata/sf0.001"
    rows = [(r.id, r.source_urls, r.linked_source_urls, r.include, r.exclude) for r in queries._entries_with_rules(spark, root).collect()]
    want = walked(rows, [tuple(r) for r in queries.site_links(spark, root).collect()], 3)
    got = [tuple(r) for r in queries.QUERIES["l7_discover_links"](spark, root).select("id", "url", "depth", "position").collect()]
    assert len(got) == len(want) and set(got) == want and {r[2] for r in got} == {1, 2, 3}


def test_map_lookup_localize(spark):
    pairs = spark.createDataFrame([("https://h.org/a?q=1", "r/a1.md", 0), ("https://h.org/a?q=2", "r/a2).md", 1), ("https://h.org/n", None, 2)], "url string, target string, at int")
    link_map = links.build_link_map(pairs, ["at"])
    assert {r.alias: r.target for r in link_map.collect()}["scheme:h.org/a"] == "r/a1.md"
    wanted = spark.createDataFrame([("http://h.org/a?q=2",), ("https://h.org/a?q=3",), ("https://h.org/n",)], "url string")
    assert {r.url: r.target for r in links.lookup_targets(wanted, link_map).collect()} == {"http://h.org/a?q=2": "r/a2).md", "https://h.org/a?q=3": "r/a1.md"}
    docs = spark.createDataFrame([("r/x.md", "[p](https://h.org/a?q=1) [q](https://h.org/a?q=2) [r](https://o.org)"), ("r/y.md", "none"), ("r/a1.md", "[s](https://h.org/a?q=1)")], "path string, body string")
    out = links.localize_links(docs, link_map)
    assert [(r.path, r.body) for r in out.collect()] == [("r/x.md", "[p](a1.md) [q](a2%29.md) [r](https://o.org)")]
    assert links.localize_links(out.select("path", "body"), link_map).count() == 0


def test_queries_take_every_page_and_item(spark, tmp_path):
    """L9 looks up the links of odd pages too; J2 asks for phrases beyond the first 40 items."""
    from corpusloom.jobs.queries import QUERIES

    root = str(tmp_path)
    pages = [(k, f"https://h.org/{k}", f"<a href='https://o.org/{k}'>x</a>") for k in (1, 2)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    spark.createDataFrame([(k, f"passage {k}") for k in range(60)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(44, "y" * 500), (64, "y" * 500)], "doc_id long, text string").write.parquet(f"{root}/documents.parquet")
    assert {r.url: r.target for r in QUERIES["l9_lookup_targets"](spark, root).collect()} == {f"https://o.org/{k}": f"p/{k}.html" for k in (1, 2)}
    assert {r.doc_id: r.note for r in QUERIES["j2_validate_bodies"](spark, root).collect()} == {44: "missing required phrase(s): PASSAGE 44", 64: "missing required phrase(s): PASSAGE 4"}
