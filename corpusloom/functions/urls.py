"""URLs as column expressions: parts, canonical form, aliases, resolution.

A URL of the simple form (http or https, a host of letters, digits and hyphens, nothing to be escaped and no dot segments), and a
path from the root on a base of that form, is split by expressions. Others go to ``weburl``, all of a row in one call; a row without any sends nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import rules, weburl
from corpusloom.functions.helpers import decoded
from corpusloom.functions.text import decode_entities, let, trim

PARTS = ("head", "host", "path", "query", "clean", "fragment")
_TYPE = f"struct<{','.join(f'{p}:string' for p in PARTS)}>"
_PLAIN = r"A-Za-z0-9._~!$&()*+,;=:@%|/\[\]\-"
_TAIL = rf"(\?[{_PLAIN}?{{}}^]*)?(#[{_PLAIN}?{{}}^']*)?\z"
#: Scheme, host, path, query, fragment.
_SIMPLE = rf"^([hH][tT][tT][pP][sS]?)://((?:[A-Za-z0-9_-][A-Za-z0-9_.-]*\.)?[A-Za-z][A-Za-z0-9_-]*)(/[{_PLAIN}']*)?{_TAIL}"
_ROOTED = rf"^()()(/(?![/\\])[{_PLAIN}']*){_TAIL}"
#: What no simple form has: dot segments, Punycode, entities, and the mark that groups are parted by.
_ODD = rf"^(?:[A-Za-z]+://)?[^?#]*/(?:\.|%2[eE]){{1,2}}(?:[/?#]|\z)|^[A-Za-z]+://(?:[^/?#]*\.)?[xX][nN]--|\x1f|(?i:&(?:{'|'.join(name for name, _ in rules.ENTITIES)}|#x[0-9a-f]+|#\d+);)"
_CAMPAIGN = r"(?i)utm|%(?:75|74|6d|5f)"


def _fields(query: Column) -> Column:
    return F.split(F.substr(query, F.lit(2)), "&")


def _is_simple(url: Column, pattern: str) -> Column:
    """Whether expressions split a URL: its form, and a query that they write as it is."""
    asks = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    plain = ~asks.rlike(_CAMPAIGN) | F.forall(_fields(asks), lambda f: f.rlike(r"^[\w*.+-]+=[\w*.+-]*\z"))
    return url.rlike(pattern) & ~url.rlike(_ODD) & plain


def _cut(url: Column, pattern: str) -> Column:
    """The five groups of a simple form, by one search; null for any other URL."""
    return F.when(_is_simple(url, pattern), F.split(F.regexp_replace(url, pattern, "$1\x1f$2\x1f$3\x1f$4\x1f$5"), "\x1f"))


def _without_campaigns(query: Column) -> Column:
    kept = F.concat(F.lit("?"), F.array_join(F.filter(_fields(query), lambda f: ~f.startswith("utm_")), "&"))
    return F.when(query.rlike(_CAMPAIGN), F.regexp_replace(kept, r"^\?\z", "")).otherwise(query)


def _struct(groups: Column, head: Column, host: Column) -> Column:
    path = F.when(groups[2] == "", "/").otherwise(groups[2])
    return F.when(groups.isNotNull(), F.struct(head.alias("head"), host.alias("host"), path.alias("path"), groups[3].alias("query"), _without_campaigns(groups[3]).alias("clean"), groups[4].alias("fragment")))


def _split_odd(urls: Column, base: Column, references: bool) -> Column:
    """Arrays of parts for arrays of URLs, decoded first; a row's base is parsed once."""

    def parts(url, start):
        text = None if url is None else decoded(url)
        if text is None or (references and (text == "" or text.startswith(rules.NO_PAGES))):
            return None
        return weburl.split(text, start)

    def one(urls, base):
        if urls is None:
            return None
        start = None if base is None else weburl.parse(base)
        return [None if base is not None and start is None else parts(u, start) for u in urls]

    return F.udf(one, f"array<{_TYPE}>", useArrow=False)(urls, base)


def split_urls(urls: Column, base: Column | None = None, references: bool = False) -> Column:
    """The parts of each URL of an array, its entities decoded, seen from a base where one is given; null for what is no URL.

    With ``references`` empty ones and those to mail, telephone and script are none either.
    """
    base = F.lit(None).cast("string") if base is None else base

    based, host = F.coalesce(_is_simple(base, _SIMPLE), F.lit(False)), F.lower(F.regexp_extract(base, _SIMPLE, 2))
    origin = F.concat(F.lower(F.regexp_extract(base, _SIMPLE, 1)), F.lit("://"), host)

    # no inner function names a variable of an outer one, as Spark does not take calls of Python out of such expressions
    def plain(u: Column) -> Column:
        own = let(_cut(u, _SIMPLE), lambda g: _struct(g, F.concat(F.lower(g[0]), F.lit("://"), F.lower(g[1])), F.lower(g[1])))
        rooted = let(_cut(u, _ROOTED), lambda g: _struct(g, origin, host))
        return F.when(based, F.coalesce(own, rooted)).when(base.isNull(), own)

    # one call of the helper a row, and none for a row whose URLs are all simple
    odd = F.exists(urls, lambda u: u.isNotNull() & ~(_is_simple(u, _SIMPLE) | (based & _is_simple(u, _ROOTED))))
    asked = F.when(odd | (base.isNotNull() & ~based), urls)
    return F.coalesce(_split_odd(asked, base, references), F.transform(urls, plain))


def _split(url: Column) -> Column:
    return F.get(split_urls(F.array(url)), 0)


def _bare_host(parts: Column) -> Column:
    return F.regexp_replace(parts["host"], r"^www\.", "")


def _routed(parts: Column) -> Column:
    """The fragment where a site finds its pages by it."""
    return F.when(F.concat(_bare_host(parts), parts["path"]).isin(*rules.HASH_ROUTED), parts["fragment"]).otherwise("")


def _canonical(parts: Column) -> Column:
    return F.concat(parts["head"], parts["path"], parts["clean"], _routed(parts))


def _without_fragment(url: Column) -> Column:
    return F.regexp_replace(decode_entities(url), r"#[^\n\r\u2028\u2029]*\z", "")


def canonical_url(url: Column) -> Column:
    """No fragment unless the site routes by it, no ``utm_`` parameters; what is no URL is cut at its #."""
    return let(_split(url), lambda p: F.when(p.isNull(), _without_fragment(url)).otherwise(_canonical(p)))


def canonical_all(urls: Column) -> Column:
    """The canonical form of each URL of an array."""
    return F.zip_with(urls, split_urls(urls), lambda u, p: F.when(p.isNull(), _without_fragment(u)).otherwise(_canonical(p)))


def _slug(parts: Column) -> Column:
    """The name of a policy page of two hosts; null elsewhere."""

    def after(names: Column) -> Column:
        return F.get(names, F.nullif(F.array_position(names, rules.POLICY_FOLDER), F.lit(0)).cast("int"))

    found = let(F.filter(F.split(parts["path"], "/"), lambda p: p != ""), after)
    return F.when(_bare_host(parts).isin(*rules.POLICY_HOSTS), F.regexp_replace(found, r"(?i)\.html\z", ""))


def policy_slug(url: Column) -> Column:
    return let(_split(url), _slug)


def aliases_of(parts: Column, url: Column) -> Column:
    """The keys of a URL whose parts are known, the most exact first; of no URL its canonical form alone."""

    def listed(p: Column) -> Column:
        bare, routed = F.concat(F.lit("scheme:"), p["host"], p["path"]), _routed(p)
        shown = F.when(routed == "#", "").otherwise(routed)
        slug, answer = _slug(p), F.when(_bare_host(p) == rules.HELP_HOST, F.nullif(F.regexp_extract(p["path"], rules.HELP_ID, 1), F.lit("")))
        before, after = rules.POLICY_URL.split("%s")
        found = [
            _canonical(p),
            F.concat(bare, F.when(p["query"] == "?", "").otherwise(p["query"]), shown),
            F.concat(p["head"], p["path"], routed),
            F.concat(bare, shown),
            F.concat(F.lit("x-policy:"), slug),
            F.concat(F.lit(before), slug, F.lit(after)),
            F.concat(F.lit("youtube-answer:"), answer),
        ]
        return F.array_distinct(F.array_compact(F.array(*found)))

    return let(parts, lambda p: F.when(p.isNull(), F.array(_without_fragment(url))).otherwise(listed(p)))


def url_aliases(url: Column) -> Column:
    """Every key under which a URL is known, the most exact first."""
    return F.when(url.isNotNull(), aliases_of(_split(url), url))


def aliases_all(urls: Column) -> Column:
    """The aliases of each URL of an array."""
    parts = split_urls(urls)
    return F.zip_with(urls, parts, lambda u, p: F.when(u.isNotNull(), aliases_of(p, u)))


def resolve_all(hrefs: Column, base: Column) -> Column:
    """The absolute URL of each reference of an array; null for none, for mail, telephone and script, and for what does not resolve."""

    parts = split_urls(F.transform(hrefs, trim), base, references=True)
    return F.transform(parts, lambda p: F.concat(p["head"], p["path"], p["query"], p["fragment"]))


def resolve_url(href: Column, base: Column) -> Column:
    return F.get(resolve_all(F.array(href), base), 0)


def resolved_map(hrefs: Column, base: Column) -> Column:
    """A map of the distinct references of an array to their URLs, without those that have none."""
    distinct = F.array_distinct(F.array_compact(hrefs))
    pairs = F.arrays_zip(distinct.alias("href"), resolve_all(distinct, base).alias("url"))
    return F.map_from_entries(F.filter(pairs, lambda p: p["url"].isNotNull()))
