"""Text and HTML as column expressions. Everything here stays in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import rules

#: White space in the wide sense: also no-break, ideographic and zero-width no-break.
SPACE = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
#: The same characters, for functions that take a list.
SPACES = " \t\n\x0b\f\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def trim(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def rewritten(text: Column, pattern: str, groups: int, by) -> Column:
    """``text`` with each match of a pattern replaced by ``by`` of its groups, in one pass and in order."""

    def joined(text: Column) -> Column:
        found = F.struct(*(F.regexp_extract_all(text, F.lit(pattern), F.lit(k)).alias(f"g{k}") for k in range(groups + 1)))
        new = let(found, lambda m: F.transform(m["g0"], lambda whole, i: by(whole, *(F.get(m[f"g{k}"], i) for k in range(1, groups + 1)))))
        return let(new, lambda new: F.array_join(F.transform(F.split(text, pattern), lambda t, i: F.concat(t, F.coalesce(F.get(new, i), F.lit("")))), ""))

    return F.when(text.rlike(pattern), let(text, joined)).otherwise(text)


def matches_any(text: Column, patterns) -> Column:
    return reduce(lambda a, b: a | b, (text.rlike(p) for p in patterns), F.lit(False))


def _code_point(digits: Column, base: int) -> Column:
    """The character of a number; U+FFFD for what is no character."""
    number = F.conv(F.right(F.concat(F.lit("00000000"), digits), F.lit(8)), base, 10).cast("long")
    valid = (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF) & (F.length(F.regexp_replace(digits, "^0+", "")) <= 8)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.lit("�"))


def _decode_numbers(text: Column, pattern: str, base: int) -> Column:
    """Each reference replaced once; what comes out is not read again."""
    return let(text, lambda t: rewritten(t, pattern, 1, lambda _whole, digits: _code_point(digits, base)))


def decode_entities(text: Column, numbers: bool = True, entities=rules.ENTITIES) -> Column:
    """Named entities in their fixed order, then hexadecimal and decimal references; others stay.

    Text without an ampersand, most text, is passed on as it is.
    """

    def decoded(text: Column) -> Column:
        for name, char in entities:
            text = F.regexp_replace(text, f"(?i)&{name};", char)
        if not numbers:
            return text
        return _decode_numbers(_decode_numbers(text, "&#[xX]([0-9a-fA-F]+);", 16), r"&#(\d+);", 10)

    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), decoded(t)).otherwise(t))


def clean_text(text: Column, numbers: bool = True) -> Column:
    """Decoded text with plain spaces, no blanks around line ends and at most one empty line in a row."""
    text = F.replace(F.replace(decode_entities(text, numbers), F.lit("\u00a0"), F.lit(" ")), F.lit("\r"), F.lit("\n"))
    text = F.regexp_replace(text, r"[ \t\f\x0B]{2,}|[\t\f\x0B]", " ")
    # only single spaces are left beside line ends
    text = F.replace(F.replace(text, F.lit("\n "), F.lit("\n")), F.lit(" \n"), F.lit("\n"))
    return trim(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def html_to_text(html: Column, numbers: bool = True) -> Column:
    return clean_text(F.regexp_replace(html, "<[^>]+>", " "), numbers)


def non_empty_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line != "")


def merge_markers(lines: Column) -> Column:
    """A lone dash joins the line after it, unless that is a lone dash too."""
    return let(lines, _merged)


def _merged(lines: Column) -> Column:

    def at(i: Column) -> Column:
        return F.try_element_at(lines, i + 1)

    def merged(line: Column, i: Column) -> Column:
        after = at(i + 1)
        return F.when((line == "-") & after.isNotNull() & (after != "-"), F.concat(F.lit("- "), after)).otherwise(line)

    first = F.transform(lines, lambda line, i: F.struct(merged(line, i).alias("line"), ((i > 0) & (F.get(lines, i - 1) == "-") & (line != "-")).alias("taken")))
    return F.transform(F.filter(first, lambda x: ~F.coalesce(x["taken"], F.lit(False))), lambda x: x["line"])


#: Pages beyond this are searched for elements up to the last end tag only.
LONG_PAGE = 1 << 16


def without_elements(html: Column, start: str, end: str) -> Column:
    """A line end for everything from a start pattern to the next end pattern; a start without an end stays.

    Behind the last end no start is tried, where each would be followed to the end of the page: so the time grows with the page, however many starts
    are never closed. Short pages are spared the search for the last end.
    """

    def before(html: Column) -> Column:
        return let(F.length(F.regexp_extract(html, rf"(?is)\A.*{end}", 0)), lambda n: F.concat(F.regexp_replace(F.substr(html, F.lit(1), n), rf"(?is){start}.*?{end}", "\n"), F.substr(html, n + 1)))

    return let(html, lambda h: F.when(F.length(h) > LONG_PAGE, before(h)).otherwise(F.regexp_replace(h, rf"(?is){start}.*?{end}", "\n")))


def without_noise(html: Column) -> Column:
    """HTML without scripts, styles and comments."""
    for tag in rules.NOISE_TAGS:
        html = without_elements(html, rf"<{tag}\b", f"</{tag}>")
    return without_elements(html, "<!--", "-->")


def broken_lines(html: Column, numbers: bool = True) -> Column:
    """The text lines of HTML without noise."""
    for pattern, by in ((rf"(?i)</?(?:{rules.BLOCK_TAGS})\b[^>]*>", "\n"), (r"(?i)<li\b[^>]*>", "\n- "), (r"(?i)<br\s*/?\s*>", "\n"), (r"<[^>]+>", " ")):
        html = F.regexp_replace(html, pattern, by)
    return merge_markers(non_empty_lines(clean_text(html, numbers)))


def long_preformatted(html: Column, numbers: bool = True) -> Column:
    """The lines of preformatted text, if there is much of it; else null."""
    pre = F.regexp_extract_all(html, F.lit(r"(?is)<pre\b[^>]*>(.*?)</pre>"), F.lit(1))
    joined = F.array_join(F.transform(pre, lambda p: html_to_text(F.regexp_replace(p, r"(?i)</?(?:p|br|div)\b[^>]*>", "\n"), numbers)), "\n")
    return let(joined, lambda t: F.when(F.length(trim(t)) > rules.PRE_LEAST, non_empty_lines(clean_text(t, numbers))))


def html_to_lines(html: Column, numbers: bool = True) -> Column:
    """The text lines of a page without its links. Long preformatted text stands for the page."""
    return F.coalesce(long_preformatted(html, numbers), broken_lines(without_noise(html), numbers))


def first_article(html: Column) -> Column:
    """The first un-nested article element, or the whole page."""
    found = F.regexp_extract(html, r"(?is)<article\b[^>]*>.*?</article>", 0)
    return F.when(found != "", found).otherwise(html)


def drop_chrome(html: Column) -> Column:
    """The page without header, footer, navigation, asides, hidden elements and inputs."""
    for tag in rules.CHROME_TAGS:
        html = without_elements(html, rf"<{tag}\b", f"</{tag}>")
    html = F.regexp_replace(html, rf"(?is)<([a-z0-9]+)\b(?=[^>]*\bclass=[\"'][^\"']*(?:{rules.HIDDEN_CLASSES})[^\"']*[\"'])[^>]*>.*?</\1>", "\n")
    html = F.regexp_replace(html, r"(?is)<([a-z0-9]+)\b(?=[^>]*\bhidden(?:\s|=|>))[^>]*>.*?</\1>", "\n")
    return F.regexp_replace(html, r"(?i)<input\b[^>]*>", "\n")


def slice_lines(lines: Column, start: Column, end: Column, include_end: Column, skip: Column) -> Column:
    """From the first line with ``start`` to the next later line with ``end``, without lines that match a skip pattern."""
    return let(F.filter(F.transform(lines, trim), lambda x: x != ""), lambda x: _sliced(x, start, end, include_end, skip))


def _sliced(lines: Column, start: Column, end: Column, include_end: Column, skip: Column) -> Column:
    def first(of: Column, text: Column, from_: int) -> Column:
        hit = F.transform(of, lambda x, i: F.when((i >= from_) & F.contains(x, text), i))
        return F.array_min(F.filter(hit, lambda i: i.isNotNull()))

    begun = F.when(F.coalesce(start, F.lit("")) == "", lines).otherwise(F.slice(lines, F.coalesce(first(lines, start, 0), F.lit(0)) + 1, F.greatest(F.size(lines), F.lit(1))))

    def ended(lines: Column) -> Column:
        stop = first(lines, end, 1) + F.coalesce(include_end, F.lit(False)).cast("int")
        return let(stop, lambda n: F.when((F.coalesce(end, F.lit("")) == "") | n.isNull(), lines).otherwise(F.slice(lines, F.lit(1), n)))

    lines = let(begun, ended)
    patterns = F.coalesce(skip, F.expr("cast(array() as array<string>)"))
    return F.filter(lines, lambda x: ~F.exists(patterns, lambda p: F.call_function("rlike", x, F.concat(F.lit("(?iu)"), p))))


def trim_chrome(lines: Column, host: Column) -> Column:
    """Lines before the first that ends the page's own text, without boilerplate lines."""

    def hit(line: Column, table) -> Column:
        # one pattern for the rules of all hosts, and one for each host that has its own
        by: dict[str, list[str]] = {}
        for h, p in table:
            by.setdefault(h, []).append(p)
        tests = [matches_any(line, ps) if h == "" else (((host == h) | host.endswith(f".{h}") | (host == "lifexue.com")) if h == "douyin.com" else host == h) & matches_any(line, ps) for h, ps in by.items()]
        return reduce(lambda a, b: a | b, tests)

    def trimmed(lines: Column) -> Column:
        end = F.array_min(F.filter(F.transform(lines, lambda x, i: F.when(let(trim(x), lambda y: hit(y, rules.CHROME_STARTS)), i)), lambda i: i.isNotNull()))
        body = let(end, lambda n: F.when(n.isNull(), lines).otherwise(F.slice(lines, F.lit(1), F.coalesce(n, F.lit(0)))))
        return F.filter(body, lambda x: ~let(trim(x), lambda y: hit(y, rules.CHROME_LINES)))

    return let(lines, trimmed)


def clean_pdf_lines(text: Column, host: Column) -> Column:
    """Text taken from a PDF without stamps, page numbers and headers."""
    lines = F.split(text, r"\r?\n")

    def dropped(line: Column) -> Column:
        return let(trim(line), lambda x: matches_any(x, rules.PDF_LINES) | (F.contains(host, F.lit("le.utah.gov")) & (x == "Utah Code")))

    return clean_text(F.array_join(F.filter(lines, lambda x: ~dropped(x)), "\n"))


def paragraphs(html: Column, numbers: bool = True) -> Column:
    """The text of each paragraph element on one line, empty ones left out; tags leave nothing behind, breaks a space."""

    def line(p: Column) -> Column:
        for tag in ("script", "style"):
            p = F.regexp_replace(p, rf"(?is)<{tag}\b.*?</{tag}>", "")
        p = F.regexp_replace(F.regexp_replace(p, r"(?i)<br\s*/?\s*>", "\n"), "<[^>]+>", "")
        return trim(F.regexp_replace(decode_entities(p, numbers, rules.PARAGRAPH_ENTITIES), f"{SPACE}+", " "))

    found = F.regexp_extract_all(html, F.lit(r"(?is)<p\b[^>]*>.*?</p>"), F.lit(0))
    return F.filter(F.transform(found, line), lambda p: p != "")


def paragraphs_between(found: Column, title: Column, footer: Column, expected: Column | None = None) -> Column:
    """A struct of ``paragraphs`` from the one that is the title to before the first with the footer, and ``error``.

    It is an error if the title stands twice, if either is missing or the footer comes first, or if the number is not the expected one.
    """

    def cut(p: Column) -> Column:
        titles = F.filter(F.transform(p, lambda x, i: F.when(x == title, i)), lambda i: i.isNotNull())
        end = F.array_min(F.filter(F.transform(p, lambda x, i: F.when(F.contains(x, footer), i)), lambda i: i.isNotNull()))
        start = F.get(titles, 0)
        error = F.when(F.size(titles) > 1, "duplicate document title in paragraph extraction").when(start.isNull() | end.isNull() | (end <= start), "could not locate document body boundaries")
        body = F.when(error.isNull(), F.slice(p, start + 1, F.greatest(end - start, F.lit(0))))
        return F.struct(body.alias("paragraphs"), error.alias("error"))

    cut_ = let(found, cut)
    if expected is None:
        return cut_
    n = F.size(cut_["paragraphs"])
    wrong = F.concat(F.lit("expected "), expected.cast("string"), F.lit(" paragraphs, found "), n.cast("string"))
    return F.struct(cut_["paragraphs"].alias("paragraphs"), F.coalesce(cut_["error"], F.when(n != expected, wrong)).alias("error"))


BBCODE_LINK = r"(?is)\[url=([^\]]+)\](.*?)\[/url\]"


def bbcode_references(text: Column, numbers: bool = True) -> Column:
    """What the links of a BBCode text refer to, as ``bbcode_to_markdown`` asks for it."""
    return F.regexp_extract_all(F.replace(decode_entities(text, numbers), F.lit("\r"), F.lit("\n")), F.lit(BBCODE_LINK), F.lit(1))


def bbcode_to_markdown(text: Column, target=lambda href: href, numbers: bool = True) -> Column:
    """BBCode as Markdown; ``target`` gives the target of a reference, null where there is none."""

    def linked(_whole: Column, href: Column, label: Column) -> Column:
        label, url = clean_text(label, numbers), target(href)
        return F.when(url.isNull() | (label == ""), label).otherwise(F.concat(F.lit("["), label, F.lit("]("), F.replace(url, F.lit(")"), F.lit("%29")), F.lit(")")))

    text = F.replace(decode_entities(text, numbers), F.lit("\r"), F.lit("\n"))
    text = rewritten(text, BBCODE_LINK, 2, linked)
    for pattern, by in rules.BBCODE:
        text = F.regexp_replace(text, pattern, by)
    return clean_text(text, numbers)


def help_article(lines: Column) -> Column:
    """The lines of a help page from where its article begins: before a known phrase, before a month line, or at a policy heading."""

    def first(of: Column, hit) -> Column:
        return F.array_min(F.filter(F.transform(of, lambda x, i: F.when(hit(x), i)), lambda i: i.isNotNull()))

    def cut(of: Column) -> Column:
        purpose, month = first(of, lambda x: F.contains(x, F.lit(rules.HELP_PURPOSE))), first(of, lambda x: x.rlike(rules.HELP_MONTH))
        before = F.when(purpose.isNotNull(), F.greatest(purpose - 1, F.lit(0)))
        start = F.coalesce(before, F.when(month > 0, month - 1), first(of, lambda x: x.rlike(rules.HELP_HEADING)), F.lit(0))
        rest = let(start, lambda n: F.slice(of, n + 1, F.greatest(F.size(of), F.lit(1))))
        return let(rest, lambda r: F.slice(r, F.lit(1), F.coalesce(first(r, lambda x: x == rules.HELP_END), F.size(r))))

    return let(F.filter(lines, lambda x: x != "-"), cut)


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def paragraph_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\n{2,}"), lambda p: trim(p) != "")).cast("long")


def is_challenge_page(text: Column, enabled: Column | None = None) -> Column:
    head = F.substring(text, 1, rules.CHALLENGE_WINDOW)
    hit = matches_any(head, [f"(?i){p}" for p in rules.CHALLENGE])
    return hit if enabled is None else hit & F.coalesce(enabled, F.lit(True))


def artifact_type(url: Column, content_type: Column, explicit: Column, method: Column, extractor: Column) -> Column:
    """json, pdf, txt, xml or html, by the first rule that fits; a stated extension comes before all."""
    kind = F.coalesce(content_type, F.lit(""))
    path = F.lower(F.regexp_extract(url, r"^[a-zA-Z][^:]*://[^/?#]*([^?#]*)", 1))
    search = F.lower(F.regexp_extract(url, r"^[a-zA-Z][^:]*://[^/?#]*([^#]*)", 1))
    return (
        F.when(F.coalesce(explicit, F.lit("")) != "", F.regexp_replace(explicit, r"^\.", ""))
        .when(path.endswith(".json") | kind.contains("json") | url.contains("/rule_out_api/") | url.contains("/oacontract/"), "json")
        .when(F.coalesce(method == "pdf", F.lit(False)) | F.coalesce(extractor == "pdf-text", F.lit(False)) | search.contains(".pdf") | kind.contains("pdf"), "pdf")
        .when(path.endswith(".txt") | kind.contains("text/plain"), "txt")
        .when(path.endswith(".xml") | kind.contains("xml"), "xml")
        .otherwise("html")
    )


def sniffed_type(kind: Column, content: Column) -> Column:
    """The type, unless the bytes begin as a PDF."""
    return F.when(F.substring(content, 1, 5) == F.lit(b"%PDF-"), "pdf").otherwise(kind)


def slug(text: Column) -> Column:
    return F.regexp_replace(text, "(?i)[^a-z0-9]+", "-")


def host_of(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), r"^www\.", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def artifact_name(entry: Column, ordinal: Column, sources: Column, url: Column, extension: Column) -> Column:
    """Entry, its number when there are several, host and extension."""
    number = F.when(sources > 1, F.concat(F.lit("-"), F.lpad((ordinal + 1).cast("string"), 2, "0"))).otherwise("")
    return F.concat(entry, number, F.lit("."), slug(host_of(url)), F.lit("."), extension)


def linked_artifact_name(entry: Column, ordinal: Column, url: Column, extension: Column) -> Column:
    """Entry, number, the last two parts of the path, host and extension."""
    parts = F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    last = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)), "-")
    last = F.lower(F.regexp_replace(slug(F.regexp_replace(last, r"(?i)\.[a-z0-9]+\z", "")), r"^-|-\z", ""))
    last = F.when(last == "", "linked-source").otherwise(last)
    return F.concat(entry, F.lit("-linked-"), F.lpad((ordinal + 1).cast("string"), 2, "0"), F.lit("-"), last, F.lit("."), slug(host_of(url)), F.lit("."), extension)


def relative_path(from_file: Column, to_file: Column) -> Column:
    """The path of one file as seen from another."""
    a, b = F.split(from_file, "/"), F.split(to_file, "/")
    a = F.slice(a, F.lit(1), F.size(a) - 1)
    differ = F.filter(F.transform(a, lambda x, i: F.when(~x.eqNullSafe(F.get(b, i)) | (i >= F.size(b) - 1), i)), lambda i: i.isNotNull())
    common = F.coalesce(F.array_min(differ), F.size(a))
    return F.concat(F.repeat(F.lit("../"), F.size(a) - common), F.array_join(F.slice(b, common + 1, F.size(b)), "/"))


def metadata_of(document: Column) -> Column:
    """A map of the mapped ``- Key: value`` lines of a document; the last one of a field wins. One pass over the lines, then one over the pairs for each field there is."""
    pattern = r"^- ([^:：]+)[:：]\s*(.*)\z"
    keys = F.create_map(*(F.lit(x) for pair in rules.METADATA_KEYS.items() for x in pair))
    lines = F.filter(F.split(document, r"\r?\n"), lambda x: x.startswith("- ") & x.rlike(pattern))
    pairs = F.transform(lines, lambda x: F.struct(F.try_element_at(keys, trim(F.regexp_extract(x, pattern, 1))).alias("key"), trim(F.regexp_extract(x, pattern, 2)).alias("value")))
    pairs = F.filter(pairs, lambda p: p["key"].isNotNull() & ~p["key"].isin("source_urls", "reference_urls") & (p["value"] != ""))

    def last(pairs: Column) -> Column:
        fields = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["key"])))
        return F.map_from_entries(F.transform(fields, lambda k: F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)))

    return let(pairs, last)


def url_block(document: Column, key: str) -> Column:
    """The URLs listed under a key or beside it, each once, in order."""
    direct = F.regexp_extract_all(document, F.lit(rf"(?m)^- (?:{key})[:：][ \t]*(\S.*?)[ \t]*$"), F.lit(1))
    block = F.regexp_extract(document, rf"(?m)^- (?:{key})[:：][ \t]*$((?:\r?\n(?:- https?://\S.*)?)*)", 1)
    listed = F.regexp_extract_all(block, F.lit(r"(?m)^- (https?://\S.*?)\s*$"), F.lit(1))
    return F.array_distinct(F.concat(direct, listed))


def first_heading(document: Column, fallback: Column) -> Column:
    found = F.get(F.filter(F.split(document, r"\r?\n"), lambda x: x.startswith("# ")), 0)
    return F.coalesce(trim(F.regexp_replace(found, r"^#\s+", "")), fallback)


def body_of(document: Column, marker: str = "Source Text|正文") -> Column:
    """What follows the body marker, without line ends behind; null without a marker."""
    found = F.regexp_extract(document, rf"(?s)(?:^|\n)## (?:{marker})\n\n?(.*)\z", 1)
    return F.when(document.rlike(rf"(?:^|\n)## (?:{marker})\n"), F.rtrim(found, F.lit("\n")))
