"""What built-in expressions cannot say: small helpers, one row at a time.

They take and give whole pages, so they are plain functions of Python, of which Spark sends 100 rows at once; Arrow batches hold 10,000, and a worker several copies of each.
"""

from __future__ import annotations

import functools
import json
import re
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import rules


def _text_udf(f):
    """A function to string, made where it is called: workers import this module without a session."""

    @functools.wraps(f)
    def call(*columns: Column) -> Column:
        return F.udf(f, "string", useArrow=False)(*columns)

    return call


def decoded(text: str) -> str:
    """Text with its entities decoded as ``text.decode_entities`` does: names in their order, then numbers, each in one pass."""
    if "&" not in text:
        return text

    def character(digits: str, base: int) -> str:
        n = int(digits.lstrip("0")[:9] or "0", base)
        return chr(n) if n <= 0x10FFFF and not 0xD800 <= n <= 0xDFFF else "\ufffd"

    for name, char in rules.ENTITIES:
        text = re.sub(f"&{name};", lambda m, char=char: char, text, flags=re.I)
    text = re.sub(r"&#[xX]([0-9a-fA-F]+);", lambda m: character(m[1], 16), text)
    return re.sub(r"&#([0-9]+);", lambda m: character(m[1], 10), text)


#: Most bytes of an artifact once it is unpacked.
MOST_BYTES = 80 << 20


def inflate(raw: bytes, most: int) -> bytes | None:
    """The members of a gzip stream, one after another; null for damaged data, for an unfinished member, and beyond ``most`` bytes. What is behind the last member is left out."""
    out, left = [], most
    while raw[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            out.append(member.decompress(raw, left + 1))
        except zlib.error:
            return None
        left -= len(out[-1])
        if left < 0 or not member.eof:
            return None
        raw = member.unused_data.lstrip(b"\0")
    return b"".join(out)


def decoding_note(content: Column, text: Column) -> Column:
    """Why ``decode_bytes`` has no text for some bytes; null where it has."""
    return F.when(content.isNotNull() & text.isNull(), f"compressed data is damaged or larger than {MOST_BYTES} bytes")


@_text_udf
def decode_bytes(raw: bytes | None) -> str | None:
    """Text of raw bytes: gunzipped by its magic, windows-1252 where declared in the head, else UTF-8 with replacement.

    Null for compressed data that is damaged or unpacks to more than ``MOST_BYTES``; ``decoding_note`` says so.
    """

    if raw is None:
        return None
    if raw[:2] == b"\x1f\x8b":
        plain = inflate(bytes(raw), MOST_BYTES)
        return None if plain is None else plain.decode("utf-8", "replace")
    if re.search(rb"charset=[\"']?(windows-1252|iso-8859-1)", raw[:4096], re.I):
        return raw.decode("cp1252", "replace")
    return raw.decode("utf-8", "replace")


def balanced(html: str, start: int, tag: str) -> str | None:
    """The element that opens at ``start``, to its own end tag; null if it never closes."""
    depth = 0
    for m in re.compile(rf"<(/?){tag}\b[^>]*>", re.I).finditer(html, start):
        if m[1]:
            depth -= 1
            if depth == 0:
                return html[start : m.end()]
        elif not m[0].endswith("/>"):
            depth += 1
    return None


def element(html: str, kind: str, selector: str) -> str | None:
    """The first element with an id, of a tag, or whose class matches a pattern."""
    for m in re.finditer(r"<([a-z0-9]+)\b([^>]*)>", html, re.I):
        attributes = m[2]
        if kind == "tag":
            hit = m[1].lower() == selector
        elif kind == "id":
            found = re.search(r"\bid=([\"'])(.*?)\1", attributes, re.I)
            hit = bool(found) and found[2] == selector
        else:
            found = re.search(r"\bclass=([\"'])([^\"']*)\1", attributes, re.I)
            hit = bool(found) and re.search(selector, found[2], re.I) is not None
        if hit:
            return balanced(html, m.start(), m[1].lower())
    return None


def phrased(html: str) -> str | None:
    """From the heading above a known phrase to the footer after it."""
    at = html.find(rules.COMMUNITIES_PHRASE)
    if at < 0:
        return None
    heading, footer = max(html.rfind("<h1", 0, at), html.rfind("<h2", 0, at)), html.find("<footer", at)
    return html[at if heading < 0 else heading : None if footer < 0 else footer]


def headed_article(html: str) -> str | None:
    """The first heading of the content and its article."""
    content = element(html, "id", "content") or html
    heading = re.search(r"<h1\b[^>]*>.*?</h1>", content, re.I | re.S)
    parts = [heading[0] if heading else None, element(content, "class", r"\barticle\b")]
    return "\n".join(p for p in parts if p) or None


def scope(html: str | None, host: str | None, table=rules.SCOPES) -> str | None:
    if html is None:
        return None
    found = phrased(html) if host == "redditinc.com" else headed_article(html) if host == "douban.com" else None
    for h, kind, selector in table:
        if h == host and found is None:
            found = element(html, kind, selector)
    if host == "uscode.house.gov" and found is not None:
        found = re.sub(r"<(script|style)\b.*?</\1>", "\n", found, flags=re.I | re.S)
        found = re.sub(r"<div\b(?=[^>]*\bclass=([\"'])[^\"']*\bjumpTo\b[^\"']*\1).*?</div>", "\n", found, flags=re.I | re.S)
    for h, mark in rules.SKELETONS:
        if h == host and (found is None or re.search(mark, found, re.I)):
            return ""
    if found is not None:
        ends = [i for h, text in rules.CUT_BEFORE if h == host and (i := found.lower().find(text.lower())) >= 0]
        found = found[: min(ends)] if ends else found
    return html if found is None else found


@_text_udf
def scope_html(html: str | None, host: str | None) -> str | None:
    """The main element of a page by the rules of its host; the whole page where none applies."""
    return scope(html, host)


@_text_udf
def scope_article(html: str | None) -> str | None:
    """The first article element with its nested ones, or the whole page."""
    return None if html is None else element(html, "tag", "article") or html


@_text_udf
def element_by_id(html: str | None, id_: str) -> str | None:
    """The element with an id, with what is nested in it; null where there is none."""
    return None if html is None else element(html, "id", id_)


def flatten(nodes: list, depth: int = 2) -> list[dict]:
    """Level, title and content of the nodes of a forest, depth first, whatever its depth."""
    out, open_ = [], [(n, depth) for n in reversed(nodes)]
    while open_:
        node, level = open_.pop()
        if not isinstance(node, dict):
            continue
        title, content = node.get("title"), node.get("contentXML")
        out.append({"level": min(level, 6), "title": paired(str(title)) if title else None, "content": paired(str(content)) if content else None})
        children = node.get("children")
        open_ += [(c, level + 1) for c in reversed(children if isinstance(children, list) else [])]
    return out


def tree_nodes(tree: Column) -> Column:
    """``level, title, content`` of each node of a JSON list of nodes; null for what is no such list."""

    def one(text: str | None) -> list[dict] | None:
        try:
            nodes = json.loads(text) if text else None
        except (ValueError, RecursionError):
            return None
        return flatten(nodes) if isinstance(nodes, list) else None

    return F.udf(one, "array<struct<level:int,title:string,content:string>>", useArrow=False)(tree)


def paired(text: str) -> str:
    """Text whose escapes gave halves of characters: pairs of them as one character, others as the replacement character."""
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if re.search("[\ud800-\udfff]", text) else text


@_text_udf
def unescape_literal(raw: str | None) -> str | None:
    """The value of a quoted script literal's body, by its escapes alone; nothing is evaluated."""
    if raw is None:
        return None
    plain = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f", "v": "\v", "0": "\0"}
    return paired(re.sub(r"\\(?:u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|(.))", lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else plain.get(m[3], m[3]), raw, flags=re.S))


def embedded_literal(html: Column, phrase: str) -> Column:
    """The first ``JSON.parse('...')`` literal that holds a phrase once its escapes are undone."""
    # each ends at the first quote without a backslash before it; no group is repeated, as long literals would exhaust the stack
    starts = F.slice(F.split(html, r"JSON\.parse\('"), F.lit(2), F.lit(1 << 30))
    literals = F.filter(F.transform(starts, lambda x: F.regexp_extract(x, r"(?s)\A(.*?)(?<!\\)'\)", 1)), lambda x: (x != "") & ~x.rlike(r"(?<!\\)'"))
    # one call of the helper for all literals of a page: a character that no text has stands between them
    plain = F.split(unescape_literal(F.array_join(literals, "\x1d")), "\x1d")
    return F.get(F.filter(plain, lambda x: F.contains(x, F.lit(phrase))), 0)
