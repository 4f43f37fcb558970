"""The library's operators on the given tables, each with the SQL that says the same.

Bindings: artifacts are ``pages``; entries are ``documents`` (id = doc_id, collection = lang, group = source); tags and flags are
``labels``; required phrases are ``benchmark``; parts of bodies are ``conversations``; attempts and JSON payloads are ``events``. Faults for the
checks follow from ids, so that the SQL makes the same ones.
"""

from __future__ import annotations

import gzip
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import helpers, rules, text, urls
from corpusloom.operators import assembly, entries, indexes, links, verification
from corpusloom.sources import readers, writers
from corpusloom.sources.shared import cut, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- SQL fragments ---

SQL_ANCHOR = r"(?is)<a\b[^>]*?href=(?:\"([^\"]*)\"|'([^']*)')[^>]*>(.*?)</a>"


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sub(x: str, *pairs: tuple[str, str]) -> str:
    for pattern, by in pairs:
        x = f"regexp_replace({x}, {q(pattern)}, {q(by)}, 'g')"
    return x


def sql_trim(x: str) -> str:
    return sub(x, (f"^{text.SPACE}+", ""), (f"{text.SPACE}+$", ""))


def sql_decode(x: str) -> str:
    return sub(x, *((f"(?i)&{name};", char) for name, char in rules.ENTITIES))


def sql_clean(x: str) -> str:
    pairs = ((r"\x{00A0}", " "), (r"\r", "\n"), (r"[ \t\f\x0B]+", " "), (r"\n[ \t]+", "\n"), (r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n"))
    return sql_trim(sub(sql_decode(x), *pairs))


def sql_text(x: str) -> str:
    return sql_clean(sub(x, ("<[^>]+>", " ")))


def sql_lines(x: str) -> str:
    out = sub(x, *((rf"(?is)<{t}\b.*?</{t}>", "\n") for t in rules.NOISE_TAGS), (r"(?s)<!--.*?-->", "\n"))
    out = sub(out, (rf"(?i)</?(?:{rules.BLOCK_TAGS})\b[^>]*>", "\n"), (r"(?i)<li\b[^>]*>", "\n- "), (r"(?i)<br\s*/?\s*>", "\n"), (r"<[^>]+>", " "))
    return f"list_filter(string_split({sql_clean(out)}, chr(10)), lambda x: x <> '')"


def sql_let(x: str, body) -> str:
    """``body`` of a name for ``x``, worked out once."""
    sql_let.names += 1
    v = f"v{sql_let.names}"
    return f"list_transform([{x}], lambda {v}: {body(v)})[1]"


sql_let.names = 0


def sql_escaped(x: str) -> str:
    """A reference with all beyond ASCII escaped."""
    return f"array_to_string(list_transform(string_split({x}, ''), lambda c: CASE WHEN ord(c) > 127 THEN url_encode(c) ELSE c END), '')"


def sql_linked(x: str, origin: str, target=lambda u: u) -> str:
    """Paired anchors with root-relative targets, the only ones in the tables at hand, as Markdown links; as text without an origin."""
    P = q(SQL_ANCHOR)

    def one(m: str) -> str:
        def shown(t: str) -> str:
            u = f"({origin} || {sql_escaped(m + '.h[i]')})"
            return f"CASE WHEN {t} = '' THEN ' ' ELSE " + (f"' ' || {t} || ' '" if not origin else f"' [' || {t} || '](' || {target(u)} || ') '") + " END"

        new = sql_let(sql_text(f"{m}.t[i]"), shown)
        return f"array_to_string(list_transform(range(1, len({m}.s) + 1), lambda i: {m}.s[i] || CASE WHEN i <= len({m}.h) THEN {new} ELSE '' END), '')"

    return sql_let(x, lambda z: sql_let(f"{{'s': string_split_regex({z}, {P}), 'h': regexp_extract_all({z}, {P}, 1), 't': regexp_extract_all({z}, {P}, 3)}}", one))


def sql_linked_lines(x: str, origin: str, target=lambda u: u) -> str:
    out = sub(x, *((rf"(?is)<{t}\b.*?</{t}>", "\n") for t in rules.NOISE_TAGS), (r"(?s)<!--.*?-->", "\n"))
    return sql_lines(sql_linked(out, origin, target))


def sql_chromeless(x: str) -> str:
    return sub(x, *((rf"(?is)<{t}\b.*?</{t}>", "\n") for t in rules.CHROME_TAGS), (r"(?i)<input\b[^>]*>", "\n"))


def sql_article(x: str = "html") -> str:
    found = f"regexp_extract({x}, {q('(?is)<article[^>]*>.*?</article>')})"
    return f"CASE WHEN {found} <> '' THEN {found} ELSE {x} END"


SQL_PARTS = r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def sql_part(x: str, n: int) -> str:
    return f"regexp_extract({x}, {q(SQL_PARTS)}, {n})"


def sql_base(x: str) -> str:
    return f"(lower({sql_part(x, 1)}) || '://' || lower({sql_part(x, 2)}) || CASE WHEN {sql_part(x, 3)} = '' THEN '/' ELSE {sql_part(x, 3)} END)"


def sql_canonical(x: str) -> str:
    query_ = sql_part(x, 4)
    kept = f"array_to_string(list_filter(string_split(ltrim({query_}, '?'), '&'), lambda f: NOT starts_with(f, 'utm_')), '&')"
    return f"({sql_base(x)} || CASE WHEN NOT regexp_matches({query_}, '[?&]utm_') THEN {query_} WHEN {kept} = '' THEN '' ELSE '?' || {kept} END)"


def sql_aliases(x: str) -> str:
    """The general aliases; the site aliases do not occur in the tables at hand."""
    bare = f"('scheme:' || lower({sql_part(x, 2)}) || CASE WHEN {sql_part(x, 3)} = '' THEN '/' ELSE {sql_part(x, 3)} END)"
    return f"[{sql_canonical(x)}, {bare} || {sql_part(x, 4)}, {sql_base(x)}, {bare}]"


#: Aliases of a column as rows (u, rank, alias), the first rank of each.
def sql_alias_rows(source: str) -> str:
    return f"SELECT u, min(rank) AS rank, alias FROM (SELECT u, unnest(range(0, 4)) AS rank, unnest({sql_aliases('u')}) AS alias FROM (SELECT DISTINCT u FROM ({source}))) GROUP BY u, alias"


SQL_LINKS = f"""
  SELECT page_id, ordinal, lower({sql_part('url', 1)}) || '://' || lower({sql_part('url', 2)}) || {sql_escaped('href')} AS u, inner_ FROM (
    SELECT page_id, url, unnest(range(0, len(h))) AS ordinal, unnest(h) AS href, unnest(t) AS inner_ FROM (
      SELECT page_id, url, regexp_extract_all(html, {q(SQL_ANCHOR)}, 1) AS h, regexp_extract_all(html, {q(SQL_ANCHOR)}, 3) AS t FROM pages))"""


# --- the flagship: what each site yields ---


@query(
    f"""WITH b AS (SELECT regexp_replace(lower({sql_part('url', 2)}), '^www\\.', '') AS host, {sql_clean("array_to_string(" + sql_lines(sql_article()) + ", chr(10) || chr(10))")} AS body FROM pages)
SELECT host, count(*) AS pages, CAST(count(*) FILTER (length(body) >= 500) AS BIGINT) AS valid, CAST(coalesce(sum(length(body)) FILTER (length(body) >= 500), 0) AS BIGINT) AS chars FROM b GROUP BY host"""
)
def site_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5, T6, J2: for each site, how many pages yield a valid body, and how long it is."""
    pages = table(spark, sf_dir, "pages")
    body = F.array_join(text.html_to_lines(text.first_article(F.col("html"))), "\n\n")
    rows = pages.select(text.host_of(F.col("url")).alias("host"), assembly.validate(body, F.lit(None).cast("array<string>")).alias("x"))
    good = F.col("x.status") == "extracted"
    return rows.groupBy("host").agg(F.count("*").alias("pages"), F.count_if(good).cast("long").alias("valid"), F.coalesce(F.sum(F.when(good, F.length("x.text"))), F.lit(0)).cast("long").alias("chars"))


# --- selection ---


def entry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 0).alias("enabled"))
    docs = table(spark, sf_dir, "documents")
    return docs.join(labels, "doc_id", "left").select(F.col("doc_id").alias("id"), F.col("lang").alias("collection"), F.col("source").alias("platform_group"), "enabled", "n_chars")


@query("SELECT d.doc_id AS id, lang AS collection, n_chars FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(toxic, 0) = 0 AND lang IN ('en', 'de')")
def p1_select_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries.select_entries(entry_rows(spark, sf_dir), collections=["en", "de"]).select("id", "collection", "n_chars")


@query("""WITH e AS (SELECT page_id AS id, url, CASE WHEN page_id % 3 = 0 THEN [url] ELSE [url, url || '&alt=1'] END AS s, CASE WHEN page_id % 2 = 0 THEN [url || '#ref'] END AS r FROM pages)
SELECT id, 'source' AS role, unnest(range(0, len(s))) AS ordinal, unnest(s) AS url FROM e UNION ALL SELECT id, 'reference', 0, r[1] FROM e WHERE r IS NOT NULL""")
def p2_explode_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("array<string>")
    rows = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), F.when(F.col("page_id") % 3 == 0, F.col("url")).alias("source_url"),
        F.when(F.col("page_id") % 3 != 0, F.array("url", F.concat("url", F.lit("&alt=1")))).alias("source_urls"),
        F.when(F.col("page_id") % 2 == 0, F.array(F.concat("url", F.lit("#ref")))).alias("reference_urls"), none.alias("linked_source_urls"),
    )
    return entries.explode_sources(rows).withColumn("ordinal", F.col("ordinal").cast("long"))


@query("""WITH p AS (SELECT page_id, CASE page_id % 7 WHEN 0 THEN url || '.json' WHEN 1 THEN url || '.PDF' WHEN 2 THEN 'https://a.b/x.txt' WHEN 3 THEN 'https://a.b/x.xml?y=1' ELSE url END AS url,
  CASE page_id % 5 WHEN 0 THEN 'text/plain' WHEN 1 THEN 'application/pdf' WHEN 2 THEN 'text/html' END AS kind, CASE WHEN page_id % 11 = 0 THEN '.md' END AS ext FROM pages),
r AS (SELECT *, lower(regexp_extract(url, '^[a-zA-Z][^:]*://[^/?#]*([^?#]*)', 1)) AS path, lower(regexp_extract(url, '^[a-zA-Z][^:]*://[^/?#]*([^#]*)', 1)) AS search, coalesce(kind, '') AS k FROM p)
SELECT page_id, CASE WHEN page_id % 13 = 0 THEN 'pdf' WHEN ext IS NOT NULL THEN ltrim(ext, '.') WHEN path LIKE '%.json' OR k LIKE '%json%' OR url LIKE '%/rule_out_api/%' OR url LIKE '%/oacontract/%' THEN 'json'
  WHEN search LIKE '%.pdf%' OR k LIKE '%pdf%' THEN 'pdf' WHEN path LIKE '%.txt' OR k LIKE '%text/plain%' THEN 'txt' WHEN path LIKE '%.xml' OR k LIKE '%xml%' THEN 'xml' ELSE 'html' END AS type FROM r""")
def p3_artifact_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, url = F.col("page_id"), F.col("url")
    shown = F.when(n % 7 == 0, F.concat(url, F.lit(".json"))).when(n % 7 == 1, F.concat(url, F.lit(".PDF"))).when(n % 7 == 2, "https://a.b/x.txt").when(n % 7 == 3, "https://a.b/x.xml?y=1").otherwise(url)
    kind = F.when(n % 5 == 0, "text/plain").when(n % 5 == 1, "application/pdf").when(n % 5 == 2, "text/html")
    none = F.lit(None).cast("string")
    content = F.encode(F.concat(F.when(n % 13 == 0, "%PDF-1.7 ").otherwise(""), "html"), "UTF-8")
    return table(spark, sf_dir, "pages").select("page_id", text.sniffed_type(text.artifact_type(shown, kind, F.when(n % 11 == 0, ".md"), none, none), content).alias("type"))


def challenged(html: Column) -> Column:
    n = F.col("page_id")
    return F.concat(F.when(n % 7 == 0, "<title> Just a Moment...</title>").when(n % 7 == 1, "<p>Security Verification</p>").when(n % 7 == 2, "<i>x__cf_chl_y</i>").otherwise(""), html)


SQL_CHALLENGED = "(CASE page_id % 7 WHEN 0 THEN '<title> Just a Moment...</title>' WHEN 1 THEN '<p>Security Verification</p>' WHEN 2 THEN '<i>x__cf_chl_y</i>' ELSE '' END || html)"


def sql_challenge(x: str) -> str:
    return "(" + " OR ".join(f"regexp_matches(substr({x}, 1, {rules.CHALLENGE_WINDOW}), {q('(?i)' + p)})" for p in rules.CHALLENGE) + ")"


@query(f"SELECT page_id, {sql_challenge(SQL_CHALLENGED)} AS challenge FROM pages")
def p4_challenge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.is_challenge_page(challenged(F.col("html"))).alias("challenge"))


@query("""WITH c AS (SELECT user_id AS id, event_id % 3 AS ordinal, event_id AS artifact, event_type = 'view' OR event_id % 4 = 0 AS cached, event_id % 5 = 0 AS failed, event_id % 7 = 0 AS challenge,
  CASE event_id % 4 WHEN 0 THEN 'html' WHEN 1 THEN 'pdf' WHEN 2 THEN 'json' ELSE 'txt' END AS type FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY id, ordinal, cached ORDER BY CASE WHEN type = 'txt' THEN 0 ELSE list_position(['html', 'pdf', 'txt', 'xml', 'json'], type) END, artifact) AS nth FROM c),
b AS (SELECT *, row_number() OVER (PARTITION BY id, ordinal ORDER BY cached, nth) AS best FROM n WHERE NOT challenge AND NOT failed AND (NOT cached OR nth = 1))
SELECT id, ordinal, artifact, cached, type FROM b WHERE best = 1""")
def p5_choose_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    kind = F.when(n % 4 == 0, "html").when(n % 4 == 1, "pdf").when(n % 4 == 2, "json").otherwise("txt")
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), (n % 3).alias("ordinal"), n.alias("artifact"), ((F.col("event_type") == "view") | (n % 4 == 0)).alias("cached"), (n % 5 == 0).alias("failed"),
        F.when(n % 7 == 0, "security verification").otherwise("good").alias("text"), kind.alias("type"), F.lit("txt").alias("expected"),
    )
    return entries.choose_artifact(rows).select("id", "ordinal", "artifact", "cached", "type")


SQL_SITE = f"regexp_replace(lower({sql_part('url', 2)}), '^www\\.', '')"
SQL_HOSTS = f"CASE WHEN {SQL_SITE} LIKE '%example.com' THEN regexp_replace({SQL_SITE}, 'example.com$', 'tiktok.com') WHEN {SQL_SITE} LIKE '%example.net' THEN 'tiktok.com' WHEN page_id % 2 = 0 THEN 'support.tiktok.com' ELSE {SQL_SITE} END"
SQL_PATHS = f"lower(CASE page_id % 3 WHEN 0 THEN '/legal/report' WHEN 1 THEN '/Community-Guidelines' ELSE '' END || {sql_part('url', 3)})"


@query(f"""WITH p AS (SELECT page_id, {SQL_HOSTS} AS host, {SQL_PATHS} AS path, least(page_id % 5, len({sql_lines('html')})) AS n FROM pages)
SELECT page_id, n AS lines FROM p WHERE NOT (host = 'tiktok.com' AND starts_with(path, '/legal/report/')) AND NOT (host LIKE '%tiktok.com' AND path NOT LIKE '%/community-guidelines%' AND n <= 2) AND NOT (host = 'support.tiktok.com' AND n = 0)""")
def p6_drop_low_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by the first lines of their text, two thirds of them as of a site with rules."""
    n, site, path = F.col("page_id"), text.host_of(F.col("url")), text.path_of(F.col("url"))
    host = F.when(site.endswith("example.com"), F.regexp_replace(site, r"example.com\z", "tiktok.com")).when(site.endswith("example.net"), "tiktok.com").when(n % 2 == 0, "support.tiktok.com").otherwise(site)
    path = F.concat(F.when(n % 3 == 0, "/legal/report").when(n % 3 == 1, "/Community-Guidelines").otherwise(""), path)
    rows = table(spark, sf_dir, "pages").select("page_id", host.alias("host"), path.alias("path"), F.slice(text.html_to_lines(F.col("html")), F.lit(1), (n % 5).cast("int")).alias("lines"))
    return entries.drop_low_value(rows).select("page_id", F.size("lines").cast("long").alias("lines"))


@query("""SELECT doc_id, '{' || array_to_string(list_filter(['"doc_id":' || doc_id, CASE WHEN lang <> 'en' THEN '"lang":"' || lang || '"' END, CASE WHEN doc_id % 2 = 0 THEN '"tags":["' || source || '"]' END, '"n_chars":' || n_chars], lambda x: x IS NOT NULL), ',') || '}' AS record FROM documents""")
def p7_compact_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("lang"), F.when(F.col("doc_id") % 2 == 0, F.array("source")).otherwise(F.array().cast("array<string>")).alias("tags"), "n_chars")
    return rows.select("doc_id", entries.compact_record(rows, ["doc_id", "lang", "tags", "n_chars"]).alias("record"))


# --- text ---


@query(f"SELECT page_id, sha256({sql_decode('html')}) AS hash FROM pages")
def t2_decode_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.content_hash(text.decode_entities(F.col("html"))).alias("hash"))


@query(f"SELECT doc_id, sha256({sql_clean('text')}) AS hash FROM documents")
def t3_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.content_hash(text.clean_text(F.col("text"))).alias("hash"))


@query(f"SELECT page_id, sha256({sql_text('html')}) AS hash FROM pages")
def t4_html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.content_hash(text.html_to_text(F.col("html"))).alias("hash"))


@query(f"SELECT page_id, CAST(len(l) AS BIGINT) AS lines, sha256(array_to_string(l, chr(10))) AS hash FROM (SELECT page_id, {sql_lines('html')} AS l FROM pages)")
def t5_html_to_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", text.html_to_lines(F.col("html")).alias("l"))
    return rows.select("page_id", F.size("l").cast("long").alias("lines"), text.content_hash(F.array_join("l", "\n")).alias("hash"))


@query(f"SELECT page_id, CAST(length(a) AS BIGINT) AS chars, sha256(a) AS hash FROM (SELECT page_id, {sql_article()} AS a FROM pages)")
def t6_scope_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", helpers.scope_article(F.col("html")).alias("a"))
    return rows.select("page_id", F.length("a").cast("long").alias("chars"), text.content_hash(F.col("a")).alias("hash"))


SQL_SCOPED = f"CASE WHEN page_id % 2 = 0 THEN {sql_article()} ELSE html END"


@query(f"SELECT page_id, sha256({sql_chromeless(SQL_SCOPED)}) AS hash FROM pages")
def t6_scope_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main element of a host with rules, the page of any other, both without what is around the text."""
    host = F.when(F.col("page_id") % 2 == 0, "linkedin.com").otherwise("example.org")
    return table(spark, sf_dir, "pages").select("page_id", text.content_hash(text.drop_chrome(helpers.scope_html(F.col("html"), host))).alias("hash"))


@query("""SELECT page_id, CASE WHEN page_id % 5 = 4 THEN NULL WHEN page_id % 5 = 2 THEN sha256('<meta charset=windows-1252>' || html) WHEN page_id % 5 = 3 THEN sha256(html || html) ELSE sha256(html) END AS hash, page_id % 5 = 4 AS noted FROM pages""")
def t1_decode_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as UTF-8, compressed, in windows-1252, compressed as two members, and compressed with a damaged byte."""

    def packed(text: str, n: int) -> bytes:
        way, zipped = n % 5, gzip.compress(text.encode())
        plain = ("<meta charset=windows-1252>" + text).encode("cp1252", "replace") if way == 2 else text.encode()
        return (plain, zipped, plain, zipped * 2, zipped[:-6] + bytes([zipped[-6] ^ 1]) + zipped[-5:])[way]

    rows = table(spark, sf_dir, "pages").select("page_id", F.udf(packed, "binary", useArrow=False)("html", "page_id").alias("content"))
    rows = rows.withColumn("text", helpers.decode_bytes(F.col("content")))
    return rows.select("page_id", text.content_hash(F.col("text")).alias("hash"), helpers.decoding_note(F.col("content"), F.col("text")).isNotNull().alias("noted"))


@query(f"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {sql_trim('x')}), lambda x: x <> '') AS l FROM documents),
a AS (SELECT doc_id, CASE WHEN len(list_filter(l, lambda x: contains(x, 'the'))) > 0 THEN l[list_position(list_transform(l, lambda x: contains(x, 'the')), true):] ELSE l END AS l FROM l),
b AS (SELECT doc_id, l, list_position(list_transform(l[2:], lambda x: contains(x, 'and')), true) AS stop FROM a)
SELECT doc_id, sha256(array_to_string(list_filter(CASE WHEN stop > 0 THEN l[:stop] ELSE l END, lambda x: NOT regexp_matches(x, '(?i)license|rights')), chr(10))) AS hash FROM b""")
def t7_slice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = text.slice_lines(F.split("text", "\n"), F.lit("the"), F.lit("and"), F.lit(False), F.array(F.lit("license|rights")))
    return table(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.array_join(lines, "\n")).alias("hash"))


@query("""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l, doc_id % 3 = 0 AS d FROM documents),
m AS (SELECT doc_id, d, list_concat(l[:1], ['Was this helpful?', 'Tags', 'TikTok Support'], l[2:2], ['related Articles'], l[3:]) AS l FROM l),
c AS (SELECT doc_id, d, l, list_position(list_transform(l, lambda x: x = 'related Articles' OR (d AND x = 'Tags')), true) AS e FROM m)
SELECT doc_id, sha256(array_to_string(list_filter(l[:e - 1], lambda x: x <> 'Was this helpful?'), chr(10))) AS hash FROM c""")
def t8_trim_chrome(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.split("text", "\n")
    lines = F.concat(F.slice(raw, 1, 1), F.array(F.lit("Was this helpful?"), F.lit("Tags"), F.lit("TikTok Support")), F.slice(raw, 2, 1), F.array(F.lit("related Articles")), F.slice(raw, 3, 1_000_000_000))
    host = F.when(F.col("doc_id") % 3 == 0, "discord.com").otherwise("example.org")
    return table(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.array_join(text.trim_chrome(lines, host), "\n")).alias("hash"))


@query(f"SELECT doc_id, sha256({sql_clean('text')}) AS hash FROM documents")
def t9_clean_pdf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps and page numbers go in between; what remains is the cleaned text."""
    stamped = F.concat(F.lit("Page 3\n"), "text", F.lit("\n-12-\nHB1234\nUtah Code\n123456"))
    return table(spark, sf_dir, "documents").select("doc_id", text.content_hash(text.clean_pdf_lines(stamped, F.lit("le.utah.gov"))).alias("hash"))


SQL_P = r"(?is)<p\b[^>]*>.*?</p>"


def sql_paragraph(x: str) -> str:
    out = sub(x, (r"(?is)<script\b.*?</script>", ""), (r"(?is)<style\b.*?</style>", ""), (r"(?i)<br\s*/?\s*>", "\n"), ("<[^>]+>", ""))
    return sql_trim(sub(sub(out, *((f"(?i)&{name};", char) for name, char in rules.PARAGRAPH_ENTITIES)), (f"{text.SPACE}+", " ")))


SQL_PARAGRAPHS = f"p AS (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, {q(SQL_P)}), lambda x: {sql_paragraph('x')}), lambda x: x <> '') AS p FROM pages)"


@query(f"WITH {SQL_PARAGRAPHS} SELECT page_id, CAST(len(p) AS BIGINT) AS paragraphs, sha256(array_to_string(p, chr(10))) AS hash, len(p) <> 5 AS unexpected FROM p")
def t10_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", text.paragraphs(F.col("html")).alias("p"))
    return rows.select("page_id", F.size("p").cast("long").alias("paragraphs"), text.content_hash(F.array_join("p", "\n")).alias("hash"), (F.size("p") != 5).alias("unexpected"))


@query(f"""WITH {SQL_PARAGRAPHS}, x AS (SELECT page_id, p, p[2] AS title, left(p[4], 25) AS footer FROM p),
y AS (SELECT page_id, p, list_position(p, title) AS s, len(list_filter(p, lambda x: x = title)) AS n, list_position(list_transform(p, lambda x: contains(x, footer)), true) AS e FROM x),
z AS (SELECT page_id, CASE WHEN n > 1 THEN 'duplicate document title in paragraph extraction' WHEN coalesce(s, 0) = 0 OR coalesce(e, 0) = 0 OR e <= s THEN 'could not locate document body boundaries' END AS error, p[s:e - 1] AS body FROM y)
SELECT page_id, coalesce(error, CASE WHEN len(body) <> 2 THEN 'expected 2 paragraphs, found ' || len(body) END) AS error, CASE WHEN error IS NULL THEN sha256(array_to_string(body, chr(10))) END AS hash FROM z""")
def t10_paragraphs_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the second paragraph to before the first that holds the beginning of the fourth."""
    rows = table(spark, sf_dir, "pages").select("page_id", text.paragraphs(F.col("html")).alias("p"))
    rows = rows.select("page_id", text.paragraphs_between(F.col("p"), F.get("p", 1), F.left(F.get("p", 3), F.lit(25)), F.lit(2)).alias("x"))
    return rows.select("page_id", "x.error", text.content_hash(F.array_join("x.paragraphs", "\n")).alias("hash"))


def dispatched(rows: DataFrame) -> DataFrame:
    return assembly.dispatch_extractor(rows).select("page_id", text.content_hash(F.col("text")).alias("hash"), (F.col("note") != "").alias("noted"))


@query(f"""SELECT page_id, sha256('Page ' || page_id || chr(10) || chr(10) || '发布时间：2024-05-06' || chr(10) || chr(10) || '## Part' || chr(10) || chr(10) || array_to_string({sql_linked_lines("html", "")}, chr(10) || chr(10))) AS hash, CAST(NULL AS BOOLEAN) AS noted FROM pages""")
def t11_json_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule in JSON with the page as its only section; without an address its links are text."""
    section = F.array(F.struct(F.lit("Part").alias("moduleName"), F.col("html").alias("rawContent")))
    info = F.struct(F.concat(F.lit("Page "), "page_id").alias("ruleName"), F.lit("2024-05-06").alias("releaseTime"), section.alias("section"))
    content = F.to_json(F.struct(F.struct(info.alias("info")).alias("data")))
    return dispatched(table(spark, sf_dir, "pages").select("page_id", "url", content.alias("content"), F.lit("tencent-rule-json").alias("extractor"), F.lit("json").alias("type")))


@query(f"""SELECT page_id, sha256('## 违法违禁 ' || page_id || chr(10) || chr(10) || array_to_string({sql_linked_lines("html", "")}, chr(10) || chr(10)) || chr(10) || chr(10) || '### Part' || chr(10) || chr(10) || array_to_string({sql_linked_lines(sql_article(), "")}, chr(10) || chr(10)) || chr(10) || chr(10) || '#### Leaf' || chr(10) || chr(10) || 'x' || chr(10) || chr(10) || '## Last') AS hash, CAST(NULL AS BOOLEAN) AS noted FROM pages""")
def t12_node_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of nodes in a script literal, with the page and its article as contents: titles by depth, contents as lines."""
    leaf = F.array(F.struct(F.lit("Leaf").alias("title"), F.lit("<p>x</p>").alias("contentXML")))
    part = F.array(F.struct(F.lit("Part").alias("title"), text.first_article(F.col("html")).alias("contentXML"), leaf.alias("children")))
    one = F.to_json(F.struct(F.concat(F.lit("违法违禁 "), "page_id").alias("title"), F.col("html").alias("contentXML"), part.alias("children")))
    one = F.replace(F.replace(one, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    content = F.concat(F.lit("<script>var a = JSON.parse('{\"no\":1}'); var b = JSON.parse('["), one, F.lit(',{"title":"Last"}]\');</script>'))
    return dispatched(table(spark, sf_dir, "pages").select("page_id", "url", content.alias("content"), F.lit("bilibili-convention-js").alias("extractor"), F.lit("html").alias("type")))


@query(f"""SELECT doc_id, sha256({sql_clean("text || ' [more](https://x.org/' || doc_id || ') gone' || chr(10) || chr(10) || '### ' || lang || chr(10) || chr(10) || '- one' || chr(10) || '- two' || chr(10) || 'said so'")}) AS hash FROM documents""")
def t13_bbcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat("text", F.lit(" [url=https://x.org/"), "doc_id", F.lit("][b]more[/b][/url] [url=mailto:x]gone[/url][h2]"), "lang", F.lit("[/h2][list][*]one[*]two[/list][quote]said[/quote] [code]so[/code][hr][/hr]"))
    rows = links.apart(table(spark, sf_dir, "documents").select("doc_id", raw.alias("raw")), "hrefs", text.bbcode_references(F.col("raw")))
    rows = rows.withColumn("leads", urls.resolved_map(F.col("hrefs"), F.lit("https://b.org/")))
    return rows.select("doc_id", text.content_hash(text.bbcode_to_markdown(F.col("raw"), lambda h: F.try_element_at("leads", h))).alias("hash"))


@query("""SELECT page_id, sha256('# 2 first' || chr(10) || chr(10) || 'body ' || page_id || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '# 10 second' || chr(10) || chr(10) || '[more](' || regexp_extract(url, '^[a-zA-Z]+://[^/?#]*') || '/x)') AS hash, CAST(NULL AS BOOLEAN) AS noted FROM pages""")
def t13_faq_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of a store in an attribute, in the order of their numbers."""
    store = F.concat(F.lit('{"faqs":{"10":{"title":"10 second","content":"[url=/x]more[/url]"},"2":{"title":"2 first","content":"[b]body[/b] '), "page_id", F.lit('"},"3":{"title":"empty"}}}'))
    content = F.concat(F.lit('<div data-faqstore="'), F.replace(store, F.lit('"'), F.lit("&quot;")), F.lit('"></div>'))
    return dispatched(table(spark, sf_dir, "pages").select("page_id", "url", content.alias("content"), F.lit("steam-faqstore-json").alias("extractor"), F.lit("html").alias("type")))


SQL_ORIGIN = f"(lower({sql_part('url', 1)}) || '://' || lower({sql_part('url', 2)}))"
SQL_INNER = f"regexp_extract(html, {q('(?is)<article[^>]*>(.*?)</article>')}, 1)"


@query(f"""WITH a AS (SELECT page_id, {sql_linked_lines(SQL_INNER, SQL_ORIGIN)} AS l FROM pages)
SELECT page_id, sha256(array_to_string(CASE page_id % 3 WHEN 0 THEN list_concat(['Policy X', 'May 2024'], list_filter(l, lambda x: x <> '-')) WHEN 1 THEN l ELSE list_concat(['# Title ' || page_id], l) END, chr(10) || chr(10))) AS hash, CAST(NULL AS BOOLEAN) AS noted FROM a""")
def t14_help_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of each page in the three layouts of help centres."""
    n, inner = F.col("page_id"), F.regexp_extract("html", r"(?is)<article\b[^>]*>(.*?)</article>", 1)
    x = F.concat(F.lit('<nav>menu</nav><main class=a id="twtr-main"><p>-</p><p>Menu</p><p>Policy X</p><p>May 2024</p><div>'), inner, F.lit("</div><p>Share this article</p><p>end</p></main>"))
    g = F.concat(F.lit("<h1 id='title-h1'>Title <b>"), n, F.lit("</b></h1><section id=\"article-contents\">"), inner, F.lit("</section><p>end</p>"))
    way = F.when(n % 3 == 0, "x-help-html").when(n % 3 == 1, "google-help-article").otherwise("github-docs-article")
    return dispatched(table(spark, sf_dir, "pages").select("page_id", "url", F.when(n % 3 == 0, x).when(n % 3 == 1, F.col("html")).otherwise(g).alias("content"), way.alias("extractor"), F.lit("html").alias("type")))


@query(r"SELECT doc_id, sha256(text) AS hash, CAST(len(list_filter(string_split_regex(text, '\n{2,}'), lambda x: regexp_matches(x, '\S'))) AS BIGINT) AS paragraphs FROM documents")
def t15_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.col("text")).alias("hash"), text.paragraph_count(F.col("text")).alias("paragraphs"))


SQL_HOST = f"regexp_replace(lower({sql_part('url', 2)}), '^www\\.', '')"


@query(f"""WITH p AS (SELECT page_id, regexp_replace({SQL_HOST}, '(?i)[^a-z0-9]+', '-', 'g') AS host, list_filter(string_split({sql_part('url', 3)}, '/'), lambda x: x <> '') AS parts FROM pages),
s AS (SELECT page_id, host, lower({sub(sub("regexp_replace(array_to_string(parts[-2:], '-'), '(?i)\\.[a-z0-9]+$', '')", ('(?i)[^a-z0-9]+', '-')), ('^-|-$', ''))}) AS path FROM p)
SELECT page_id, 'e' || page_id || CASE WHEN page_id % 2 = 1 THEN '-02' ELSE '' END || '.' || host || '.html' AS name, 'e' || page_id || '-linked-' || lpad(CAST(page_id % 5 + 1 AS VARCHAR), 2, '0') || '-' || CASE WHEN path = '' THEN 'linked-source' ELSE path END || '.' || host || '.html' AS linked,
  '../../b/' || page_id || '.html' AS relative FROM s""")
def t16_artifact_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, entry = F.col("page_id"), F.concat(F.lit("e"), F.col("page_id"))
    return table(spark, sf_dir, "pages").select(
        "page_id", text.artifact_name(entry, n % 2, n % 2 + 1, F.col("url"), F.lit("html")).alias("name"), text.linked_artifact_name(entry, n % 5, F.col("url"), F.lit("html")).alias("linked"),
        text.relative_path(F.concat(F.lit("top/a/x/"), n, F.lit(".md")), F.concat(F.lit("top/b/"), n, F.lit(".html"))).alias("relative"),
    )


def documents_as_markdown(spark: SparkSession, sf_dir: str, linked: bool = False) -> DataFrame:
    """Rule documents made of the table: path, document. With ``linked`` their bodies end in links."""
    n = F.col("doc_id")
    body = linked_body() if linked else F.col("text")
    document = F.concat(
        F.lit("# Document "), n, F.lit("\n\n- Collection: "), "lang", F.lit("\n- Source URL:\n- https://a.org/"), n, F.lit("\n- https://b.org/"), n % 10, F.lit("\n- 语言组：x\n- Language: first\n- Language: "), "source",
        F.when(n % 19 == 0, "\n").otherwise("\n- Scope Note: s\n"), F.when(n % 13 == 0, "\n## Source Stub\n").otherwise(F.concat(F.lit("\n## Source Text\n\n"), body, F.lit("\n"))),
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.concat("lang", F.lit("/"), "source", F.lit("/"), n, F.lit(".md")).alias("path"), document.alias("document"), "text")


@query(r"""SELECT doc_id, 'Document ' || doc_id AS heading, lang AS collection, source AS language, 'x' AS language_group, 'https://a.org/' || doc_id || ' https://b.org/' || (doc_id % 10) AS source_urls,
  CASE WHEN doc_id % 13 = 0 THEN NULL ELSE sha256(regexp_replace(text, '\n+$', '')) END AS body_hash FROM documents""")
def t17_rule_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents_as_markdown(spark, sf_dir).withColumn("m", text.metadata_of(F.col("document")))
    return rows.select("doc_id", text.first_heading(F.col("document"), F.col("path")).alias("heading"), *(F.try_element_at("m", F.lit(k)).alias(k) for k in ("collection", "language", "language_group")), F.array_join(text.url_block(F.col("document"), "Source URL|来源链接"), " ").alias("source_urls"), text.content_hash(text.body_of(F.col("document"))).alias("body_hash"))


# --- URLs and links ---


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.extract_links(table(spark, sf_dir, "pages"))


@query(f"SELECT page_id, ordinal, u AS url FROM ({SQL_LINKS})")
def l1_resolve_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(spark, sf_dir).select("page_id", F.col("ordinal").cast("long").alias("ordinal"), "url")


@query(f"SELECT page_id, {sql_canonical('url')} AS canonical FROM pages")
def l2_canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


@query(f"SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY rank) - 1 AS rank, alias FROM pages p JOIN ({sql_alias_rows('SELECT url AS u FROM pages')}) a ON p.url = a.u")
def l3_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(urls.url_aliases(F.col("url"))).alias("rank", "alias"))
    return rows.withColumn("rank", F.col("rank").cast("long"))


SQL_PLACE = f"lower({sql_part('url', 2)}) || CASE WHEN {sql_part('url', 3)} = '' THEN '/' ELSE {sql_part('url', 3)} END"
SQL_ASKED = "'?k=%C3%A9%20' || page_id || '&q=%27'"


@query(f"""WITH p AS (SELECT page_id, lower({sql_part('url', 1)}) || '://u:p%40@' AS head, {SQL_PLACE} AS place FROM pages),
a AS (SELECT page_id, unnest(range(0, 4)) AS rank, unnest([head || place || {SQL_ASKED}, 'scheme:' || place || {SQL_ASKED}, head || place, 'scheme:' || place]) AS alias FROM p)
SELECT page_id, rank, alias FROM a""")
def l3_odd_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL with a user, capitals, its default port, backslashes, dot segments, blanks and a campaign: its keys are those of the plain one."""
    url = F.col("url")
    scheme, host, path = (F.regexp_extract(url, r"^([a-zA-Z]+)://([^/?#]*)([^?#]*)", k) for k in (1, 2, 3))
    port = F.when(F.lower(scheme) == "https", ":443").otherwise(":080")
    odd = F.concat(F.lit(" "), F.upper(scheme), F.lit(":\\\\u:p@@"), F.upper(host), port, F.lit("/x/.\t/%2E%2e/"), F.regexp_replace(path, "^/", ""), F.lit("?k=é "), "page_id", F.lit("&q='#utm_x=1 "))
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(urls.url_aliases(odd)).alias("rank", "alias"))
    return rows.withColumn("rank", F.col("rank").cast("long"))


@query(f"SELECT page_id, ordinal, u AS url, {sql_canonical('u')} AS key, {sql_text('inner_')} AS text FROM ({SQL_LINKS})")
def l4_extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(spark, sf_dir).withColumn("ordinal", F.col("ordinal").cast("long"))


SQL_ABOUT = lambda u: f"CASE WHEN regexp_replace({u}, '[?#].*$', '') = {SQL_ORIGIN} || '/about' THEN 'p/about%29.html' ELSE {u} END"


@query(f"SELECT page_id, CAST(len(l) AS BIGINT) AS lines, sha256(array_to_string(l, chr(10))) AS hash FROM (SELECT page_id, {sql_linked_lines('html', SQL_ORIGIN, SQL_ABOUT)} AS l FROM pages)")
def l4_linked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their links; those to one page of each site, by any alias, lead to a local file."""
    url = F.col("url")
    about = F.concat(F.lit("scheme:"), F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#]*)", 1)), F.lit("/about"))
    targets = F.create_map(about, F.lit("p/about).html"))
    piece = F.struct(F.lit("").alias("head"), F.col("html").alias("html"))
    rows = links.linked_lines(table(spark, sf_dir, "pages").select("page_id", "url", F.array(piece).alias("p")), "p", url, targets).select("page_id", F.get("p", 0)["lines"].alias("l"))
    return rows.select("page_id", F.size("l").cast("long").alias("lines"), text.content_hash(F.array_join("l", "\n")).alias("hash"))


SQL_BODY = "text || ' [a](https://a.org/' || (doc_id % 500) || ') and [b](https://a.org/' || (doc_id % 500) || '/x) or [c](http://c.org/' || doc_id || ')'"


def linked_body() -> Column:
    n = F.col("doc_id")
    return F.concat("text", F.lit(" [a](https://a.org/"), n % 500, F.lit(") and [b](https://a.org/"), n % 500, F.lit("/x) or [c](http://c.org/"), n, F.lit(")"))


def linked_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.concat("lang", F.lit("/"), "doc_id", F.lit(".md")).alias("path"), linked_body().alias("body"))


@query(f"SELECT doc_id, unnest(regexp_extract_all({SQL_BODY}, {q(links.MARKDOWN)}, 2)) AS url FROM documents")
def l5_markdown_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_bodies(spark, sf_dir).select("doc_id", F.explode(links.markdown_links(F.col("body"))).alias("url"))


def _entries_with_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        n.alias("id"), F.array("url").alias("source_urls"), F.when(n % 4 == 0, F.array(F.concat(F.regexp_extract("url", r"^[a-zA-Z]+://[^/?#]*", 0), F.lit("/about")))).otherwise(F.array().cast("array<string>")).alias("linked_source_urls"),
        F.when(n % 3 == 0, F.array(F.lit("/[a-m]"))).when(n % 3 == 1, F.array(F.lit("[0-9]"), F.lit("/ABOUT"))).otherwise(F.array().cast("array<string>")).alias("include"), F.array(F.lit("q=|about$")).alias("exclude"),
    )


SQL_RULES = """SELECT page_id AS id, url, CASE WHEN page_id % 4 = 0 THEN [regexp_extract(url, '^[a-zA-Z]+://[^/?#]*') || '/about'] ELSE [] END AS named,
  CASE page_id % 3 WHEN 0 THEN '/[a-m]' WHEN 1 THEN '[0-9]|/ABOUT' END AS include FROM pages"""
SQL_ADMITTED = f"""r AS ({SQL_RULES}), k AS ({SQL_LINKS}),
x AS (SELECT r.id, a.alias FROM r JOIN ({sql_alias_rows("SELECT regexp_extract(url, '^[a-zA-Z]+://[^/?#]*') || '/about' AS u FROM pages")}) a ON r.named[1] = a.u),
y AS (SELECT DISTINCT k.page_id, k.u FROM k JOIN ({sql_alias_rows('SELECT u FROM (' + SQL_LINKS + ')')}) a ON a.u = k.u JOIN x ON x.id = k.page_id AND x.alias = a.alias),
admitted AS (SELECT k.page_id AS id, k.ordinal, k.u AS url FROM k JOIN r ON r.id = k.page_id LEFT JOIN y ON y.page_id = k.page_id AND y.u = k.u
  WHERE y.u IS NOT NULL OR (include IS NOT NULL AND regexp_matches(k.u, '(?i)' || include) AND NOT regexp_matches(k.u, '(?i)q=|about$')))"""


@query(f"WITH {SQL_ADMITTED} SELECT id, ordinal, url FROM admitted")
def l6_admit_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_links(spark, sf_dir).select(F.col("page_id").alias("id"), F.col("ordinal").cast("long").alias("ordinal"), "url")
    return links.admit_links(found, _entries_with_rules(spark, sf_dir))


def site_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_url, ordinal, url``: the links of the pages, and three more of each page to other pages, one of them written oddly."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("page_url"))
    own = page_links(spark, sf_dir).join(pages, "page_id").select("page_url", F.col("ordinal").cast("long").alias("ordinal"), "url")
    n = F.col("page_id")
    steps = F.array(*(F.struct(F.lit(1000 + k).cast("long").alias("ordinal"), to.cast("long").alias("to")) for k, to in enumerate((n + 1, F.floor(n * 3 / 2), n + 1, F.floor(n / 2)))))
    ends = pages.select(n.alias("to"), F.col("page_url").alias("url"))
    more = pages.select("page_url", F.inline(steps)).join(ends, "to")
    odd = F.concat(F.regexp_replace("url", "^https?:", "HTTP:"), F.lit("#again"))
    return own.unionByName(more.select("page_url", "ordinal", F.when(F.col("ordinal") == 1002, odd).otherwise(F.col("url")).alias("url")))


@query(None)
def l7_discover_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the pages themselves, of the pages they lead to and of those that these lead to, all of them; order decides which of several links to a page stays, so there is no SQL."""
    return links.discover_links(_entries_with_rules(spark, sf_dir), site_links(spark, sf_dir), depth=3).withColumn("depth", F.col("depth").cast("long"))


SQL_MAP = f"SELECT alias, arg_min('p/' || page_id || '.html', page_id) AS target FROM (SELECT page_id, unnest({sql_aliases('u')}) AS alias FROM ({SQL_LINKS})) GROUP BY alias"


def page_link_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = page_links(spark, sf_dir).select("url", "page_id", F.concat(F.lit("p/"), "page_id", F.lit(".html")).alias("target"))
    return links.build_link_map(pairs, ["page_id"])


@query(SQL_MAP)
def l8_build_link_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_link_map(spark, sf_dir)


@query(f"WITH m AS ({SQL_MAP}), a AS ({sql_alias_rows('SELECT url AS u FROM pages UNION SELECT u FROM (' + SQL_LINKS + ')')}) SELECT u AS url, arg_min(target, rank) AS target FROM a JOIN m USING (alias) GROUP BY u")
def l9_lookup_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "pages").select("url").union(page_links(spark, sf_dir).select("url"))
    return links.lookup_targets(wanted, page_link_map(spark, sf_dir))


@query(f"""WITH d AS (SELECT lang || '/' || doc_id || '.md' AS path, doc_id, {SQL_BODY} AS body FROM documents),
n AS (SELECT path, replace(body, '](https://a.org/' || (doc_id % 500) || ')', '](../s/' || (doc_id % 500) || '.html)') AS body FROM d WHERE doc_id % 500 IN (SELECT item_id FROM benchmark))
SELECT path, body, sha256(body) AS body_sha256 FROM n""")
def l10_localize_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("item_id")
    pairs = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("http://a.org/"), n).alias("url"), F.concat(F.lit("s/"), n, F.lit(".html")).alias("target"), n.alias("at"))
    return links.localize_links(linked_bodies(spark, sf_dir), links.build_link_map(pairs, ["at"]))


# --- assembly ---


@query("""SELECT conv_id, coalesce(string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY turn, text) FILTER (text <> ''), '') AS body, coalesce(string_agg(role, '; ' ORDER BY turn, text) FILTER (turn % 2 = 0), '') AS notes FROM conversations GROUP BY conv_id""")
def j1_assemble_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumn("note", F.when(F.col("turn") % 2 == 0, F.col("role")))
    return assembly.assemble_bodies(rows, ["conv_id"], ["turn"])


@query(f"""WITH b AS (SELECT d.doc_id, {sql_clean('d.text')} AS body, CASE WHEN d.doc_id % 4 = 0 THEN [translate(left(b.text, 20), '{string.ascii_lowercase}', '{string.ascii_uppercase}')] ELSE [] END AS phrases FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id % (SELECT greatest(count(*), 1) FROM benchmark)),
m AS (SELECT doc_id, body, list_filter(phrases, lambda p: NOT contains(lower(body), lower(p))) AS missing FROM b)
SELECT doc_id, CASE WHEN length(body) < 500 OR len(missing) > 0 THEN 'stub' ELSE 'extracted' END AS status,
  CASE WHEN length(body) < 500 OR len(missing) > 0 THEN concat_ws('; ', CASE WHEN length(body) < 500 THEN 'extracted text length ' || length(body) || ' is below minimum 500' END, CASE WHEN len(missing) > 0 THEN 'missing required phrase(s): ' || missing[1] END) END AS note,
  CASE WHEN (length(body) < 500 OR len(missing) > 0) AND body <> '' THEN sha256(body) END AS attempted FROM m""")
def j2_validate_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("phrase"))
    count = items.agg(F.greatest(F.count("*"), F.lit(1)).alias("items"))
    rows = docs.crossJoin(F.broadcast(count)).join(items, F.col("item_id") == F.col("doc_id") % F.col("items"), "left")
    required = F.when(F.col("doc_id") % 4 == 0, F.array(F.translate(F.left("phrase", F.lit(20)), string.ascii_lowercase, string.ascii_uppercase))).otherwise(F.array().cast("array<string>"))
    return rows.select("doc_id", assembly.validate(F.col("text"), required).alias("x")).select("doc_id", "x.status", "x.note", F.col("x.attempted_text_sha256").alias("attempted"))


@query("""WITH d AS (SELECT conv_id AS id, turn AS ordinal, role = 'assistant' AS linked, 'u' || turn AS url, CASE WHEN (conv_id + turn) % 5 = 0 THEN 'timeout' END AS error FROM conversations),
b AS (SELECT id, count(*) FILTER (NOT linked AND error IS NULL) AS got, count(*) FILTER (NOT linked) AS primaries, count(*) FILTER (linked AND error IS NOT NULL) AS lost,
  string_agg(url || ': ' || error, '; ' ORDER BY ordinal) FILTER (NOT linked AND error IS NOT NULL) AS pn, string_agg(url || ': ' || error, '; ' ORDER BY ordinal) FILTER (linked AND error IS NOT NULL) AS ln,
  string_agg(url || ': linked source download failed: ' || error, '; ' ORDER BY ordinal) FILTER (linked AND error IS NOT NULL) AS sn FROM d GROUP BY id)
SELECT id, CASE WHEN got = 0 OR got < primaries OR (lost > 0 AND id % 2 = 0) THEN 'stub' ELSE 'extracted' END AS status,
  CASE WHEN got = 0 THEN coalesce(pn, 'no sources downloaded') WHEN got < primaries THEN pn WHEN lost > 0 AND id % 2 = 0 THEN ln ELSE sn END AS note FROM b""")
def j3_resolve_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    down = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"), F.col("turn").alias("ordinal"), (F.col("role") == "assistant").alias("linked"), F.concat(F.lit("u"), "turn").alias("url"), F.when((F.col("conv_id") + F.col("turn")) % 5 == 0, "timeout").alias("error")
    )
    rows = down.groupBy("id").agg(F.count_if(~F.col("linked")).alias("primaries")).select("id", "primaries", (F.col("id") % 2 == 0).alias("require_linked"), F.lit("extracted").alias("status"), F.lit(None).cast("string").alias("note"))
    return assembly.resolve_status(rows, down)


@query(f"""WITH x AS (SELECT page_id, html, page_id % 8 AS k, {sql_linked_lines(sql_chromeless("html"), SQL_ORIGIN)} AS whole, {sql_linked_lines(sql_chromeless(sql_article()), "(lower(" + sql_part("url", 1) + ") || '://linkedin.com')")} AS article, {sql_linked_lines("html", "")} AS bare, {sql_clean("html")} AS plain FROM pages),
y AS (SELECT page_id, k, CASE k WHEN 0 THEN '' WHEN 1 THEN plain WHEN 2 THEN plain WHEN 3 THEN array_to_string(bare, chr(10) || chr(10)) WHEN 4 THEN '' WHEN 5 THEN '' WHEN 6 THEN array_to_string(article, chr(10) || chr(10)) ELSE array_to_string(whole, chr(10) || chr(10)) END AS t FROM x)
SELECT page_id, sha256(t) AS hash, CASE WHEN k IN (0, 4, 5) THEN true END AS noted FROM y""")
def j4_dispatch_extractor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stub, plain text, a PDF's text with a page number, HTML in JSON, JSON without any, a help page that is missing its body, a host with scope rules, and any other page."""
    n, html = F.col("page_id"), F.col("html")
    k = n % 8
    way = F.when(k == 0, "stub").when(k.isin(3, 4), "html-data-json").when(k == 5, "github-docs-article").otherwise("generic-html")
    kind = F.when(k == 1, "txt").when(k == 2, "pdf").when(k.isin(3, 4), "json").otherwise("html")
    content = F.when(k == 2, F.concat(F.lit("Page 7\n"), html, F.lit("\n-3-"))).when(k == 3, F.to_json(F.struct(html.alias("data")))).when(k == 4, "{}").otherwise(html)
    rows = table(spark, sf_dir, "pages").select("page_id", F.when(k == 6, F.regexp_replace("url", r"^([a-zA-Z]+://)[^/?#]*", "$1linkedin.com")).otherwise(F.col("url")).alias("url"), content.alias("content"), way.alias("extractor"), kind.alias("type"))
    return dispatched(rows)


@query("""SELECT conv_id AS id, coalesce(string_agg('f/' || turn, ' ' ORDER BY role = 'assistant', turn) FILTER (turn % 4 <> 3), '') AS source_files, coalesce(string_agg('u' || turn, ' ' ORDER BY turn) FILTER (role = 'assistant' AND turn % 4 <> 3), '') AS linked_source_urls,
  CAST(count(*) FILTER (role = 'assistant' AND turn % 4 = 3) AS BIGINT) AS linked_errors, coalesce(string_agg(sha256(text), ' ' ORDER BY role = 'assistant', turn) FILTER (turn % 4 <> 3), '') AS hashes FROM conversations GROUP BY conv_id""")
def j5_manifest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    artifacts = rows.select(
        F.col("conv_id").alias("id"), (F.col("role") == "assistant").alias("linked"), F.col("turn").alias("ordinal"), F.concat(F.lit("u"), "turn").alias("url"), F.concat(F.lit("f/"), "turn").alias("source_file"),
        F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"), F.when(F.col("turn") % 4 == 3, "timeout").alias("error"),
    )
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    done = ids.select("id", F.lit("x").alias("text"), F.lit("extracted").alias("status"), F.lit(None).cast("string").alias("note"))
    out = assembly.manifest_records(ids, artifacts, done)
    return out.select("id", *(F.array_join(c, " ").alias(c) for c in ("source_files", "linked_source_urls")), F.size("linked_source_errors").cast("long").alias("linked_errors"), F.array_join(F.transform("source_sha256", lambda x: x["sha256"]), " ").alias("hashes"))


def _manifests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    n = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit("d/"), "source").alias("dir"), n.alias("id"), F.array(F.concat(F.lit("d/"), "source", F.lit("/"), n % 97), F.concat(F.lit("e/"), n)).alias("source_files"), F.lit(1).alias("version"))
    new = rows.where("id % 5 = 0").select("dir", "id", F.slice("source_files", 2, 1).alias("source_files"), F.lit(2).alias("version"))
    return rows.where("id % 10 <> 5"), new, rows.where("id % 23 <> 0").select("id")


SQL_MERGED = """e AS (SELECT 'd/' || source AS dir, doc_id AS id, ['d/' || source || '/' || (doc_id % 97), 'e/' || doc_id] AS source_files FROM documents), n AS (SELECT dir, id, source_files[2:] AS source_files FROM e WHERE id % 5 = 0),
m AS (SELECT dir, id, source_files, 1 AS version FROM e WHERE id % 10 <> 5 AND id % 23 <> 0 AND id % 5 <> 0 AND dir IN (SELECT dir FROM n) UNION ALL SELECT dir, id, source_files, 2 FROM n)"""


@query(f"WITH {SQL_MERGED} SELECT dir, id, array_to_string(source_files, ' ') AS source_files, version FROM m")
def j6_merge_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.merge_manifests(*_manifests(spark, sf_dir)).withColumn("source_files", F.array_join("source_files", " "))


@query(f"""WITH {SQL_MERGED}, r AS (SELECT DISTINCT dir, unnest(source_files) AS f FROM e WHERE id % 10 <> 5 AND id % 5 = 0), k AS (SELECT DISTINCT dir, unnest(source_files) AS f FROM m)
SELECT dir, f AS source_file FROM r WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.dir = r.dir AND k.f = r.f) AND starts_with(f, dir || '/')""")
def j7_stale_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, new, registry = _manifests(spark, sf_dir)
    return assembly.stale_artifacts(existing, new, assembly.merge_manifests(existing, new, registry))


@query("""SELECT lang || '/' || doc_id || '.md' AS path, sha256(array_to_string(list_filter(['# Document ' || doc_id, CASE WHEN doc_id % 3 = 0 THEN chr(10) || '> Opening Note: This file is a source stub only. Reason: too short' END, chr(10) || '- Collection: ' || lang, '- Source URL:', '- https://a.org/' || doc_id,
  CASE WHEN doc_id % 2 = 0 THEN '- Reference URL:' || chr(10) || '- https://r.org/' || doc_id END, '', CASE WHEN doc_id % 5 = 0 THEN '- Linked Source URL:' || chr(10) || '- https://l.org/' || doc_id || ' -> ../f/l' || doc_id END,
  '- Extractor: generic-html', '- Extraction Status: ' || CASE WHEN doc_id % 3 = 0 THEN 'stub' ELSE 'extracted' END, '- Status Note: None', '- Source SHA-256:', '- f/' || doc_id || ': ' || sha256(source),
  '- Body SHA-256: ' || CASE WHEN doc_id % 3 = 0 THEN 'not generated because this is a source stub' ELSE sha256(text) END, '', CASE WHEN doc_id % 3 = 0 THEN '## Source Stub' || chr(10) || chr(10) || 'No source text is kept here.' ELSE '## Source Text' || chr(10) || chr(10) || text END, ''], lambda x: x IS NOT NULL), chr(10))) AS hash FROM documents""")
def s5_render_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.render_rule_documents(_rendered(spark, sf_dir)).select("path", text.content_hash(F.col("document")).alias("hash"))


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries with what was extracted, ready to be written as documents."""
    n, stub, none = F.col("doc_id"), F.col("doc_id") % 3 == 0, F.expr("cast(array() as array<string>)")

    def one(cycle: int, text_: str) -> Column:
        return F.when(n % cycle == 0, F.array(F.concat(F.lit(text_), n))).otherwise(none)

    return table(spark, sf_dir, "documents").select(
        n.alias("id"), F.concat("lang", F.lit("/"), n, F.lit(".md")).alias("path"), F.concat(F.lit("Document "), n).alias("title"), F.col("lang").alias("collection"), F.array(F.concat(F.lit("https://a.org/"), n)).alias("source_urls"),
        one(2, "https://r.org/").alias("reference_urls"), one(5, "https://l.org/").alias("linked_source_urls"), one(5, "f/l").alias("linked_source_files"), F.lit("generic-html").alias("extractor"),
        F.array(F.struct(F.concat(F.lit("f/"), n).alias("source_file"), F.sha2("source", 256).alias("sha256"))).alias("source_sha256"), "text",
        F.when(stub, "stub").otherwise("extracted").alias("status"), F.when(stub, "too short").alias("note"), F.lit(None).cast("string").alias("status_note"),
    )


# --- roll-ups ---

SQL_ROLLUP = """p AS (SELECT [lang, source] AS parts FROM documents), x AS (SELECT unnest(['', parts[1], parts[1] || '/' || parts[2]]) AS directory, parts[1] || '/' || parts[2] AS own FROM p),
c AS (SELECT directory, CAST(count(*) FILTER (own = directory) AS BIGINT) AS rule_count, count(*) AS descendant_rule_count FROM x GROUP BY directory),
k AS (SELECT CASE WHEN contains(directory, '/') THEN regexp_replace(directory, '/[^/]*$', '') ELSE '' END AS directory, list(regexp_extract(directory, '[^/]*$') ORDER BY regexp_extract(directory, '[^/]*$')) AS children FROM c WHERE directory <> '' GROUP BY 1),
rollup_ AS (SELECT directory, rule_count, descendant_rule_count, coalesce(children, []) AS children FROM c LEFT JOIN k USING (directory))"""


@query(f"WITH {SQL_ROLLUP} SELECT directory, rule_count, descendant_rule_count, array_to_string(children, ',') AS children FROM rollup_")
def a1_directory_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexes.directory_rollup(documents_as_markdown(spark, sf_dir)).withColumn("children", F.array_join("children", ","))


@query(f"""WITH {SQL_ROLLUP}, r AS (SELECT lang || '/' || source AS directory, string_agg(doc_id || '.md|' || lang || '/' || source || '/' || doc_id || '.md|Document ' || doc_id || '|' || source, ',' ORDER BY doc_id || '.md') AS rules FROM documents GROUP BY 1),
kk AS (SELECT CASE WHEN contains(directory, '/') THEN regexp_replace(directory, '/[^/]*$', '') ELSE '' END AS directory, string_agg(regexp_extract(directory, '[^/]*$') || '|' || directory || '|' || directory || '/index.json|' || rule_count || '|' || descendant_rule_count, ',' ORDER BY regexp_extract(directory, '[^/]*$')) AS children FROM rollup_ WHERE directory <> '' GROUP BY 1)
SELECT directory, rule_count, descendant_rule_count, coalesce(r.rules, '') AS rules, coalesce(kk.children, '') AS children FROM rollup_ LEFT JOIN r USING (directory) LEFT JOIN kk USING (directory)""")
def a2_rule_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    def listed(name: str, *fields: str) -> Column:
        return F.array_join(F.transform(name, lambda x: F.concat_ws("|", *(x[f].cast("string") for f in fields))), ",").alias(name)

    out = indexes.rule_index(documents_as_markdown(spark, sf_dir), ("language",))
    return out.select("directory", "rule_count", "descendant_rule_count", listed("rules", "file", "path", "title", "language"), listed("children", "name", "path", "index", "rule_count", "descendant_rule_count"))


@query("SELECT CAST(1 + count(DISTINCT lang) + count(DISTINCT lang || '/' || source) AS BIGINT) AS indexes, count(*) AS indexed_rules FROM documents")
def a5_index_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexes.index_summary(indexes.rule_index(documents_as_markdown(spark, sf_dir), ()))


SQL_CATEGORY = "CASE doc_id % 5 WHEN 0 THEN 'self_harm' WHEN 1 THEN 'child_safety' WHEN 2 THEN 'unheard_of' ELSE 'fraud_scams' END"


@query(f"""WITH e AS (SELECT d.doc_id, source, {SQL_CATEGORY} AS c FROM documents d LEFT JOIN labels l USING (doc_id) WHERE lang = 'en' AND coalesce(toxic, 0) = 0),
l(c, en) AS (VALUES {", ".join(f"({q(a)}, {q(b)})" for a, b, _ in rules.RISK_LABELS)})
SELECT source AS platform_group, 'N' || min(doc_id) AS name, (SELECT string_agg(coalesce(l.en, x.c), ', ' ORDER BY x.c) FROM (SELECT DISTINCT c FROM e e2 WHERE e2.source = e.source) x LEFT JOIN l ON l.c = x.c) AS labels, count(*) AS sources FROM e GROUP BY source""")
def a3_risk_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = indexes.risk_index(_risky_entries(spark, sf_dir), indexes.risk_labels(spark))
    return out.select("platform_group", "name", F.array_join("labels_en", ", ").alias("labels"), F.size("sources").cast("long").alias("sources"))


def _risky_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("id")
    category = F.when(n % 5 == 0, "self_harm").when(n % 5 == 1, "child_safety").when(n % 5 == 2, "unheard_of").otherwise("fraud_scams")
    return entry_rows(spark, sf_dir).where("collection = 'en'").select(n, F.lit("platforms").alias("collection"), "platform_group", "enabled", n.alias("position"), F.concat(F.lit("N"), n).alias("platform_name"), F.concat(F.lit("T"), n).alias("title"), F.array(F.lit("u")).alias("source_urls"), F.array(category).alias("risk_categories"))


@query("SELECT sha256(text) AS hash, count(*) AS count FROM documents GROUP BY 1 HAVING count(*) > 1")
def a4_duplicate_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexes.duplicate_values(table(spark, sf_dir, "documents").select(text.content_hash(F.col("text")).alias("hash")), "hash")


@query("SELECT lang AS collection, count(*) AS checked, CAST(count(*) FILTER (n_chars >= 500) AS BIGINT) AS extracted, CAST(count(*) FILTER (n_chars < 500) AS BIGINT) AS stubs, CAST(count(*) FILTER (doc_id % 17 = 0) AS BIGINT) AS failures FROM documents GROUP BY lang")
def a5_corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("lang").alias("collection"), F.when(F.col("n_chars") >= 500, "extracted").otherwise("stub").alias("extraction_status"), (F.col("doc_id") % 17 == 0).cast("int").alias("failures"))
    return indexes.corpus_summary(rows, "collection")


# --- checks ---


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").where("page_id % 23 <> 0").select(F.concat(F.lit("s/"), "page_id", F.lit(".html")).alias("path"), challenged(F.col("html")).cast("binary").alias("content"))
    return verification.artifact_facts(rows)


def _declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, html = F.col("page_id"), challenged(F.col("html"))
    return table(spark, sf_dir, "pages").where("page_id % 29 <> 0").select(n.alias("entry_id"), F.concat(F.lit("s/"), n, F.lit(".html")).alias("path"), F.sha2(F.when(n % 17 == 0, F.concat(html, F.lit("x"))).otherwise(html), 256).alias("sha256"), F.when(n % 3 != 0, F.octet_length(html).cast("long") + F.when(n % 19 == 0, 1).otherwise(0)).alias("bytes"))


SQL_V1 = f"""SELECT 'V1' AS "check", CAST(page_id AS VARCHAR) AS entry_id, 's/' || page_id || '.html' AS subject, unnest(list_filter(CASE WHEN page_id % 23 = 0 THEN ['missing'] ELSE [CASE WHEN page_id % 17 = 0 THEN 'hash mismatch' END, CASE WHEN page_id % 3 <> 0 AND page_id % 19 = 0 THEN 'byte count mismatch' END, CASE WHEN {sql_challenge(SQL_CHALLENGED)} THEN 'challenge page' END] END, lambda x: x IS NOT NULL)) AS detail FROM pages WHERE page_id % 29 <> 0"""
SQL_V7 = """SELECT 'V7' AS "check", CAST(NULL AS VARCHAR) AS entry_id, 's/' || page_id || '.html' AS subject, 'unreferenced artifact' AS detail FROM pages WHERE page_id % 29 = 0 AND page_id % 23 <> 0"""


@query(SQL_V1)
def v1_artifact_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verification.artifact_integrity(_declared(spark, sf_dir), _facts(spark, sf_dir))


SQL_V2 = """SELECT 'V2' AS "check", CAST(doc_id AS VARCHAR) AS entry_id, CASE doc_id % 11 WHEN 0 THEN 'f/' || doc_id WHEN 1 THEN 'h/' || doc_id ELSE '' END AS subject, CASE doc_id % 11 WHEN 0 THEN 'file without hash' WHEN 1 THEN 'hash without file' WHEN 2 THEN 'missing hash metadata' ELSE 'invalid hash entry' END AS detail FROM documents WHERE doc_id % 11 < 4"""


@query(SQL_V2)
def v2_hash_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verification.hash_coverage(_hashed_files(spark, sf_dir))


def _hashed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")

    def entry(name: str, hash_: Column) -> Column:
        return F.struct(F.concat(F.lit(name), n).alias("source_file"), hash_.alias("sha256"))

    good, other, odd = entry("e/", F.sha2("text", 256)), entry("f/", F.sha2("source", 256)), entry("g/", F.lit(""))
    hashes = F.when(n % 11 == 0, F.array(good)).when(n % 11 == 1, F.array(good, other, entry("h/", F.sha2("lang", 256)))).when(n % 11 == 3, F.array(other, odd, good)).when(n % 11 != 2, F.array(other, good))
    return table(spark, sf_dir, "documents").select(n.alias("id"), F.array(F.concat(F.lit("e/"), n), F.concat(F.lit("f/"), n)).alias("source_files"), hashes.alias("source_sha256"))


def _records(spark: SparkSession, sf_dir: str, linked: bool = False) -> DataFrame:
    n = F.col("doc_id")
    body = linked_body() if linked else F.regexp_replace("text", r"\n+\z", "")
    return table(spark, sf_dir, "documents").select(
        n.alias("id"), F.concat("lang", F.lit("/"), "source", F.lit("/"), n, F.lit(".md")).alias("output_file"), F.array(F.concat(F.lit("https://a.org/"), n), F.when(n % 31 == 0, "https://lost.org").otherwise(F.concat(F.lit("https://b.org/"), n % 10))).alias("source_urls"),
        F.array().cast("array<string>").alias("linked_source_urls"), F.array().cast("array<string>").alias("reference_urls"), F.array(F.concat(F.lit("x/"), n)).alias("source_files"), F.when(n % 37 == 0, F.array(F.lit("lang/y"))).otherwise(F.array().cast("array<string>")).alias("linked_source_files"),
        F.when(n % 41 == 0, "odd").when(n % 43 == 0, "stub").otherwise("extracted").alias("extraction_status"), F.sha2(F.when(n % 17 == 0, F.concat(body, F.lit("x"))).otherwise(body), 256).alias("body_sha256"),
    )


SQL_V3 = """SELECT 'V3' AS "check", CAST(doc_id AS VARCHAR) AS entry_id, 'https://lost.org' AS subject, 'missing source URL' AS detail FROM documents WHERE doc_id % 31 = 0
UNION ALL SELECT 'V3', CAST(doc_id AS VARCHAR), unnest(['lang/y', '../../lang/y']), unnest(['linked file not in source files', 'missing local reference']) FROM documents WHERE doc_id % 37 = 0"""


@query(SQL_V3)
def v3_document_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verification.document_references(_records(spark, sf_dir), documents_as_markdown(spark, sf_dir))


SQL_V4 = """SELECT 'V4' AS "check", CAST(doc_id AS VARCHAR) AS entry_id, lang || '/' || source || '/' || doc_id || '.md' AS subject, 'missing scope note' AS detail FROM documents WHERE doc_id % 19 = 0 AND lang = 'en' AND source IN ('src1', 'src3')
UNION ALL SELECT 'V4', CAST(doc_id AS VARCHAR), lang || '/' || source || '/' || doc_id || '.md', 'missing scope note' FROM documents WHERE doc_id % 19 = 0 AND starts_with(source, 'src1') AND source <> 'src1' AND lang = 'en'"""


@query(SQL_V4)
def v4_scope_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = verification.scope_notes(_records(spark, sf_dir), documents_as_markdown(spark, sf_dir), "en/src1")
    return one.unionByName(verification.scope_notes(_records(spark, sf_dir), documents_as_markdown(spark, sf_dir), "en/src3/"))


SQL_V5 = """SELECT 'V5' AS "check", CAST(doc_id AS VARCHAR) AS entry_id, lang || '/' || source || '/' || doc_id || '.md' AS subject, CASE WHEN doc_id % 41 = 0 THEN 'unknown extraction status' WHEN doc_id % 43 = 0 THEN 'stub without opening note' WHEN doc_id % 13 = 0 THEN 'missing body section' ELSE 'body hash mismatch' END AS detail
FROM documents WHERE doc_id % 41 = 0 OR doc_id % 43 = 0 OR doc_id % 13 = 0 OR doc_id % 17 = 0"""


@query(SQL_V5)
def v5_body_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verification.body_status(_records(spark, sf_dir), documents_as_markdown(spark, sf_dir))


SQL_V6 = """SELECT 'V6' AS "check", CAST(doc_id AS VARCHAR) AS entry_id, 'https://a.org/' || (doc_id % 500) AS subject, 'link to a collected source is online' AS detail FROM documents WHERE doc_id % 500 IN (SELECT item_id FROM benchmark) AND doc_id % 17 <> 0 AND doc_id % 19 <> 0"""


@query(SQL_V6)
def v6_online_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with links to collected and other sources; those whose hash is wrong, and stubs, are not read."""
    n, head = F.col("doc_id"), F.lit("# D\n\n## Source Text\n\n")
    rows = linked_bodies(spark, sf_dir).select(n.alias("id"), "path", "body", F.concat(head, "body", F.lit("\n")).alias("document"))
    wrong = F.when(F.col("id") % 17 == 0, F.concat("body", F.lit("x"))).otherwise(F.col("body"))
    records = rows.select("id", F.col("path").alias("output_file"), F.when(F.col("id") % 19 == 0, "stub").otherwise("extracted").alias("extraction_status"), F.sha2(wrong, 256).alias("body_sha256"))
    collected = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("http://A.org/"), "item_id", F.lit("?utm_x=1#top")).alias("url"))
    return verification.online_links(verification.sound_bodies(records, rows.select("path", "document")), collected)


@query(SQL_V7)
def v7_orphan_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verification.orphan_artifacts(_facts(spark, sf_dir), _declared(spark, sf_dir))


SQL_V8 = """SELECT 'V8' AS "check", CAST(NULL AS VARCHAR) AS entry_id, CAST(doc_id AS VARCHAR) AS subject, 'id missing from manifests' AS detail FROM documents WHERE doc_id % 23 = 0 AND doc_id % 29 <> 0
UNION ALL SELECT 'V8', NULL, CAST(doc_id AS VARCHAR), 'id missing from registry' FROM documents WHERE doc_id % 29 = 0 AND doc_id % 23 <> 0
UNION ALL SELECT 'V8', NULL, 'o/' || (doc_id // 2), 'output_file missing from manifests' FROM documents GROUP BY doc_id // 2 HAVING count(*) FILTER (doc_id % 23 <> 0) = 0 AND count(*) FILTER (doc_id % 29 <> 0) > 0
UNION ALL SELECT 'V8', NULL, 'o/' || (doc_id // 2), 'output_file missing from registry' FROM documents GROUP BY doc_id // 2 HAVING count(*) FILTER (doc_id % 23 <> 0) > 0 AND count(*) FILTER (doc_id % 29 <> 0) = 0
UNION ALL SELECT 'V8', NULL, 'o/' || (doc_id // 2), 'duplicate registry output_file' FROM documents WHERE doc_id % 29 <> 0 GROUP BY doc_id // 2 HAVING count(*) > 1
UNION ALL SELECT 'V8', NULL, 'o/' || (doc_id // 2), 'duplicate manifest output_file' FROM documents WHERE doc_id % 23 <> 0 GROUP BY doc_id // 2 HAVING count(*) > 1"""


@query(SQL_V8)
def v8_registry_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("o/"), F.floor(F.col("doc_id") / 2)).alias("output_file"))
    return verification.registry_coverage(rows.where("id % 29 <> 0"), rows.where("id % 23 <> 0"))


SQL_V9 = f"""WITH {SQL_ROLLUP}, d AS (SELECT lang || '/' || source AS dir_, doc_id AS n, doc_id || '.md' AS file FROM documents),
i AS (SELECT *, regexp_extract(directory, '[^/]*$') AS name FROM rollup_), gone AS (SELECT directory FROM i WHERE name = 'src2'),
stored AS (SELECT directory, rule_count + CASE WHEN name = 'src1' THEN 1 ELSE 0 END AS rule_count, descendant_rule_count FROM i WHERE name <> 'src2'),
kids AS (SELECT CASE WHEN contains(directory, '/') THEN regexp_replace(directory, '/[^/]*$', '') ELSE '' END AS dir_, i.* FROM i WHERE directory <> ''),
below AS (SELECT dir_, sum(s.descendant_rule_count) AS n FROM kids JOIN stored s USING (directory) GROUP BY dir_),
f AS (
  SELECT directory AS dir_, '' AS name, 'missing index' AS w FROM gone
  UNION ALL SELECT 'no/where', '', 'index of no directory'
  UNION ALL SELECT directory, '', 'stale rule count' FROM i WHERE name = 'src1'
  UNION ALL SELECT directory, '', unnest(['wrong schema version', 'wrong generator', 'wrong directory field']) FROM i WHERE name = 'src3'
  UNION ALL SELECT dir_, file, 'missing rule' FROM d WHERE n % 31 = 0 AND dir_ NOT IN (SELECT directory FROM gone)
  UNION ALL SELECT dir_, file, 'duplicate rule' FROM d WHERE n % 37 = 0 AND n % 31 <> 0 AND dir_ NOT IN (SELECT directory FROM gone)
  UNION ALL SELECT dir_, file, 'rule without title' FROM d WHERE n % 41 = 0 AND n % 31 <> 0 AND dir_ NOT IN (SELECT directory FROM gone)
  UNION ALL SELECT dir_, file, 'wrong rule path' FROM d WHERE n % 43 = 0 AND n % 31 <> 0 AND dir_ NOT IN (SELECT directory FROM gone)
  UNION ALL SELECT dir_, 'x/' || file, unnest(['misplaced rule', 'rule does not exist']) FROM d WHERE n % 47 = 0 AND dir_ NOT IN (SELECT directory FROM gone)
  UNION ALL SELECT dir_, name, 'child index not readable' FROM kids WHERE name = 'src2'
  UNION ALL SELECT dir_, name, 'stale child rule count' FROM kids WHERE name = 'src1'
  UNION ALL SELECT s.directory, '', 'stale descendant count' FROM stored s LEFT JOIN (SELECT dir_, sum(CASE WHEN n % 31 = 0 THEN 0 WHEN n % 37 = 0 THEN 2 ELSE 1 END + CASE WHEN n % 47 = 0 THEN 1 ELSE 0 END) AS n FROM d GROUP BY dir_) l ON l.dir_ = s.directory LEFT JOIN below b ON b.dir_ = s.directory
    WHERE s.descendant_rule_count <> coalesce(l.n, 0) + coalesce(b.n, 0))
SELECT 'V9' AS "check", CAST(NULL AS VARCHAR) AS entry_id, CASE WHEN name = '' THEN dir_ ELSE dir_ || ': ' || name END AS subject, w AS detail FROM f"""


@query(SQL_V9)
def v9_stale_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes with a fault of each kind: lost, of no directory, miscounted, of another version, and with rules that are left out, doubled, untitled, astray."""
    docs = documents_as_markdown(spark, sf_dir)
    return verification.stale_indexes(_spoiled_indexes(docs), docs)


def _spoiled_indexes(docs: DataFrame) -> DataFrame:
    index = cut(indexes.rule_index(docs, ()))
    name = F.regexp_extract("directory", r"[^/]*\z", 0)
    third = name == "src3"

    def number(r: Column) -> Column:
        return F.regexp_extract(r["file"], r"\d+", 0).cast("long")

    def rule(r: Column, file: Column, path: Column) -> Column:
        return F.struct(file.alias("file"), path.alias("path"), F.when(number(r) % 41 == 0, "").otherwise(r["title"]).alias("title"))

    def spoiled(r: Column) -> Column:
        own = rule(r, r["file"], F.when(number(r) % 43 == 0, "elsewhere").otherwise(r["path"]))
        kept = F.when(number(r) % 31 == 0, F.array_remove(F.array(own), own)).when(number(r) % 37 == 0, F.array(own, own)).otherwise(F.array(own))
        astray = F.concat(F.lit("x/"), r["file"])
        extra = F.struct(astray.alias("file"), F.concat("directory", F.lit("/"), astray).alias("path"), F.lit("t").alias("title"))
        return F.when(number(r) % 47 == 0, F.array_append(kept, extra)).otherwise(kept)

    stored = index.where(name != "src2").withColumn("rules", F.flatten(F.transform("rules", spoiled))).select(
        F.col("directory").alias("location"), F.when(third, 2).otherwise(1).alias("schema_version"), F.when(third, "other").otherwise(F.col("directory")).alias("directory"), F.when(third, "x").otherwise(F.col("generated_by")).alias("generated_by"),
        (F.col("rule_count") + F.when(name == "src1", 1).otherwise(0)).alias("rule_count"), "descendant_rule_count", "rules", "children",
    )
    lost = index.where("directory = ''").select(
        F.lit("no/where").alias("location"), "schema_version", F.lit("no/where").alias("directory"), "generated_by", F.lit(0).cast("long").alias("rule_count"), F.lit(0).cast("long").alias("descendant_rule_count"), "rules", "children"
    )
    return stored.unionByName(lost)


SQL_SOUND = "doc_id % 13 <> 0 AND doc_id % 17 <> 0 AND doc_id % 41 <> 0 AND doc_id % 43 <> 0"
SQL_OWN = [f"SELECT * FROM ({sql}) WHERE CAST(entry_id AS BIGINT) % 23 <> 0" for sql in (SQL_V2, SQL_V3, SQL_V4, SQL_V5)]
SQL_V10 = f"""{SQL_V1} UNION ALL {SQL_V7} UNION ALL {" UNION ALL ".join(SQL_OWN)}
UNION ALL SELECT 'V6', CAST(doc_id AS VARCHAR), 'https://a.org/' || (doc_id % 500), 'link to a collected source is online' FROM documents WHERE doc_id % 23 <> 0 AND (doc_id % 500) % 23 <> 0 AND {SQL_SOUND}
UNION ALL SELECT 'V8', NULL, unnest([CAST(doc_id AS VARCHAR), lang || '/' || source || '/' || doc_id || '.md']), unnest(['id', 'output_file']) || ' missing from manifests' FROM documents WHERE doc_id % 23 = 0 AND doc_id % 29 <> 0
UNION ALL SELECT 'V8', NULL, unnest([CAST(doc_id AS VARCHAR), lang || '/' || source || '/' || doc_id || '.md']), unnest(['id', 'output_file']) || ' missing from registry' FROM documents WHERE doc_id % 29 = 0 AND doc_id % 23 <> 0
UNION ALL SELECT 'V8', NULL, unnest([CAST(doc_id AS VARCHAR), lang || '/' || source || '/' || doc_id || '.md']), 'duplicate registry ' || unnest(['id', 'output_file']) FROM documents WHERE doc_id % 101 = 0 AND doc_id % 29 <> 0
UNION ALL SELECT * FROM ({SQL_V9})"""


def corpus_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One corpus with faults of every check: its registry, manifests, documents, artifacts and indexes."""
    n = F.col("doc_id")
    docs, hashes = documents_as_markdown(spark, sf_dir, linked=True), _hashed_files(spark, sf_dir)
    records = _records(spark, sf_dir, linked=True).drop("source_files").join(hashes, "id").where("id % 23 <> 0")
    files = table(spark, sf_dir, "documents").select(n.alias("id"), F.concat("lang", F.lit("/"), "source", F.lit("/"), n, F.lit(".md")).alias("output_file")).where("id % 29 <> 0")
    return {
        "registry": files.select("id", "output_file", F.explode(F.array_repeat(F.lit(1), F.when(F.col("id") % 101 == 0, 2).otherwise(1))).alias("copy")).drop("copy"),
        "records": records, "documents": docs.select("path", "document"), "declared": _declared(spark, sf_dir), "facts": _facts(spark, sf_dir), "stored": _spoiled_indexes(docs),
    }


@query(SQL_V10)
def v10_verify_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of V1-V9 over one corpus."""
    return verification.verify_tables(**corpus_tables(spark, sf_dir), parts=("en/src1", "en/src3/"))


# --- files ---


def folder_of(n: Column, size: int) -> Column:
    """Directories of ``size`` ids in turn, which bounds a file whatever the sources hold."""
    return F.floor(n / size).cast("long")


def in_order(*values: Column) -> Column:
    """The values of a group ordered by the first, without it; the second is what is left."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*values))), lambda x: x["v"])


@query("""SELECT '2026-01-' || lpad(CAST(1 + doc_id // 1000 % 28 AS VARCHAR), 2, '0') AS retrieved_date, row_number() OVER (PARTITION BY doc_id // 1000 ORDER BY doc_id) - 1 AS position, CAST(doc_id AS VARCHAR) AS id, lang AS collection, source AS platform_group,
  CASE doc_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS enabled, CASE WHEN doc_id % 2 = 0 THEN 'https://a.org/' || doc_id END AS source_url, CASE WHEN doc_id % 2 = 1 THEN 'https://a.org/' || doc_id || ' https://b.org/' || doc_id END AS source_urls FROM documents""")
def s1_read_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registries of up to a thousand entries written as JSON and read."""
    n, path = F.col("doc_id"), shared_folder(spark)
    first, second = F.concat(F.lit("https://a.org/"), n), F.concat(F.lit("https://b.org/"), n)
    entry = F.struct(
        n.cast("string").alias("id"), F.col("lang").alias("collection"), F.col("source").alias("platform_group"), F.when(n % 3 == 0, True).when(n % 3 == 1, False).alias("enabled"),
        F.when(n % 2 == 0, first).alias("source_url"), F.when(n % 2 == 1, F.array(first, second)).alias("source_urls"),
    )
    rows = table(spark, sf_dir, "documents").groupBy(folder_of(n, 1000).alias("dir")).agg(in_order(n, entry.alias("v")).alias("entries"))
    date = F.concat(F.lit("2026-01-"), F.lpad((1 + F.col("dir") % 28).cast("string"), 2, "0"))
    writers.write_texts(rows.select("dir", F.to_json(F.struct(F.lit(1).alias("schema_version"), date.alias("retrieval_date"), "entries")).alias("value")), path)
    back = readers.read_registry(spark, path)
    return back.select("retrieved_date", F.col("position").cast("long").alias("position"), "id", "collection", "platform_group", "enabled", "source_url", F.array_join("source_urls", " ").alias("source_urls"))


@query("""WITH f AS (SELECT page_id // 10 AS dir, coalesce(string_agg(html, chr(10) ORDER BY page_id), '') || chr(10) AS content FROM pages GROUP BY 1)
SELECT 'sources/dir=' || dir AS dir, CAST(strlen(content) AS BIGINT) AS length, sha256(content) AS sha256 FROM f WHERE dir % 5 <> 0""")
def s2_read_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts of ten pages each written below ``sources`` and beside it, and read as bytes; those beside it are none."""
    n, path = F.col("page_id"), shared_folder(spark)
    rows = table(spark, sf_dir, "pages").groupBy(folder_of(n, 10).alias("dir")).agg(F.array_join(in_order(n, F.col("html").alias("v")), "\n").alias("value"))
    writers.write_texts(rows.where("dir % 5 <> 0"), f"{path}/sources")
    writers.write_texts(rows.where("dir % 5 = 0"), f"{path}/notes")
    return readers.read_artifacts(spark, path).select(F.regexp_extract("path", "^(.*)/", 1).alias("dir"), "length", F.sha2("content", 256).alias("sha256"))


@query("""SELECT 'd' || doc_id // 100 AS dir, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) - 1 AS position, CAST(doc_id AS VARCHAR) AS id, 'https://a.org/' || doc_id AS source_urls,
  'f/' || doc_id AS source_files, sha256(text) AS hashes, CASE WHEN doc_id % 4 <> 0 THEN CAST(strlen(text) AS BIGINT) END AS bytes FROM documents""")
def s3_read_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of up to a hundred records written, a fourth of the records in the older schema, and read as one."""
    n, path = F.col("doc_id"), shared_folder(spark)
    id_, url, file, hash_ = n.cast("string").alias("id"), F.concat(F.lit("https://a.org/"), n), F.concat(F.lit("f/"), n), F.sha2("text", 256)
    old = F.to_json(F.struct(id_, url.alias("source_url"), file.alias("source_file"), hash_.alias("source_sha256")))
    new = F.to_json(F.struct(id_, F.array(url).alias("source_urls"), F.array(file).alias("source_files"), F.array(F.struct(file.alias("source_file"), hash_.alias("sha256"), F.octet_length("text").alias("bytes"))).alias("source_sha256")))
    writers.write_manifests(table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), folder_of(n, 100)).alias("dir"), "doc_id", F.when(n % 4 == 0, old).otherwise(new).alias("record")), path, "doc_id")
    back = readers.read_manifests(spark, path)
    return back.select(
        F.regexp_extract("manifest", "^(.*)/sources/", 1).alias("dir"), F.col("position").cast("long").alias("position"), "id", F.array_join("source_urls", " ").alias("source_urls"), F.array_join("source_files", " ").alias("source_files"),
        F.array_join(F.transform("source_sha256", lambda x: x["sha256"]), " ").alias("hashes"), F.get("source_sha256", 0)["bytes"].alias("bytes"),
    )


@query("""WITH f AS (SELECT doc_id // 20 AS dir, coalesce(string_agg(text, chr(10) ORDER BY doc_id), '') || chr(10) AS document FROM documents GROUP BY 1)
SELECT 'dir=' || dir AS dir, length(document) AS chars, sha256(document) AS sha256 FROM f WHERE dir % 7 <> 0""")
def s4_read_rule_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of twenty texts each written beside ``sources`` and below it, and read whole; those below it are none."""
    n, path = F.col("doc_id"), shared_folder(spark)
    rows = table(spark, sf_dir, "documents").groupBy(folder_of(n, 20).alias("dir")).agg(F.array_join(in_order(n, F.col("text").alias("v")), "\n").alias("value"))
    writers.write_texts(rows.where("dir % 7 <> 0"), path)
    writers.write_texts(rows.where("dir % 7 = 0"), f"{path}/sources")
    return readers.read_rule_documents(spark, path, "part-*").select(F.regexp_extract("path", "^(.*)/", 1).alias("dir"), F.length("document").cast("long").alias("chars"), F.sha2("document", 256).alias("sha256"))


@query("SELECT source AS dir, row_number() OVER (PARTITION BY source ORDER BY CAST(doc_id AS VARCHAR)) - 1 AS position, CAST(doc_id AS VARCHAR) AS id, sha256(text) AS body_sha256, 'f/' || doc_id AS source_files FROM documents")
def s6_write_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as one manifest for each directory and read again."""
    n, path = F.col("doc_id"), shared_folder(spark)
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("dir"), n.cast("string").alias("id"), F.sha2("text", 256).alias("body_sha256"), F.array(F.concat(F.lit("f/"), n)).alias("source_files"))
    writers.write_manifests(rows, path)
    back = readers.read_manifests(spark, path)
    return back.select(F.regexp_extract("manifest", "^(.*)/sources/", 1).alias("dir"), F.col("position").cast("long").alias("position"), "id", "body_sha256", F.array_join("source_files", " ").alias("source_files"))


@query(f"""WITH {SQL_MERGED}, t AS (SELECT DISTINCT dir FROM n), k AS (SELECT dir, id, source_files, 1 AS version FROM e WHERE id % 10 <> 5 AND dir NOT IN (SELECT dir FROM t))
SELECT dir, CAST(id AS VARCHAR) AS id, array_to_string(source_files, ' ') AS source_files, version FROM (SELECT * FROM m UNION ALL SELECT * FROM k)""")
def s6_merge_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests written, read, merged with new records and written over; directories that get none keep their files."""
    path = shared_folder(spark)

    def records(rows: DataFrame) -> DataFrame:
        return rows.select("dir", F.col("id").cast("string").alias("id"), "source_files", F.col("version").alias("paragraph_count"))

    existing, new, registry = _manifests(spark, sf_dir)
    writers.write_manifests(records(existing), path)
    stored = readers.read_manifests(spark, path).select(F.regexp_extract("manifest", "^(.*)/sources/", 1).alias("dir"), "id", "source_files", "paragraph_count")
    writers.write_manifests(assembly.merge_manifests(stored, records(new), registry.select(F.col("id").cast("string").alias("id"))), path)
    back = readers.read_manifests(spark, path)
    return back.select(F.regexp_extract("manifest", "^(.*)/sources/", 1).alias("dir"), "id", F.array_join("source_files", " ").alias("source_files"), F.col("paragraph_count").alias("version"))


@query(f"WITH {SQL_ROLLUP} SELECT directory AS location, directory, rule_count, descendant_rule_count, rule_count AS rules, CAST(len(children) AS BIGINT) AS children, array_to_string(children, ',') AS names FROM rollup_")
def s7_write_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes written rule by rule, one file for each directory, and read again."""
    path, docs = shared_folder(spark), documents_as_markdown(spark, sf_dir)
    writers.write_indexes(indexes.directory_heads(docs), indexes.rule_records(docs, ("language",)), path)
    back = readers.read_indexes(spark, path, ("language",))
    return back.select("location", "directory", "rule_count", "descendant_rule_count", F.size("rules").cast("long").alias("rules"), F.size("children").cast("long").alias("children"), F.array_join(F.transform("children", lambda c: c["name"]), ",").alias("names"))


@query(f"""WITH e AS (SELECT d.doc_id, source, {SQL_CATEGORY} AS c FROM documents d LEFT JOIN labels l USING (doc_id) WHERE lang = 'en' AND coalesce(toxic, 0) = 0), t AS (VALUES {", ".join(f"({q(k)}, {q(rules.RISK_PAGES[k])}, {q(a)}, {q(b)}, {q(c)})" for k, (a, b, c) in rules.RISK_TITLES.items())}),
l(c, en, cn) AS (VALUES {", ".join(f"({q(a)}, {q(b)}, {q(c)})" for a, b, c in rules.RISK_LABELS)}),
x AS (SELECT source, string_agg('- ' || coalesce(l.en, d.c), chr(10) ORDER BY d.c) AS en, string_agg('- ' || coalesce(l.cn, d.c), chr(10) ORDER BY d.c) AS cn FROM (SELECT DISTINCT source, c FROM e) d LEFT JOIN l ON l.c = d.c GROUP BY source),
y AS (SELECT source, min(doc_id) AS n, string_agg('- T' || doc_id || ': u', chr(10) ORDER BY doc_id) AS urls FROM e GROUP BY source)
SELECT 'p/' || source || '/' || t.col1 AS path, sha256('# N' || n || ' ' || t.col2 || chr(10) || chr(10) || '## ' || t.col3 || chr(10) || chr(10) || CASE t.col0 WHEN 'en' THEN en ELSE cn END || chr(10) || chr(10) || '## ' || t.col4 || chr(10) || chr(10) || urls || chr(10)) AS hash FROM x JOIN y USING (source), t""")
def s7_risk_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The English and the Chinese page of each platform group, written into its directory and read again."""
    path = shared_folder(spark)
    writers.write_risk_indexes(indexes.risk_index(_risky_entries(spark, sf_dir).withColumn("output_file", F.concat(F.lit("p/"), "platform_group", F.lit("/"), "id", F.lit(".md"))), indexes.risk_labels(spark)), path)
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return files.select(F.regexp_extract("_metadata.file_path", "/(p/.*)$", 1).alias("path"), text.content_hash(F.col("value")).alias("hash"))
