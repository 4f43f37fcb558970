"""Links: extraction, admission, discovery, and local targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import broken_lines, html_to_text, let, long_preformatted, relative_path, rewritten, trim, without_noise
from corpusloom.functions import rules
from corpusloom.sources.shared import cut
from corpusloom.functions.urls import aliases_all, canonical_all, policy_slug, resolve_all, url_aliases

PAIRED = r"(?is)<a\b[^>]*?href=(?:\"([^\"]*)\"|'([^']*)')[^>]*>(.*?)</a>"
SINGLE = r"(?is)<a\b[^>]*?href=(?:\"([^\"]*)\"|'([^']*)')[^>]*/>\s*([^<\n]+)"
MARKDOWN = r"\[([^\[\]]+)\]\((https?://[^)\s]+)\)"


def extract_links(pages: DataFrame, numbers: bool = True) -> DataFrame:
    """``page_id, ordinal, url, key, text`` of the anchors of ``page_id, url, html``: paired ones in order, then self-closing ones."""

    def anchors(pattern: str) -> Column:
        parts = F.struct(*(F.regexp_extract_all("html", F.lit(pattern), F.lit(k)).alias(f"g{k}") for k in (1, 2, 3)))
        return let(parts, lambda m: F.transform(m["g1"], lambda double, i: F.struct(F.concat(double, F.get(m["g2"], i)).alias("href"), F.get(m["g3"], i).alias("inner"))))

    # a page's references are resolved together, before they become rows
    rows = apart(pages.select("page_id", F.col("url").alias("base"), "html"), "anchors", F.concat(anchors(PAIRED), anchors(SINGLE))).drop("html")
    rows = apart(rows, "urls", resolve_all(F.transform("anchors", lambda a: a["href"]), F.col("base")))
    rows = rows.select("page_id", F.posexplode(F.arrays_zip(F.col("urls").alias("url"), canonical_all(F.col("urls")).alias("key"), F.transform("anchors", lambda a: a["inner"]).alias("inner"))).alias("ordinal", "a"))
    return rows.select("page_id", "ordinal", "a.url", "a.key", "a.inner").where("url is not null").select("page_id", "ordinal", "url", "key", html_to_text(F.col("inner"), numbers).alias("text"))


def apart(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with a column that is worked out before what is made of it.

    Spark puts expressions into each other, and does not find a call of Python whose arguments hold functions within functions; this keeps them apart.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def local_targets(found: Column, targets: Column | None) -> Column:
    """For each URL of an array the target of its first alias in a map of aliases, or the URL itself."""
    if targets is None:
        return found

    def target(url: Column, aliases: Column) -> Column:
        known = F.filter(F.transform(aliases, lambda a: F.try_element_at(targets, a)), lambda t: t.isNotNull())
        return F.coalesce(F.get(known, 0), url)

    return F.zip_with(found, aliases_all(found), target)


def linked_lines(rows: DataFrame, pieces: str, base: Column, targets: Column | None = None, numbers: bool = True) -> DataFrame:
    """``rows`` with the column ``pieces``, an array of head and HTML, turned into heads and lines whose anchors are Markdown links.

    Links lead to local targets where ``targets`` (alias to target) has one. Self-closing anchors take the text after them. Anchors without text are a
    space; fragments and references that do not resolve leave their text. Each step is a column of its own, as nested functions would be too deep to analyse.
    """

    def step(rows: DataFrame, **fields) -> DataFrame:
        """The fields of each piece, by name from the piece before."""
        return rows.withColumn(pieces, F.transform(pieces, lambda p: F.struct(*(f(p).alias(name) for name, f in {"head": lambda p: p["head"], "pre": lambda p: p["pre"], **fields}.items()))))

    def same(name: str):
        return lambda p: p[name]

    rows = step(rows, pre=lambda p: long_preformatted(p["html"], numbers), html=lambda p: without_noise(F.coalesce(p["html"], F.lit(""))))
    for pattern, paired in ((SINGLE, False), (PAIRED, True)):

        def groups(k: int, pattern: str = pattern):
            return lambda p: F.regexp_extract_all(p["html"], F.lit(pattern), F.lit(k))

        rows = step(rows, between=lambda p, pattern=pattern: F.split(p["html"], pattern), whole=groups(0), a=groups(1), b=groups(2), inner=groups(3))
        rows = step(rows, between=same("between"), whole=same("whole"), href=lambda p: F.zip_with(p["a"], p["b"], lambda a, b: F.concat(a, b)), label=lambda p: F.transform(p["inner"], lambda t: html_to_text(t, numbers)))
        # the references of all pieces are resolved in one call; a fragment has no target of its own among paired anchors
        hrefs = F.flatten(F.transform(pieces, lambda p: p["href"]))
        hrefs = F.transform(hrefs, lambda h: F.when(~trim(h).startswith("#"), h)) if paired else hrefs
        rows = apart(rows, "hrefs_", hrefs).withColumn("resolved_", local_targets(resolve_all(F.col("hrefs_"), base), targets))

        def of_piece(p: Column, i: Column) -> Column:
            before = F.aggregate(F.slice(pieces, F.lit(1), i), F.lit(0), lambda n, q: n + F.size(q["href"]))
            return F.struct(p["head"].alias("head"), p["pre"].alias("pre"), p["between"].alias("between"), p["whole"].alias("whole"), p["label"].alias("label"), F.slice("resolved_", before + 1, F.size(p["href"])).alias("url"))

        rows = rows.withColumn(pieces, F.transform(pieces, of_piece)).drop("resolved_", "hrefs_")

        def anchor(p: Column, i: Column, paired: bool = paired) -> Column:
            label, url = F.get(p["label"], i), F.get(p["url"], i)
            link = F.concat(F.lit(" ["), label, F.lit("]("), F.replace(url, F.lit(")"), F.lit("%29")), F.lit(") "))
            empty, bare = (F.lit(" "), F.concat(F.lit(" "), label, F.lit(" "))) if paired else (F.get(p["whole"], i),) * 2
            return F.when(label == "", empty).when(url.isNull(), bare).otherwise(link)

        rows = step(rows, html=lambda p, anchor=anchor: F.array_join(F.transform(p["between"], lambda t, i: F.concat(t, F.coalesce(anchor(p, i), F.lit("")))), ""))
    lines = F.transform(pieces, lambda p: F.struct(p["head"].alias("head"), F.coalesce(p["pre"], broken_lines(p["html"], numbers)).alias("lines")))
    return rows.withColumn(pieces, lines)


def markdown_links(body: Column) -> Column:
    return F.regexp_extract_all(body, F.lit(MARKDOWN), F.lit(2))


def _aliases(rows: DataFrame) -> Column:
    """The aliases of ``url``, from the column where a table has them already."""
    return F.col("aliases") if "aliases" in rows.columns else url_aliases(F.col("url"))


def admit_links(links: DataFrame, entries: DataFrame) -> DataFrame:
    """The rows of ``id, url, ...`` that an entry lets in.

    A link with an alias of one of the entry's explicit links is in whatever the patterns say; any other needs
    an include pattern and no exclude pattern. The entry's patterns come by an equi-join on its id.
    """
    explicit = entries.select("id", F.explode("linked_source_urls").alias("u")).select("id", F.explode(url_aliases(F.col("u"))).alias("alias")).distinct()
    named = links.select("id", "url", _aliases(links).alias("aliases")).dropDuplicates(["id", "url"]).select("id", "url", F.explode("aliases").alias("alias"))
    named = named.join(explicit, ["id", "alias"], "left_semi").select("id", "url").distinct().withColumn("named", F.lit(True))
    none = F.expr("cast(array() as array<string>)")
    ruled = links.join(entries.select("id", F.coalesce("include", none).alias("include"), F.coalesce("exclude", none).alias("exclude")), "id").join(named, ["id", "url"], "left")

    def any_of(patterns: str) -> Column:
        return F.exists(patterns, lambda p: F.call_function("rlike", F.col("url"), F.concat(F.lit("(?iu)"), p)))

    return ruled.where(F.coalesce("named", F.lit(False)) | (any_of("include") & ~any_of("exclude"))).drop("include", "exclude", "named")


def with_aliases(links: DataFrame) -> DataFrame:
    """``links`` with the aliases of each URL, and for policy pages their canonical URL with its aliases."""
    slug = policy_slug(F.col("url"))
    rows = links.withColumns({"aliases": url_aliases(F.col("url")), "slug": slug})
    canonical = F.when(F.col("slug") == rules.POLICY_WITHOUT_PAGE, F.regexp_replace(F.format_string(rules.POLICY_URL, "slug"), r"\.html\z", "")).when(F.col("slug").isNotNull(), F.format_string(rules.POLICY_URL, "slug"))
    rows = apart(rows, "canonical", canonical).drop("slug")
    return rows.withColumn("canonical_aliases", url_aliases(F.col("canonical")))


def preferred_url(links: DataFrame, entries: DataFrame) -> DataFrame:
    """``links`` (id, url, ... of ``with_aliases``) with policy pages by their canonical URL, where their entry lets that one in."""
    wanted = links.where("canonical is not null").select("id", F.col("canonical").alias("url"), F.col("canonical_aliases").alias("aliases")).dropDuplicates(["id", "url"])
    let_in = admit_links(wanted, entries).select("id", F.col("url").alias("canonical"), F.lit(True).alias("let_in"))
    rows = links.join(let_in, ["id", "canonical"], "left")
    better = F.coalesce("let_in", F.lit(False)) | F.coalesce(F.col("canonical").endswith(f"/{rules.POLICY_WITHOUT_PAGE}"), F.lit(False))
    rows = rows.withColumns({"url": F.when(better, F.col("canonical")).otherwise(F.col("url")), "aliases": F.when(better, F.col("canonical_aliases")).otherwise(F.col("aliases"))})
    return rows.drop("canonical", "canonical_aliases", "let_in")


def discover_links(entries: DataFrame, links: DataFrame, depth: int = 1, cap: int | None = None) -> DataFrame:
    """``id, url, depth, position``: the linked sources of each entry, breadth first, in the order of its queue.

    ``entries``: id, source_urls, linked_source_urls, include, exclude, and where there are any max_linked_sources and
    linked_source_discovery_depth, which come before ``cap`` and ``depth``; ``links``: page_url, ordinal, url. Explicit links come first, then the anchors of
    the entry's own pages in order, then those of each page of the queue. A candidate is left out if any alias of it was seen; ``_first_of_each`` settles a level in
    rounds of joins. Aliases are worked out once for each link, before the levels; links and levels are cut off in the shared folder.
    """

    def rule(name: str, default: int | None) -> Column:
        return F.coalesce(name, F.lit(default).cast("int")) if name in entries.columns else F.lit(default).cast("int")

    limits = entries.select("id", rule("max_linked_sources", cap).alias("most"), F.coalesce(rule("linked_source_discovery_depth", depth), F.lit(1)).alias("deepest"))
    levels = max(1, limits.agg(F.max("deepest")).first()[0] or 1)
    own = entries.select("id", F.posexplode("source_urls").alias("position", "url")).select("id", "url", F.col("position").cast("long"))
    own = cut(own.withColumns({"depth": F.lit(0), "aliases": url_aliases(F.col("url"))}))
    start = entries.select("id", F.posexplode("linked_source_urls").alias("rank", "url")).select("id", "url", F.lit(1).alias("depth"), F.lit(-1).cast("long").alias("at"), F.col("rank").cast("long").alias("ordinal"))
    by_page = links.select(F.col("ordinal").cast("long").alias("ordinal"), "url", F.get(url_aliases(F.col("page_url")), 0).alias("page_alias"))
    by_page = cut(with_aliases(by_page))
    found, frontier = own, own
    for level in range(1, levels + 1):
        pages = frontier.join(limits.where(F.col("deepest") >= level).select("id"), "id", "left_semi") if level > 1 else frontier
        pages = pages.select("id", F.get("aliases", 0).alias("page_alias"), F.col("position").alias("at"))
        reached = pages.join(by_page, "page_alias").drop("page_alias").withColumn("depth", F.lit(level))
        reached = with_aliases(start).unionByName(reached) if level == 1 else reached
        frontier = _settle(found, admit_links(preferred_url(reached, entries), entries), limits)
        found = found.unionByName(frontier)
    return found.where("depth > 0").select("id", "url", "depth", "position")


def _settle(known: DataFrame, candidates: DataFrame, limits: DataFrame) -> DataFrame:
    """The candidates of which no alias is known or taken by one before them, with their positions in the queue, up to the cap of the entry."""
    seen = known.select("id", F.explode("aliases").alias("alias")).distinct()
    first = cut(candidates.groupBy("id", "url", "depth").agg(F.min(F.struct("at", "ordinal")).alias("rank"), F.first("aliases").alias("aliases")))
    rows = first.select("id", "url", "rank", F.explode("aliases").alias("alias"))
    fresh = rows.join(rows.join(seen, ["id", "alias"], "left_semi").select("id", "url").distinct(), ["id", "url"], "left_anti")
    settled = first.join(_first_of_each(fresh), ["id", "url"], "left_semi")
    used = known.where("depth > 0").groupBy("id").agg(F.count("*").alias("used"))
    nth = F.row_number().over(Window.partitionBy("id").orderBy("rank", "url"))
    out = settled.join(limits, "id").join(used, "id", "left").withColumn("position", (nth + F.coalesce("used", F.lit(0))).cast("long") - 1)
    return cut(out.where(F.col("most").isNull() | (F.col("position") < F.col("most"))).select("id", "url", "position", "depth", "aliases"))


def _first_of_each(rows: DataFrame) -> DataFrame:
    """Of ``id, url, rank, alias``, a row for each alias of a candidate, the candidates (id, url) that a walk in the order of rank would take.

    In each round every candidate that is the first of all its aliases among those undecided is taken, and what shares an alias with a taken one is out. No
    earlier candidate can change that, so the result is the walk's; each round is a pass of windows and one table, and settles the first candidate of every entry at least, and most settle in the first one.
    """
    taken, open_, order = rows.select("id", "url").limit(0), cut(rows), F.struct("rank", "url")
    alias, candidate = Window.partitionBy("id", "alias"), Window.partitionBy("id", "url")
    while not open_.isEmpty():
        judged = open_.withColumn("leads", order == F.min(order).over(alias)).withColumn("leads", F.bool_and("leads").over(candidate))
        judged = cut(judged.withColumn("gone", F.bool_or("leads").over(alias)).withColumn("gone", F.bool_or("gone").over(candidate)))
        taken = taken.unionByName(judged.where("leads").select("id", "url"))
        open_ = judged.where("not gone").select("id", "url", "rank", "alias")
    return taken


def build_link_map(pairs: DataFrame, order: list[str]) -> DataFrame:
    """``alias, target`` of ``url, target`` and order columns: the first target of each alias, in one aggregation."""
    each = pairs.where("target is not null").select("target", *order, F.explode(url_aliases(F.col("url"))).alias("alias"))
    return each.groupBy("alias").agg(F.min_by("target", F.struct(*order, "target")).alias("target"))


def lookup_targets(urls: DataFrame, link_map: DataFrame) -> DataFrame:
    """``url, target`` of distinct URLs: the target of the first alias, in alias order, that has one."""
    each = urls.select("url").distinct().select("url", F.posexplode(url_aliases(F.col("url"))).alias("rank", "alias"))
    return each.join(link_map, "alias").groupBy("url").agg(F.min_by("target", "rank").alias("target"))


def localize_documents(documents: DataFrame, link_map: DataFrame) -> DataFrame:
    """``path, document, body_sha256`` of the documents that change: links of the body made local, and the hash in the header renewed."""
    head = F.regexp_extract("document", r"(?s)\A(?:.*?\n)?## (?:Source Text|正文)\n\n?", 0)
    rows = documents.select("path", "document", head.alias("head")).where("head <> ''")
    rows = rows.withColumn("rest", F.substr("document", F.length("head") + 1)).withColumn("body", F.rtrim("rest", F.lit("\n")))
    rows = rows.select("path", "head", "body", F.nullif(F.substr("rest", F.length("body") + 1), F.lit("")).alias("tail"))
    new = localize_links(rows.select("path", "body"), link_map).withColumnsRenamed({"body": "new"})
    rows = rows.join(new, "path")
    document = F.concat("head", "new", F.coalesce("tail", F.lit("\n")))
    for key in ("Body SHA-256: ", "正文 SHA-256："):
        document = F.regexp_replace(document, F.lit(rf"(?is)\A(?<before>.*?- {key})[0-9a-f]+"), F.concat(F.lit("${before}"), "body_sha256"))
    return rows.select("path", document.alias("document"), "body_sha256")


def renew_hashes(records: DataFrame, changed: DataFrame) -> DataFrame:
    """All ``records`` (manifest, output_file, body_sha256, ...) of the manifests that name a changed document, with the new hashes."""
    new = changed.select(F.col("path").alias("output_file"), F.col("body_sha256").alias("renewed"))
    rows = records.join(new, "output_file", "left")
    touched = rows.where("renewed is not null").select("manifest").distinct()
    return rows.join(touched, "manifest", "left_semi").withColumn("body_sha256", F.coalesce("renewed", "body_sha256")).drop("renewed").select(*records.columns)


def localize_links(documents: DataFrame, link_map: DataFrame) -> DataFrame:
    """``path, body, body_sha256`` of the documents that change: known links become relative paths.

    The body is cut at its links and put together again in order, so that a URL that begins like another is left alone.
    """
    links = documents.select("path", F.explode(F.array_distinct(markdown_links(F.col("body")))).alias("url"))
    targets = links.join(lookup_targets(links, link_map), "url").where("target <> path")
    targets = targets.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("url", F.replace(relative_path(F.col("path"), F.col("target")), F.lit(")"), F.lit("%29"))))).alias("targets"))
    rows = documents.join(targets, "path")
    new = rewritten(F.col("body"), MARKDOWN, 2, lambda whole, label, url: F.coalesce(F.concat(F.lit("["), label, F.lit("]("), F.try_element_at("targets", url), F.lit(")")), whole))
    out = rows.select("path", new.alias("new"), "body").where("new <> body")
    return out.select("path", F.col("new").alias("body"), F.sha2("new", 256).alias("body_sha256"))
