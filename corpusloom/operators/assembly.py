"""Bodies, their validation and status, records, documents and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import helpers, rules
from corpusloom.functions.text import (
    bbcode_references, bbcode_to_markdown, clean_pdf_lines, clean_text, content_hash, decode_entities, drop_chrome, help_article, host_of, html_to_text, let, paragraph_count, path_of, relative_path, slice_lines, trim_chrome,
)
from corpusloom.functions.urls import resolve_all
from corpusloom.operators.entries import is_low_value
from corpusloom.operators.links import apart, linked_lines, local_targets

SEPARATOR = "\n\n---\n\n"
# --- fixed values: what the opening note of a document says, and which notes count as uncertain ---
STUB_NOTE = "Opening Note: This file is a source stub only."
UNCERTAIN_EXTRACTION = r"(?iu)linked source download failed|challenge|not confirmed|uncertain|verify|不确定"
UNCERTAIN_STATUS = r"(?iu)uncertain|litigation|injunction|verify|not confirmed|不确定"


def assemble_bodies(pages: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``keys, body, notes`` of page texts ``text`` and ``note``: non-empty texts in order, notes in the same order.

    Only text is grouped; a source with a large part of all text is bounded by its entry, the unit that is joined.
    """
    parts = pages.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, "text", "note"))).alias("parts"))
    text = F.filter(F.transform("parts", lambda p: p["text"]), lambda t: t.isNotNull() & (t != ""))
    notes = F.filter(F.transform("parts", lambda p: p["note"]), lambda n: n.isNotNull() & (n != ""))
    return parts.select(*keys, F.array_join(text, SEPARATOR).alias("body"), F.array_join(notes, "; ").alias("notes"))


def validate(body: Column, required: Column, least: Column | None = None, notes: Column | None = None, numbers: bool = True) -> Column:
    """A struct of text, status, note, attempted hash and length: extracted, or a stub with the reasons."""
    return let(clean_text(F.coalesce(body, F.lit("")), numbers), lambda text: _validated(text, required, least, notes))


def _validated(text: Column, required: Column, least: Column | None, notes: Column | None) -> Column:
    least = F.lit(500) if least is None else F.coalesce(least, F.lit(500))
    none = F.expr("cast(array() as array<string>)")
    missing = F.filter(F.coalesce(required, none), lambda p: ~F.contains(F.lower(text), F.lower(p)))
    short = F.length(text) < least
    given = F.when(notes != "", notes) if notes is not None else F.lit(None).cast("string")
    reasons = F.concat_ws(
        "; ",
        F.when(short, F.concat(F.lit("extracted text length "), F.length(text).cast("string"), F.lit(" is below minimum "), least.cast("string"))),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing required phrase(s): "), F.array_join(missing, ", "))),
        given,
    )
    return let(F.struct(short.alias("short"), missing.alias("missing")), lambda x: _outcome(text, x["short"] | (F.size(x["missing"]) > 0), reasons, given))


def _outcome(text: Column, stub: Column, reasons: Column, given: Column) -> Column:
    return F.struct(
        F.when(stub, "").otherwise(text).alias("text"),
        F.when(stub, "stub").otherwise("extracted").alias("status"),
        F.when(stub, reasons).otherwise(given).alias("note"),
        F.when(stub & (text != ""), content_hash(text)).alias("attempted_text_sha256"),
        F.when(stub, F.length(text)).cast("long").alias("attempted_text_length"),
    )


def resolve_status(entries: DataFrame, downloads: DataFrame) -> DataFrame:
    """``id, status, note`` of ``id, primaries, require_linked, status, note`` and ``id, linked, ordinal, url, error``.

    Without any or some primary source an entry is a stub, likewise with failed linked ones that it requires; else the
    extraction's own status holds, with notes on failed linked sources.
    """
    failed = F.col("error").isNotNull()
    text = F.concat(F.col("url"), F.lit(": "), F.col("error"))
    linked_text = F.concat(F.col("url"), F.lit(": linked source download failed: "), F.col("error"))

    def listed(keep: Column, value: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("ordinal", value.alias("v"))))), lambda x: x["v"]), "; ")

    by = downloads.groupBy("id").agg(
        F.count_if(~F.col("linked") & ~failed).alias("got"), F.count_if(F.col("linked") & failed).alias("lost"),
        listed(~F.col("linked") & failed, text).alias("primary_notes"), listed(F.col("linked") & failed, text).alias("linked_notes"), listed(F.col("linked") & failed, linked_text).alias("soft_notes"),
    )
    rows = entries.join(by, "id", "left")
    got, lost = F.coalesce("got", F.lit(0)), F.coalesce("lost", F.lit(0))
    nothing = got == 0
    partly = got < F.col("primaries")
    required = (lost > 0) & F.coalesce("require_linked", F.lit(False))
    status = F.when(nothing | partly | required, "stub").otherwise(F.col("status"))
    own = F.concat_ws("; ", F.nullif("note", F.lit("")), F.nullif("soft_notes", F.lit("")))
    note = F.when(nothing, F.coalesce(F.nullif("primary_notes", F.lit("")), F.lit("no sources downloaded"))).when(partly, F.col("primary_notes")).when(required, F.col("linked_notes")).otherwise(F.nullif(own, F.lit("")))
    return rows.select("id", status.alias("status"), note.alias("note"))


#: Extractors whose pieces of HTML stand without an address, so that only whole URLs are links.
UNBASED = ("html-data-json", "xiaohongshu-contract-json", "tencent-rule-json", "bilibili-convention-js")
PIECES = "array<struct<head:string,html:string>>"
_FAQS = "struct<faqs:map<string,struct<title:string,content:string>>>"
_RULE = "struct<ruleName:string,releaseTime:string,effectTime:string,section:array<struct<moduleName:string,rawContent:string,content:string>>>"


def _one(html: Column) -> Column:
    return F.when(html.isNotNull(), F.array(F.struct(F.lit(None).cast("string").alias("head"), html.alias("html"))))


def rule_pieces(content: Column, numbers: bool = True) -> Column:
    """Head and HTML of the parts of a rule in JSON: name and dates, then its sections; null for what is no such rule."""
    info = F.from_json(F.get_json_object(content, "$.data.info"), _RULE)

    def pieces(x: Column) -> Column:
        dates = (F.concat(F.lit("发布时间："), F.nullif(x["releaseTime"], F.lit(""))), F.concat(F.lit("生效时间："), F.nullif(x["effectTime"], F.lit(""))))
        head = F.concat_ws("\n\n", clean_text(F.nullif(x["ruleName"], F.lit("")), numbers), *dates)
        first = F.array(F.struct(head.alias("head"), F.lit(None).cast("string").alias("html")))
        named = lambda s: F.concat(F.lit("## "), clean_text(F.nullif(s["moduleName"], F.lit("")), numbers))
        parts = F.transform(x["section"], lambda s: F.struct(named(s).alias("head"), F.coalesce(F.nullif(s["rawContent"], F.lit("")), s["content"]).alias("html")))
        return F.concat(first, parts)

    return let(info, lambda x: F.when(x["section"].isNotNull(), pieces(x)))


def tree_pieces(nodes: Column, numbers: bool = True) -> Column:
    """Head and HTML of the nodes of ``helpers.tree_nodes``."""
    return F.transform(nodes, lambda n: F.struct(F.concat(F.repeat(F.lit("#"), n["level"]), F.lit(" "), clean_text(n["title"], numbers)).alias("head"), n["content"].alias("html")))


def store_faqs(html: Column, numbers: bool = True) -> Column:
    """The entries of a page's FAQ store, an attribute with JSON, numbered ones in order; those without content are left out."""
    raw = F.regexp_extract(html, r"(?is)\bdata-faqstore=(?:\"([^\"]*)\"|'([^']*)')", 1)
    raw = F.when(raw != "", raw).otherwise(F.regexp_extract(html, r"(?is)\bdata-faqstore=(?:\"([^\"]*)\"|'([^']*)')", 2))
    faqs = F.map_entries(F.from_json(decode_entities(raw, numbers), _FAQS)["faqs"])
    faqs = F.array_sort(F.transform(faqs, lambda e, i: F.struct(F.coalesce(e["key"].try_cast("long"), F.lit(2**62)).alias("k"), i.alias("i"), e["value"].alias("v"))))
    return F.filter(faqs, lambda f: F.coalesce(f["v"]["content"], F.lit("")) != "")


def store_articles(faqs: Column, leads: Column, numbers: bool = True) -> Column:
    """The entries of ``store_faqs`` as Markdown; ``leads`` maps what their links refer to, where it resolves."""

    def article(f: Column) -> Column:
        title = F.concat(F.lit("# "), clean_text(F.nullif(f["v"]["title"], F.lit("")), numbers))
        return F.concat_ws("\n\n", title, F.nullif(bbcode_to_markdown(f["v"]["content"], lambda h: F.try_element_at(leads, h), numbers), F.lit("")))

    return F.transform(faqs, article)


def dispatch_extractor(pages: DataFrame, numbers: bool = True) -> DataFrame:
    """``pages`` with ``text`` and ``note``: the way by extractor, then by artifact type.

    ``pages``: url, content (text; of a PDF the text taken from it), type, extractor, and where there are any fetch_method, targets (a map of aliases to local targets) and the
    rules of slices: boundary_start, boundary_end, include_boundary_end, skip_line_patterns. Each way first yields pieces of HTML with their heads; these
    become lines in one expression for all ways, and the lines are then cut as the way has it. Pages without worth have an empty text.
    """

    def given(name: str, kind: str = "string") -> Column:
        return F.col(name) if name in pages.columns else F.lit(None).cast(kind)

    content, url, way = F.col("content"), F.col("url"), F.coalesce("extractor", F.lit("generic-html"))
    host, targets = host_of(url), F.col("targets") if "targets" in pages.columns else None
    stub = (given("fetch_method") == "stub") | (way == "stub")
    named = way.isin("x-help-html", "google-help-article", "github-docs-article", "steam-faqstore-json", *UNBASED)
    pdf = ~named & ((way == "pdf-text") | (F.col("type") == "pdf"))
    plain = ~named & ~pdf & ((way == "plain-text") | F.col("type").isin("txt", "json"))
    generic = ~named & ~pdf & ~plain

    main = F.regexp_extract(content, r"(?is)<main\b[^>]*id=[\"']twtr-main[\"'][^>]*>(.*?)</main>", 1)
    article = F.nullif(F.regexp_extract(content, r"(?is)<article\b[^>]*>(.*?)</article>", 1), F.lit(""))
    data = F.get_json_object(content, "$.data")
    rows = pages.withColumns({
        "scoped_": F.coalesce(helpers.scope_html(F.when(generic & host.isin(*rules.SCOPED_HOSTS), content), host), F.when(generic, content)),
        "body_": helpers.element_by_id(F.when(way == "github-docs-article", content), F.lit("article-contents")),
        "nodes_": helpers.tree_nodes(helpers.embedded_literal(F.when(way == "bilibili-convention-js", content), rules.CONVENTION_PHRASE)),
    })
    pieces = (
        F.when(stub, F.lit(None).cast(PIECES))
        .when(way == "bilibili-convention-js", tree_pieces(F.col("nodes_"), numbers))
        .when(way == "tencent-rule-json", rule_pieces(content, numbers))
        .when(way.isin("xiaohongshu-contract-json", "html-data-json"), _one(F.when(~data.rlike(r"^\s*[\[{]"), data)))
        .when(way == "x-help-html", _one(drop_chrome(F.when(main != "", main).otherwise(content))))
        .when(way == "google-help-article", _one(article))
        .when(way == "github-docs-article", _one(F.col("body_")))
        .when(generic, _one(drop_chrome(F.col("scoped_"))))
    )
    rows = apart(rows, "faqs_", F.when(way == "steam-faqstore-json", store_faqs(content, numbers)))
    rows = apart(rows, "asked_", F.array_distinct(F.flatten(F.transform("faqs_", lambda f: bbcode_references(f["v"]["content"], numbers)))))
    rows = rows.withColumn("leads_", F.map_from_arrays("asked_", local_targets(resolve_all(F.col("asked_"), url), targets)))
    base = F.when(~way.isin(*UNBASED), url)
    rows = linked_lines(rows.withColumn("pieces_", pieces), "pieces_", base, targets, numbers).withColumn("lines_", F.get("pieces_", 0)["lines"])

    def joined(lines: Column) -> Column:
        return F.array_join(lines, "\n\n")

    lines = F.col("lines_")
    cut = slice_lines(lines, given("boundary_start"), given("boundary_end"), given("include_boundary_end", "boolean"), given("skip_line_patterns", "array<string>"))
    rows = rows.withColumn("cut_", F.when(generic | (way == "google-help-article"), trim_chrome(cut, host)).when(way == "github-docs-article", cut))
    headed = F.array_join(F.filter(F.flatten(F.transform("pieces_", lambda p: F.array(p["head"], joined(p["lines"])))), lambda x: F.coalesce(x, F.lit("")) != ""), "\n\n")
    title = F.concat(F.lit("# "), F.nullif(html_to_text(F.regexp_extract(content, r"(?is)<h1\b[^>]*id=[\"']title-h1[\"'][^>]*>(.*?)</h1>", 1), numbers), F.lit("")))
    challenged = F.exists(lines, lambda x: x.rlike(rules.HELP_CHALLENGE))
    low = is_low_value(host, path_of(url), F.col("cut_"))
    text = (
        F.when(stub, "")
        .when(way.isin("tencent-rule-json", "bilibili-convention-js"), headed)
        .when(way.isin("xiaohongshu-contract-json", "html-data-json"), joined(lines))
        .when(way == "x-help-html", F.when(challenged, "").otherwise(joined(help_article(lines))))
        .when(way == "google-help-article", joined(F.col("cut_")))
        .when(way == "github-docs-article", F.when(F.size("cut_") > 0, F.concat_ws("\n\n", title, joined(F.col("cut_")))))
        .when(way == "steam-faqstore-json", F.array_join(store_articles(F.col("faqs_"), F.col("leads_"), numbers), SEPARATOR))
        .when(pdf, clean_pdf_lines(content, host))
        .when(plain, clean_text(content, numbers))
        .otherwise(F.when(low, "").otherwise(joined(F.col("cut_"))))
    )

    def noted(what: str) -> Column:
        return F.concat(url, F.lit(f": {what}"))

    note = (
        F.when(stub, "tracked as a stub; no full-text extraction was attempted")
        .when((way == "x-help-html") & challenged, noted("rendered page was a challenge page, not policy text"))
        .when(F.col("pieces_").isNull() & (way == "google-help-article"), noted("article element was not found"))
        .when(F.col("pieces_").isNull() & (way == "github-docs-article"), noted("article contents were not found"))
        .when(F.col("pieces_").isNull() & way.isin(*UNBASED), noted("the JSON payload was not found"))
        .when((way == "steam-faqstore-json") & (F.coalesce("text", F.lit("")) == ""), noted("the FAQ data store was not found or holds no records"))
    )
    return rows.withColumn("text", F.coalesce(text, F.lit(""))).withColumn("note", note).drop("scoped_", "body_", "nodes_", "faqs_", "asked_", "leads_", "pieces_", "lines_", "cut_")


def manifest_records(entries: DataFrame, artifacts: DataFrame, extractions: DataFrame) -> DataFrame:
    """One record for each entry: its fields, ordered lists of its artifacts, and what was extracted.

    ``artifacts``: id, linked, ordinal, url, source_file, sha256, bytes, error; ``extractions``: id, text, status, note.
    """
    ordered = F.array_sort(F.collect_list(F.struct("linked", "ordinal", "url", "source_file", "sha256", "bytes", "error")))
    by = artifacts.groupBy("id").agg(ordered.alias("a"))
    got = F.filter("a", lambda x: x["error"].isNull())
    linked = F.filter(got, lambda x: x["linked"])
    by = by.select(
        "id",
        F.transform(got, lambda x: x["source_file"]).alias("source_files"),
        F.transform(linked, lambda x: x["url"]).alias("linked_source_urls"),
        F.transform(linked, lambda x: x["source_file"]).alias("linked_source_files"),
        F.transform(F.filter("a", lambda x: x["linked"] & x["error"].isNotNull()), lambda x: F.struct(x["url"].alias("url"), x["error"].alias("error"))).alias("linked_source_errors"),
        F.transform(got, lambda x: F.struct(x["source_file"].alias("source_file"), x["sha256"].alias("sha256"), x["bytes"].alias("bytes"))).alias("source_sha256"),
    )
    text = F.nullif("text", F.lit(""))
    done = extractions.select("id", F.col("status").alias("extraction_status"), F.col("note").alias("extraction_note"), F.coalesce(paragraph_count(text), F.lit(0)).cast("long").alias("paragraph_count"), content_hash(text).alias("body_sha256"))
    return entries.join(by, "id", "left").join(done, "id", "left")


def render_rule_documents(entries: DataFrame) -> DataFrame:
    """``path, document``: heading, opening note, metadata, hashes, and the body or a stub.

    ``entries``: the record of an entry with ``path, title, source_urls, source_sha256, text, status, note, status_note`` and
    any of the other metadata fields, ``reference_urls``, and ``linked_source_urls`` with ``linked_source_files``.
    """
    opening = (
        F.when(F.col("status") == "stub", F.concat(F.lit(f"> {STUB_NOTE} Reason: "), F.coalesce(F.nullif("note", F.lit("")), F.lit("not specified"))))
        .when(F.col("note").rlike(UNCERTAIN_EXTRACTION), F.concat(F.lit("> Opening Note: "), F.coalesce(F.nullif("status_note", F.lit("")), F.lit("Some linked source extraction remains uncertain.")), F.lit(" Extraction note: "), F.col("note")))
        .when(F.col("status_note").rlike(UNCERTAIN_STATUS), F.concat(F.lit("> Opening Note: "), F.col("status_note")))
    )

    def field(key: str, name: str, default: str | None = None) -> Column:
        if name not in entries.columns:
            return F.lit(None).cast("string")
        value = F.col(name) if default is None else F.coalesce(F.nullif(name, F.lit("")), F.lit(default))
        return F.concat(F.lit(f"- {key}: "), value)

    def listed(name: str, head: str, line) -> Column:
        if name not in entries.columns:
            return F.lit(None).cast("string")
        return F.when(F.size(name) > 0, F.concat(F.lit(f"- {head}:\n"), F.array_join(F.transform(name, line), "\n")))

    urls = F.array_join(F.transform("source_urls", lambda u: F.concat(F.lit("- "), u)), "\n")
    references = listed("reference_urls", "Reference URL", lambda u: F.concat(F.lit("- "), u))
    linked = listed("linked_source_urls", "Linked Source URL", lambda u, i: linked_source_line(u, F.col("path"), F.get("linked_source_files", i)))
    hashes = F.array_join(F.transform("source_sha256", lambda s: F.concat(F.lit("- "), s["source_file"], F.lit(": "), s["sha256"])), "\n")
    hashes = F.coalesce(F.nullif(hashes, F.lit("")), F.lit("- not available because no source artifact was downloaded"))
    good = F.col("status") == "extracted"
    metadata = F.concat_ws(
        "\n",
        field("Collection", "collection"), field("Jurisdiction", "jurisdiction"), field("Scope Note", "scope_note"), field("Source Authority", "source_authority"),
        F.lit("- Source URL:"), urls, references, F.lit(""), linked, field("Retrieval Date", "retrieved_date"), field("Language", "language"), field("Language Group", "language_group"),
        field("Fetch Method", "fetch_method"), field("Extractor", "extractor", "generic-html"), field("Extraction Status", "status"), field("Status Note", "status_note", "None"),
        F.lit("- Source SHA-256:"), hashes,
        F.concat(F.lit("- Body SHA-256: "), F.when(good, content_hash(F.col("text"))).otherwise("not generated because this is a source stub")),
    )
    body = F.when(good, F.concat(F.lit("## Source Text\n\n"), F.col("text"))).otherwise("## Source Stub\n\nNo source text is kept here.")
    return entries.select("path", F.concat(F.concat_ws("\n\n", F.concat(F.lit("# "), F.col("title")), opening, metadata, body), F.lit("\n")).alias("document"))


def merge_manifests(existing: DataFrame, new: DataFrame, registry: DataFrame) -> DataFrame:
    """Existing records of directories that ``new`` touches, if registered and not replaced, and the new ones."""
    kept = existing.join(new.select("dir").distinct(), "dir", "left_semi").join(registry.select("id").distinct(), "id", "left_semi").join(new.select("dir", "id").distinct(), ["dir", "id"], "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def stale_artifacts(existing: DataFrame, new: DataFrame, merged: DataFrame) -> DataFrame:
    """``dir, source_file``: files of replaced records that no merged record of the directory names and that lie in it."""
    replaced = existing.join(new.select("dir", "id").distinct(), ["dir", "id"], "left_semi").select("dir", F.explode("source_files").alias("source_file")).distinct()
    named = merged.select("dir", F.explode("source_files").alias("source_file")).distinct()
    inside = F.regexp_replace("source_file", r"/[^/]*\z", "") == F.col("dir")
    return replaced.join(named, ["dir", "source_file"], "left_anti").where(inside)


def linked_source_line(url: Column, document: Column, file: Column) -> Column:
    return F.concat(F.lit("- "), url, F.lit(" -> "), relative_path(document, file))
