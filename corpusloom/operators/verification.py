"""Checks of a whole corpus. Each returns failures ``(check, entry_id, subject, detail)``; no rows mean that it holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import body_of, is_challenge_page, let, relative_path
from corpusloom.functions.urls import url_aliases
from corpusloom.operators.assembly import STUB_NOTE
from corpusloom.functions.rules import NOT_RULES
from corpusloom.operators.indexes import GENERATOR, ancestors, directory_of, duplicate_values
from corpusloom.operators.links import markdown_links
from corpusloom.sources.shared import cut


FEW = 16  # URLs that are searched in a document one by one
ORPHAN, NO_SCOPE = "unreferenced artifact", "missing scope note"


def failure(check: str, entry: Column, subject: Column, detail: Column | str) -> list[Column]:
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return [F.lit(check).alias("check"), entry.cast("string").alias("entry_id"), subject.cast("string").alias("subject"), detail.alias("detail")]


def artifact_facts(artifacts: DataFrame) -> DataFrame:
    """``path, sha256, bytes, challenge`` of ``path, content``: hashes in the scan, so that no bytes are shuffled."""
    page = F.col("path").rlike(r"(?i)\.(html|xml)\z")
    text = F.decode(F.encode(F.make_valid_utf8(F.col("content").cast("string")), "UTF-8"), "UTF-8")
    return artifacts.select("path", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("bytes"), (page & is_challenge_page(text)).alias("challenge"))


def artifact_integrity(declared: DataFrame, facts: DataFrame) -> DataFrame:
    """V1: missing artifacts, other hashes or sizes, challenge pages. ``declared``: entry_id, path, sha256, bytes."""
    rows = declared.alias("d").join(facts.alias("f"), "path", "left")
    return rows.select("entry_id", "path", F.explode(_artifact_faults()).alias("what")).select(*failure("V1", F.col("entry_id"), F.col("path"), F.col("what")))


def _artifact_faults() -> Column:
    return F.array_compact(F.array(
        F.when(F.col("f.sha256").isNull(), "missing"),
        F.when(F.col("f.sha256") != F.col("d.sha256"), "hash mismatch"),
        F.when(F.col("d.bytes").isNotNull() & (F.col("f.bytes") != F.col("d.bytes")), "byte count mismatch"),
        F.when(F.col("challenge"), "challenge page"),
    ))


def artifact_checks(declared: DataFrame, facts: DataFrame) -> DataFrame:
    """V1 and V7 by one join of what is declared with what is there."""
    one = F.lit(True)
    rows = declared.withColumn("said", one).alias("d").join(facts.withColumn("there", one).alias("f"), "path", "full_outer")
    found = F.when(F.col("said"), F.transform(_artifact_faults(), lambda w: F.struct(F.lit("V1").alias("c"), w.alias("w")))).otherwise(F.array(F.struct(F.lit("V7").alias("c"), F.lit(ORPHAN).alias("w"))))
    return rows.select("entry_id", "path", F.explode(found).alias("x")).select(F.col("x.c").alias("check"), F.col("entry_id").cast("string").alias("entry_id"), F.col("path").alias("subject"), F.col("x.w").alias("detail"))


def hash_coverage(records: DataFrame) -> DataFrame:
    """V2: of ``id, source_files, source_sha256``: missing hash metadata, entries without file or hash, files without hashes and hashes without files."""
    return records.select("id", F.explode(_hash_faults()).alias("x")).select(*failure("V2", F.col("id"), F.col("x.s"), F.col("x.w")))


def _said(of: Column, what: str) -> Column:
    return F.transform(of, lambda s: F.struct(s.alias("s"), F.lit(what).alias("w")))


def _hash_faults() -> Column:
    none = F.expr("cast(array() as array<string>)")
    valid = F.filter("source_sha256", lambda h: (F.coalesce(h["source_file"], F.lit("")) != "") & (F.coalesce(h["sha256"], F.lit("")) != ""))
    files, hashed = F.coalesce("source_files", none), F.transform(valid, lambda h: h["source_file"])
    invalid = F.array_repeat(F.lit(""), F.size("source_sha256") - F.size(valid))
    found = F.concat(_said(invalid, "invalid hash entry"), _said(F.array_except(files, hashed), "file without hash"), _said(F.array_except(hashed, files), "hash without file"))
    return F.when(F.col("source_sha256").isNull(), _said(F.array(F.lit("")), "missing hash metadata")).otherwise(found)


def document_references(records: DataFrame, documents: DataFrame) -> DataFrame:
    """V3: every URL and linked file of a record must be in its document.

    ``records``: id, output_file, source_urls, linked_source_urls, reference_urls, source_files, linked_source_files; ``documents``: path,
    document. One equi-join on the document; containment is then a row's own matter.
    """
    rows = records.join(documents, F.col("output_file") == F.col("path"))
    return rows.select("id", F.explode(_reference_faults()).alias("x")).select(*failure("V3", F.col("id"), F.col("x.s"), F.col("x.w")))


def _reference_faults() -> Column:
    none = F.expr("cast(array() as array<string>)")

    # most URLs stand in the document by themselves and are found in the set of those; only the others are searched in the text one by one
    written = F.array_distinct(F.regexp_extract_all("document", F.lit(r"https?://[^\s<>\")\]]+"), F.lit(0)))

    def lost(name: str, what: str) -> Column:
        named = F.coalesce(name, none)
        few = F.filter(named, lambda u: ~F.contains(F.col("document"), u))
        gone = F.filter(F.array_except(named, written), lambda u: ~F.contains(F.col("document"), u))
        many = let(gone, lambda g: F.when(F.size(g) == 0, none).otherwise(F.filter(named, lambda u: F.array_contains(g, u))))
        return _said(F.when(F.size(named) > FEW, many).otherwise(few), what)

    local = F.transform(F.coalesce("linked_source_files", none), lambda f: relative_path(F.col("output_file"), f))
    return F.concat(
        lost("source_urls", "missing source URL"), lost("linked_source_urls", "missing linked source URL"), lost("reference_urls", "missing reference URL"),
        _said(F.array_except(F.coalesce("linked_source_files", none), F.coalesce("source_files", none)), "linked file not in source files"),
        _said(F.filter(local, lambda p: ~F.contains(F.col("document"), p)), "missing local reference"),
    )


def scope_notes(records: DataFrame, documents: DataFrame, part: str = "/united-states/states/") -> DataFrame:
    """V4: documents under a directory need a scope note."""
    rows = records.where(F.contains("output_file", F.lit(part))).join(documents, F.col("output_file") == F.col("path"))
    return rows.where(_without_scope()).select(*failure("V4", F.col("id"), F.col("output_file"), NO_SCOPE))


def _without_scope() -> Column:
    return ~F.contains("document", F.lit("Scope Note:"))


def _status() -> Column:
    return F.coalesce(F.nullif("extraction_status", F.lit("")), F.when(F.col("body_sha256").isNotNull(), "legacy"))


def _bodies(records: DataFrame, documents: DataFrame) -> DataFrame:
    """Records with their documents and the body under the marker of their status."""
    rows = records.join(documents, F.col("output_file") == F.col("path"), "left").withColumn("status_", _status())
    legacy, current = (body_of(F.col("document"), marker) for marker in ("正文", "Source Text"))
    return rows.withColumn("body_", F.when(F.col("status_") == "legacy", legacy).when(F.col("status_") == "extracted", current))


def body_status(records: DataFrame, documents: DataFrame) -> DataFrame:
    """V5: by status, the body must be under its marker with its hash, or the stub must say so."""
    return _bodies(records, documents).withColumn("what", _status_fault()).where("what is not null").select(*failure("V5", F.col("id"), F.col("output_file"), F.col("what")))


def _status_fault() -> Column:
    status, read = F.col("status_"), F.col("status_").isin("legacy", "extracted")
    return (
        F.when(F.col("document").isNull(), "missing output file")
        .when(read & F.col("body_").isNull(), "missing body section")
        .when(read & ~F.sha2("body_", 256).eqNullSafe(F.col("body_sha256")), "body hash mismatch")
        .when(read, F.lit(None))
        .when((status == "stub") & ~F.contains("document", F.lit(STUB_NOTE)), "stub without opening note")
        .when(status == "stub", F.lit(None))
        .otherwise("unknown extraction status")
    )


def record_checks(records: DataFrame, documents: DataFrame, parts: tuple[str, ...]) -> DataFrame:
    """``id, faults, links``: V2 to V5 of each record by one join with its document, and the links of sound bodies that V6 looks up.

    Both are cut off in the shared folder without the texts, so the documents move once.
    """
    rows = _bodies(records, documents)
    there, status = F.col("document").isNotNull(), _status_fault()
    scoped = F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains("output_file", p)) if parts else F.lit(False)

    def of(check: str, faults: Column) -> Column:
        none = F.expr("cast(array() as array<struct<check:string,subject:string,detail:string>>)")
        return F.coalesce(F.transform(faults, lambda x: F.struct(F.lit(check).alias("check"), x["s"].alias("subject"), x["w"].alias("detail"))), none)

    place = F.array(F.col("output_file"))
    faults = F.concat(of("V2", _hash_faults()), of("V3", F.when(there, _reference_faults())), of("V4", F.when(there & scoped & _without_scope(), _said(place, NO_SCOPE))), of("V5", F.when(F.col("what_").isNotNull(), F.transform(place, lambda s: F.struct(s.alias("s"), F.col("what_").alias("w"))))))
    links = F.when(F.sha2("body_", 256) == F.col("body_sha256"), F.array_distinct(markdown_links(F.col("body_"))))
    return cut(rows.withColumn("what_", status).select("id", faults.alias("faults"), links.alias("links")))


def sound_bodies(records: DataFrame, documents: DataFrame) -> DataFrame:
    """``id, body`` of the records that V5 passes, the bodies that V6 reads."""
    return _bodies(records, documents).where(F.sha2("body_", 256) == F.col("body_sha256")).select("id", F.col("body_").alias("body"))


def online_links(bodies: DataFrame, collected: DataFrame) -> DataFrame:
    """V6: links in ``id, body`` (of ``sound_bodies``) that still lead to a collected ``url``, once for each entry.

    Both sides are reduced to distinct URLs and aliases before they meet.
    """
    links = bodies.select("id", F.explode(F.array_distinct(markdown_links(F.col("body")))).alias("url"))
    return _online(links, collected)


def _online(links: DataFrame, collected: DataFrame) -> DataFrame:
    """V6 of ``id, url`` rows."""
    known = collected.select(F.explode(url_aliases(F.col("url"))).alias("alias")).distinct()
    online = links.select("url").distinct().select("url", F.explode(url_aliases(F.col("url"))).alias("alias")).join(known, "alias", "left_semi").select("url").distinct()
    return links.join(online, "url", "left_semi").select(*failure("V6", F.col("id"), F.col("url"), "link to a collected source is online"))


def orphan_artifacts(facts: DataFrame, declared: DataFrame) -> DataFrame:
    """V7: artifacts that no record names."""
    return facts.select("path").join(declared.select("path").distinct(), "path", "left_anti").select(*failure("V7", F.lit(None), F.col("path"), ORPHAN))


def registry_coverage(registry: DataFrame, records: DataFrame) -> DataFrame:
    """V8: ids and output files that only one side has, and duplicates on either side."""
    parts = []
    for key in ("id", "output_file"):
        both = registry.select(key).distinct().withColumn("r", F.lit(True)).join(records.select(key).distinct().withColumn("m", F.lit(True)), key, "full_outer")
        what = F.when(F.col("m").isNull(), f"{key} missing from manifests").otherwise(f"{key} missing from registry")
        parts.append(both.where("r is null or m is null").select(*failure("V8", F.lit(None), F.col(key), what)))
        for side, df in (("registry", registry), ("manifest", records)):
            parts.append(duplicate_values(df, key).select(*failure("V8", F.lit(None), F.col(key), f"duplicate {side} {key}")))
    return reduce(DataFrame.unionByName, parts)


def coverage_checks(registry: DataFrame, records: DataFrame) -> DataFrame:
    """V8 by one aggregation over the ids and output files of both sides."""

    def keys(rows: DataFrame, side: str) -> DataFrame:
        pairs = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("key")) for k in ("id", "output_file")))
        return rows.select(F.inline(pairs)).select("kind", "key", F.lit(side).alias("side"))

    both = keys(registry, "registry").unionByName(keys(records, "manifest")).groupBy("kind", "key")
    both = both.agg(F.count_if(F.col("side") == "registry").alias("r"), F.count_if(F.col("side") == "manifest").alias("m"))
    named = F.coalesce("key", F.lit("")) != ""

    def says(test: Column, before: str, after: str) -> Column:
        return F.when(test, F.concat(F.lit(before), "kind", F.lit(after)))

    found = F.array(says(F.col("m") == 0, "", " missing from manifests"), says(F.col("r") == 0, "", " missing from registry"), says(named & (F.col("r") > 1), "duplicate registry ", ""), says(named & (F.col("m") > 1), "duplicate manifest ", ""))
    return both.select("key", F.explode(F.array_compact(found)).alias("w")).select(*failure("V8", F.lit(None), F.col("key"), F.col("w")))


def stale_indexes(stored: DataFrame, documents: DataFrame, generator: str = GENERATOR) -> DataFrame:
    """V9: stored indexes against the directories, rules and child indexes that there are.

    ``stored``: location (the directory of the file), schema_version, directory, generated_by, rule_count, descendant_rule_count, rules and children as of
    ``rule_index``; ``documents``: path. Rules and children are compared as rows, by joins on directory and name, so no directory is one task's.
    """
    name = F.regexp_extract("path", r"[^/]*\z", 0)
    paths = documents.where(~name.isin(*NOT_RULES)).select("path", name.alias("name"), directory_of(F.col("path")).alias("at"))
    place = F.concat(F.when(F.col("at") == "", "").otherwise(F.concat("at", F.lit("/"))), "name")
    fields = ("schema_version", "said", "generated_by", "rule_count", "descendant_rule_count", "listed", "has_rules", "has_children")

    # what is known of each directory: the rules below it, and its index
    real = paths.select(F.col("at").alias("own"), F.explode(ancestors(F.col("path"))).alias("at")).select("at", F.struct((F.col("own") == F.col("at")).alias("direct")).alias("d"))
    kept = stored.select(F.col("location").alias("at"), F.struct("schema_version", F.col("directory").alias("said"), "generated_by", "rule_count", "descendant_rule_count", F.coalesce(F.size("rules"), F.lit(0)).alias("listed"), F.col("rules").isNotNull().alias("has_rules"), F.col("children").isNotNull().alias("has_children")).alias("s"))
    own = real.unionByName(kept, allowMissingColumns=True).groupBy("at").agg(F.count_if(F.col("d").isNotNull()).alias("below"), F.count_if(F.col("d.direct")).alias("direct"), F.any_value("s", F.lit(True)).alias("s"))
    own = cut(own.select("at", (F.col("below") > 0).alias("known"), "direct", F.col("s").isNotNull().alias("there"), *(F.col(f"s.{f}").alias(f) for f in fields)))

    def wrong(test: Column, what: str) -> Column:
        return F.when(F.col("there") & F.col("known") & test, what)

    def faults(*found: Column) -> Column:
        return F.explode(F.array_compact(F.array(*found))).alias("w")

    heads = own.select("at", F.lit("").alias("name"), faults(
        F.when(~F.col("there"), "missing index"), F.when(~F.col("known"), "index of no directory"), wrong(~F.col("schema_version").eqNullSafe(F.lit(1)), "wrong schema version"), wrong(~F.col("said").eqNullSafe(F.col("at")), "wrong directory field"),
        wrong(~F.col("generated_by").eqNullSafe(F.lit(generator)), "wrong generator"), wrong(~F.col("has_rules"), "rules are no list"), wrong(~F.col("has_children"), "children are no list"), wrong(~F.col("rule_count").eqNullSafe(F.col("direct")), "stale rule count"),
    ))

    # rules and children as rows, those that there are and those that indexes list, met by directory and name
    child_at = F.regexp_replace("index", r"/index\.json\z", "")
    ends = own.where("there").select(F.col("at").alias("child"), F.col("rule_count").alias("its_rules"), F.col("descendant_rule_count").alias("its_all"))
    flat = stored.select(F.col("location").alias("at"), F.explode(F.concat(
        F.transform(F.coalesce("rules", F.array()), lambda r: F.struct(F.lit(False).alias("kid"), F.coalesce(r["file"], F.lit("")).alias("name"), r["path"].alias("path"), (F.coalesce(r["title"], F.lit("")) == "").alias("untitled"), F.lit(None).cast("string").alias("index"), F.lit(None).cast("long").alias("rule_count"), F.lit(None).cast("long").alias("descendant_rule_count"))),
        F.transform(F.coalesce("children", F.array()), lambda c: F.struct(F.lit(True).alias("kid"), F.coalesce(c["name"], F.lit("")).alias("name"), c["path"].alias("path"), F.lit(False).alias("untitled"), c["index"].alias("index"), c["rule_count"].alias("rule_count"), c["descendant_rule_count"].alias("descendant_rule_count"))),
    )).alias("x")).select("at", "x.*")
    kids = flat.where("kid").join(ends, child_at == F.col("child"), "left")
    gone = F.col("child").isNull()
    flags = {
        "strays": ~F.col("path").eqNullSafe(place), "untitled": F.col("untitled"), "lacking": F.col("kid") & ((F.col("name") == "") | F.col("index").isNull()), "misses": F.col("kid") & (F.col("index") != F.concat(place, F.lit("/index.json"))), "gone": F.col("kid") & gone,
        "stale": F.col("kid") & ~gone & ~F.col("rule_count").eqNullSafe(F.col("its_rules")), "stale_all": F.col("kid") & ~gone & ~F.col("descendant_rule_count").eqNullSafe(F.col("its_all")),
    }
    listed = flat.where("not kid").unionByName(kids, allowMissingColumns=True).select("at", "kid", "name", F.lit(1).alias("listed"), F.lit(0).alias("real"), "its_all", *(test.alias(f) for f, test in flags.items()))
    files = paths.select("at", F.lit(False).alias("kid"), "name")
    folders = own.where("known and at <> ''").select(directory_of(F.col("at")).alias("at"), F.lit(True).alias("kid"), F.regexp_extract("at", r"[^/]*\z", 0).alias("name"))
    both = listed.unionByName(files.unionByName(folders).withColumn("real", F.lit(1)), allowMissingColumns=True)
    facts = both.groupBy("at", "kid", "name").agg(F.sum(F.coalesce("listed", F.lit(0))).alias("n"), F.max("real").alias("real"), F.sum("its_all").alias("below"), *(F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in flags))
    facts = cut(facts.join(own.where("there and known").select("at"), "at", "left_semi"))
    rule, some, odd = ~F.col("kid"), F.col("n") > 0, F.col("real") == 0
    named, sound = some & (F.col("name") != ""), some & ~F.col("lacking")
    names = facts.select("at", "name", faults(
        F.when(rule & ~some, "missing rule"), F.when(rule & (F.col("name") == ""), "rule without file"), F.when(rule & named & (F.col("n") > 1), "duplicate rule"), F.when(rule & named & F.contains("name", F.lit("/")), "misplaced rule"),
        F.when(rule & named & odd, "rule does not exist"), F.when(rule & named & F.col("strays"), "wrong rule path"), F.when(rule & named & F.col("untitled"), "rule without title"),
        F.when(~rule & ~some, "missing child"), F.when(~rule & F.col("lacking"), "child without name or index"), F.when(~rule & sound & (F.col("n") > 1), "duplicate child"), F.when(~rule & sound & odd, "child does not exist"), F.when(~rule & sound & F.col("strays"), "wrong child path"),
        F.when(~rule & sound & F.col("misses"), "wrong child index"), F.when(~rule & sound & F.col("gone"), "child index not readable"), F.when(~rule & sound & F.col("stale"), "stale child rule count"), F.when(~rule & sound & F.col("stale_all"), "stale child descendant count"),
    ))

    below = facts.where(F.col("kid") & sound).groupBy("at").agg(F.sum("below").alias("below"))
    total = own.where("there and known").join(below, "at", "left").withColumn("all_", F.col("listed") + F.coalesce("below", F.lit(0)))
    total = total.where(~F.col("descendant_rule_count").eqNullSafe(F.col("all_"))).select("at", F.lit("").alias("name"), F.lit("stale descendant count").alias("w"))
    found = reduce(DataFrame.unionByName, (heads, names, total))
    return found.select(*failure("V9", F.lit(None), F.when(F.col("name") == "", F.col("at")).otherwise(F.concat_ws(": ", "at", "name")), F.col("w")))


def verify_corpus(*checks: DataFrame) -> DataFrame:
    """V10: the failures of all checks; the corpus passes where there are none."""
    return reduce(DataFrame.unionByName, checks)


def verify_tables(registry: DataFrame, records: DataFrame, documents: DataFrame, declared: DataFrame, facts: DataFrame, stored: DataFrame, parts: tuple[str, ...] = ("/united-states/states/",)) -> DataFrame:
    """V10 from the tables of a corpus: the failures of all checks.

    Each table meets another once: records their documents (V2-V6), declared artifacts those there are (V1, V7), registry and manifests (V8), indexes the directories (V9).
    Collected sources, which V6 looks for, are the source and linked URLs of the records.
    """
    none = F.expr("cast(array() as array<string>)")
    checked = record_checks(records, documents, parts)
    own = checked.select("id", F.inline("faults")).select(*failure("", F.col("id"), F.col("subject"), F.col("detail"))[1:], "check")
    collected = records.select(F.explode(F.concat(F.coalesce("source_urls", none), F.coalesce("linked_source_urls", none))).alias("url")).distinct()
    online = _online(checked.select("id", F.explode("links").alias("url")), collected)
    return verify_corpus(own, online, artifact_checks(declared, facts), coverage_checks(registry, records), stale_indexes(stored, documents))
