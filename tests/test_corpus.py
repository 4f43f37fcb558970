"""Assembly, merges, indexes, checks and files."""

import hashlib
import json

import pytest

from pyspark.sql import functions as F

from corpusloom.operators import assembly, entries, indexes, verification
from corpusloom.sources import readers, writers


def test_validate(spark):
    rows = spark.createDataFrame([("a" * 500, ["AA"]), ("a" * 499, ["zz"]), (None, None)], "b string, p array<string>")
    got = [r.x for r in rows.select(assembly.validate(F.col("b"), F.col("p")).alias("x")).collect()]
    assert (got[0].status, got[0].note) == ("extracted", None)
    assert got[1].note == "extracted text length 499 is below minimum 500; missing required phrase(s): zz"
    assert (got[2].status, got[2].attempted_text_sha256, got[2].attempted_text_length) == ("stub", None, 0)


def test_choose_artifact(spark):
    good, bad = "fine", "<title>Just a moment"
    rows = [
        (1, 0, "a", False, False, good, "html", "html"), (1, 0, "b", True, False, good, "html", "html"),
        (2, 0, "c", False, False, bad, "html", "html"), (2, 0, "d", True, False, good, "html", "html"),
        (3, 0, "e", True, False, bad, "html", "html"), (3, 0, "f", True, False, good, "txt", "html"),
        (4, 0, "g", False, True, None, "html", "pdf"), (4, 0, "h", True, False, good, "txt", "pdf"), (4, 0, "i", True, False, good, "pdf", "pdf"),
    ]
    df = spark.createDataFrame(rows, "id long, ordinal int, artifact string, cached boolean, failed boolean, text string, type string, expected string")
    pick = lambda **k: {r.id: r.artifact for r in entries.choose_artifact(df, **k).collect()}
    assert pick() == {1: "a", 2: "d", 4: "i"}
    assert pick(prefer_cached=True) == {1: "b", 2: "d", 4: "i"}


def test_status(spark):
    e = spark.createDataFrame([(i, 2, i == 4, "extracted", "n" if i == 5 else None) for i in range(1, 6)], "id long, primaries int, require_linked boolean, status string, note string")
    d = [(2, False, 0, "u", "lost"), (3, False, 0, "u", None), (3, False, 1, "v", "gone")] + [(i, False, k, "u", None) for i in (4, 5) for k in (0, 1)] + [(i, True, 0, "w", "no") for i in (4, 5)]
    got = {r.id: (r.status, r.note) for r in assembly.resolve_status(e, spark.createDataFrame(d, "id long, linked boolean, ordinal int, url string, error string")).collect()}
    assert got == {1: ("stub", "no sources downloaded"), 2: ("stub", "u: lost"), 3: ("stub", "v: gone"), 4: ("stub", "w: no"), 5: ("extracted", "n; w: linked source download failed: no")}


def test_merge_and_stale(spark):
    kind = "dir string, id string, source_files array<string>"
    old = spark.createDataFrame([("d", "a", ["d/1", "d/2", "e/3"]), ("d", "b", ["d/2"]), ("d", "gone", ["d/4"]), ("other", "z", [])], kind)
    new = spark.createDataFrame([("d", "a", ["d/9"])], kind)
    registry = spark.createDataFrame([("a",), ("b",), ("z",)], "id string")
    merged = assembly.merge_manifests(old, new, registry)
    assert sorted((r.id, r.source_files) for r in merged.collect()) == [("a", ["d/9"]), ("b", ["d/2"])]
    assert [tuple(r) for r in assembly.stale_artifacts(old, new, merged).collect()] == [("d", "d/1")]


def test_rollup_and_indexes(spark):
    docs = spark.createDataFrame([("a/x.md",), ("a/b/y.md",), ("a/b/README.md",), ("z.md",)], "path string")
    got = {r.directory: (r.rule_count, r.descendant_rule_count, r.children) for r in indexes.directory_rollup(docs).collect()}
    assert got == {"": (1, 3, ["a"]), "a": (1, 2, ["b"]), "a/b": (1, 1, [])}
    kind = "id long, collection string, platform_group string, platform_name string, enabled boolean, position int, title string, source_urls array<string>, risk_categories array<string>"
    rows = [(1, "platforms", "g", None, None, 0, "A", ["u", "v"], ["self_harm", "odd"]), (2, "platforms", "g", "N", True, 1, "B", ["w"], ["child_safety"]), (3, "platforms", "g", "N", False, 2, "C", [], ["fraud_scams"]), (4, "laws", "g", "N", True, 3, "D", [], [])]
    risk = indexes.risk_index(spark.createDataFrame(rows, kind), indexes.risk_labels(spark))
    r = risk.first()
    assert r.categories == ["child_safety", "odd", "self_harm"] and r.labels_en[1] == "odd" and r.sources == ["- A: u, v", "- B: w"] and r.labels_cn[2] == "自伤、自杀与进食障碍"


def test_checks_find_each_fault(spark):
    art = spark.createDataFrame([("s/1.html", bytearray(b"ok")), ("s/2.html", bytearray(b"<title>Just a moment")), ("s/9.html", bytearray(b"?"))], "path string, content binary")
    facts = verification.artifact_facts(art)
    sha = {r.path: r.sha256 for r in facts.collect()}
    declared = spark.createDataFrame([("e", "s/1.html", sha["s/1.html"], 2), ("f", "s/2.html", sha["s/2.html"], 5), ("g", "s/3.html", "x", None)], "entry_id string, path string, sha256 string, bytes long")
    v1 = {(r.entry_id, r.detail) for r in verification.artifact_integrity(declared, facts).collect()}
    assert v1 == {("f", "byte count mismatch"), ("f", "challenge page"), ("g", "missing")}
    assert [r.subject for r in verification.orphan_artifacts(facts, declared).collect()] == ["s/9.html"]
    rec = spark.createDataFrame([("1", ["a"], None), ("2", ["a", "b"], [("b", "h"), ("c", "h")]), ("3", ["a"], [("a", "h")]), ("4", ["a"], [("a", "h"), None, ("z", "")])], "id string, source_files array<string>, source_sha256 array<struct<source_file:string,sha256:string>>")
    found = [(r.entry_id, r.subject, r.detail) for r in verification.hash_coverage(rec).collect()]
    assert sorted(found) == [("1", "", "missing hash metadata"), ("2", "a", "file without hash"), ("2", "c", "hash without file"), ("4", "", "invalid hash entry"), ("4", "", "invalid hash entry")]
    good = "# T\n\n- Source URL:\n- https://a.org\n\n## Source Text\n\nbody\n"
    docs = spark.createDataFrame([("1.md", good), ("2.md", good.replace("body", "other")), ("3.md", "stub"), ("7.md", "# T\n\n## 正文\n\nbody\n")], "path string, document string")
    body = spark.sql("select sha2('body', 256) h").first().h
    records = spark.createDataFrame([("1", "1.md", "extracted", body), ("2", "2.md", "extracted", body), ("3", "3.md", "stub", None), ("4", "4.md", "extracted", body), ("5", "1.md", "odd", None), ("6", "1.md", None, body), ("7", "7.md", None, body), ("8", "7.md", "extracted", body)], "id string, output_file string, extraction_status string, body_sha256 string")
    got = {r.entry_id: r.detail for r in verification.body_status(records, docs).collect()}
    assert got == {"2": "body hash mismatch", "3": "stub without opening note", "4": "missing output file", "5": "unknown extraction status", "6": "missing body section", "8": "missing body section"}
    assert {r.id for r in verification.sound_bodies(records, docs).collect()} == {"1", "7"}
    index = indexes.rule_index(docs, ()).withColumn("location", F.col("directory"))
    assert verification.stale_indexes(index, docs).count() == 0


def test_fresh_output_passes_and_each_fault_shows(spark):
    """Documents, records and indexes as they are built have no failures."""
    kind = "id string, path string, title string, source_urls array<string>, reference_urls array<string>, linked_source_urls array<string>, linked_source_files array<string>, source_sha256 array<struct<source_file:string,sha256:string>>, text string, status string, note string, status_note string"
    rows = [("1", "a/1.md", "One", ["u1"], ["r1"], ["l1"], ["a/sources/l.html"], [("a/sources/s.html", "h"), ("a/sources/l.html", "h")], "body [x](https://o.org/p)", "extracted", None, None), ("2", "a/b/2.md", "Two", ["u2"], [], [], [], [("s2", "h")], "", "stub", "short", None)]
    entries_ = spark.createDataFrame(rows, kind)
    docs = assembly.render_rule_documents(entries_)
    records = entries_.select("id", F.col("path").alias("output_file"), "source_urls", "reference_urls", "linked_source_urls", "linked_source_files", F.transform("source_sha256", lambda h: h["source_file"]).alias("source_files"), "source_sha256", F.col("status").alias("extraction_status"), F.sha2("text", 256).alias("body_sha256"))
    index = indexes.rule_index(docs).withColumn("location", F.col("directory"))
    collected = entries_.select(F.explode("source_urls").alias("url"))

    def failures(records=records, docs=docs, index=index, collected=collected):
        checks = verification.hash_coverage(records), verification.document_references(records, docs), verification.body_status(records, docs), verification.online_links(verification.sound_bodies(records, docs), collected), verification.stale_indexes(index, docs)
        return [r.detail for r in verification.verify_corpus(*checks).collect()]

    assert failures() == []
    spoiled = index.withColumn("rule_count", F.col("rule_count") + (F.col("directory") == "a").cast("int"))
    spoiled = spoiled.withColumn("rules", F.transform("rules", lambda r: r.withField("title", F.when(r["file"] != "2.md", r["title"]))))
    spoiled = spoiled.withColumn("generated_by", F.when(F.col("directory") != "a/b", F.col("generated_by")))
    assert sorted(failures(index=spoiled)) == ["rule without title", "stale child rule count", "stale rule count", "wrong generator"]
    online = spark.createDataFrame([("http://o.org/p#x",)], "url string")
    unlike = docs.withColumn("document", F.replace("document", F.lit("r1"), F.lit("gone")))
    assert sorted(failures(docs=unlike, index=index.where("directory <> 'a/b'"), collected=online)) == ["child index not readable", "link to a collected source is online", "missing index", "missing reference URL", "stale descendant count"]


def test_localized_documents(spark):
    from corpusloom.operators import links

    document = "# T\n\n- Body SHA-256: 00ff\n\n## Source Text\n\n[a](https://o.org/p) [b](https://o.org/p/q)\n\n"
    docs = spark.createDataFrame([("d/1.md", document), ("d/2.md", "no body [a](https://o.org/p)")], "path string, document string")
    pairs = spark.createDataFrame([("http://o.org/p", "s/p).html", 0)], "url string, target string, at int")
    out = links.localize_documents(docs, links.build_link_map(pairs, ["at"])).collect()
    body = "[a](../s/p%29.html) [b](https://o.org/p/q)"
    assert len(out) == 1 and out[0].document == f"# T\n\n- Body SHA-256: {hashlib.sha256(body.encode()).hexdigest()}\n\n## Source Text\n\n{body}\n\n"
    records = spark.createDataFrame([("m", "d/1.md", "00ff"), ("m", "d/3.md", "x"), ("k", "e.md", "y")], "manifest string, output_file string, body_sha256 string")
    new = links.renew_hashes(records, spark.createDataFrame(out))
    assert sorted(tuple(r) for r in new.collect()) == [("m", "d/1.md", out[0].body_sha256), ("m", "d/3.md", "x")]


def test_files_round_trip(spark, tmp_path):
    root = tmp_path / "corpus"
    (root / "a/sources").mkdir(parents=True)
    (root / "registry.json").write_text(json.dumps({"schema_version": 1, "entries": [{"id": "x", "title": "T", "source_urls": ["u"], "enabled": False}]}))
    r = readers.read_registry(spark, str(root / "registry.json"), "2026-01-02").first()
    assert (r.id, r.enabled, r.retrieved_date, r.position) == ("x", False, "2026-01-02", 0)
    (root / "a/sources/verification-manifest.json").write_text(json.dumps([{"id": "old", "source_url": "u", "source_file": "f", "source_sha256": "h"}, {"id": "new", "source_urls": ["v"], "source_files": ["g"], "source_sha256": [{"source_file": "g", "sha256": "k", "bytes": 3}]}]))
    (root / "a/sources/page.html").write_text("<p>x</p>")
    (root / "a/doc.md").write_text("# D\n")
    (root / "a/README.md").write_text("no")
    rows = {r.id: r for r in readers.read_manifests(spark, str(root)).collect()}
    assert rows["old"].source_urls == ["u"] and rows["old"].source_sha256[0].sha256 == "h" and rows["new"].source_sha256[0].bytes == 3
    assert rows["old"].manifest == "a/sources/verification-manifest.json"
    assert [(r.path, bytes(r.content)) for r in readers.read_artifacts(spark, str(root)).collect()] == [("a/sources/page.html", b"<p>x</p>")]
    assert [(r.path, r.document) for r in readers.read_rule_documents(spark, str(root)).collect()] == [("a/doc.md", "# D\n")]


def stamps(root):
    return {str(p.relative_to(root)): (p.stat().st_mtime_ns, p.read_text()) for p in root.rglob("*") if p.is_file() and not p.name.endswith(".crc")}


def test_manifests_in_place(spark, tmp_path):
    """Records written come back by the default name; a merge leaves the files of other directories as they are, and a second one changes no text."""
    root = tmp_path / "corpus"
    rows = spark.createDataFrame([("d1", "a", ["d1/x"]), ("d1", "b", ["d1/y"]), ("d2/e", "c", []), ("", "top", None)], "dir string, id string, source_files array<string>")
    writers.write_manifests(rows.repartition(3), str(root))
    assert sorted(stamps(root)) == ["d1/sources/verification-manifest.json", "d2/e/sources/verification-manifest.json", "sources/verification-manifest.json"]
    assert json.loads((root / "d1/sources/verification-manifest.json").read_text()) == [{"id": "a", "source_files": ["d1/x"]}, {"id": "b", "source_files": ["d1/y"]}]
    back = readers.read_manifests(spark, str(root))
    assert sorted((r.manifest.rpartition("sources/")[0], r.position, r.id) for r in back.collect()) == [("", 0, "top"), ("d1/", 0, "a"), ("d1/", 1, "b"), ("d2/e/", 0, "c")]
    before = stamps(root)
    new = spark.createDataFrame([("d1", "b", ["d1/z"])], rows.schema)
    for _ in range(2):
        stored = back.select(F.regexp_extract("manifest", "^(.*)/sources/", 1).alias("dir"), "id", "source_files")
        writers.write_manifests(assembly.merge_manifests(stored, new, rows.select("id")), str(root))
        after = stamps(root)
        assert {k for k in after if after[k] != before[k]} == {"d1/sources/verification-manifest.json"}
        assert [(r["id"], r["source_files"]) for r in json.loads(after["d1/sources/verification-manifest.json"][1])] == [("a", ["d1/x"]), ("b", ["d1/z"])]
    writers.write_manifests(rows.limit(0), str(root))
    assert stamps(root).keys() == before.keys()


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    """A task that fails halfway leaves neither a half file nor anything staged, and the files that were there stay."""
    from corpusloom.sources import files

    root = tmp_path / "corpus"
    rows = spark.range(2000).select(F.concat(F.lit("d"), F.col("id") % 7, F.lit("/x.txt")).alias("file"), F.lit(0).alias("section"), F.col("id").cast("string").alias("value"), F.col("id").alias("n"))
    files.write_files(rows, str(root), "\n", ("n",))
    before = stamps(root)
    assert sorted(before) == [f"d{k}/x.txt" for k in range(7)] and before["d3/x.txt"][1].split("\n") == [str(n) for n in range(3, 2000, 7)]
    spoiled = rows.withColumn("value", F.when(F.col("n") == 1500, F.raise_error(F.lit("lost"))).otherwise(F.lit("other")))
    with pytest.raises(Exception, match="lost"):
        files.write_files(spoiled, str(root), "\n", ("n",))
    assert stamps(root) == before and not list(root.glob("_staged*"))
    for name in ("../x", "/x", ""):
        with pytest.raises(Exception, match="not a path below the root"):
            files.write_files(rows.limit(1).withColumn("file", F.lit(name)), str(root))
    assert stamps(root) == before and not list(root.glob("_staged*"))


def test_indexes_in_place(spark, tmp_path):
    """Indexes written rule by rule are those that the checks make of the documents; a lost rule is found in the files."""
    docs = spark.createDataFrame([(f"{d}r{k}.md", f"# T{k}\n\n- Language: en\n") for d in ("", "a/", "a/b/") for k in range(3)] + [("a/README.md", "no")], "path string, document string")
    root = tmp_path / "corpus"
    writers.write_indexes(indexes.directory_heads(docs), indexes.rule_records(docs, ("language",)), str(root))
    assert sorted(stamps(root)) == ["a/b/index.json", "a/index.json", "index.json"]
    wanted = {r.directory: r.asDict(True) for r in indexes.rule_index(docs, ("language",)).collect()}
    for r in readers.read_indexes(spark, str(root), ("language",)).collect():
        assert {k: v for k, v in r.asDict(True).items() if k != "location"} == wanted[r.location]
    assert verification.stale_indexes(readers.read_indexes(spark, str(root), ("language",)), docs).count() == 0
    path = root / "a/index.json"
    path.write_text(json.dumps({**json.loads(path.read_text()), "rules": []}))
    assert {r.detail for r in verification.stale_indexes(readers.read_indexes(spark, str(root), ("language",)), docs).collect()} == {"missing rule", "stale descendant count"}


def test_render_then_parse(spark):
    rows = spark.sql("select 'p.md' path, 'T' title, 'c' collection, array('https://a.org') source_urls, array(named_struct('source_file', 'f', 'sha256', 'h')) source_sha256, 'body' text, 'extracted' status, cast(null as string) note, 'litigation pending' status_note")
    from corpusloom.functions import text

    doc = assembly.render_rule_documents(rows)
    got = doc.select(text.body_of(F.col("document")).alias("b"), text.metadata_of(F.col("document"))["collection"].alias("c"), F.col("document").contains("> Opening Note: litigation pending").alias("n")).first()
    assert tuple(got) == ("body", "c", True)


def test_verify_corpus_is_all_checks(spark):
    """V10 finds over one corpus what the checks find one by one, row for row, though each table meets another only once."""
    from collections import Counter

    from corpusloom.jobs.queries import corpus_tables

    t = corpus_tables(spark, "/root/testdata/sf0.001")
    v, parts = verification, ("en/src1", "en/src3/")
    collected = t["records"].select(F.explode("source_urls").alias("url"))
    alone = [
        v.artifact_integrity(t["declared"], t["facts"]), v.hash_coverage(t["records"]), v.document_references(t["records"], t["documents"]), *(v.scope_notes(t["records"], t["documents"], p) for p in parts),
        v.body_status(t["records"], t["documents"]), v.online_links(v.sound_bodies(t["records"], t["documents"]), collected), v.orphan_artifacts(t["facts"], t["declared"]), v.registry_coverage(t["registry"], t["records"]), v.stale_indexes(t["stored"], t["documents"]),
    ]
    names = ("check", "entry_id", "subject", "detail")
    want = Counter(tuple(r) for x in alone for r in x.select(*names).collect())
    got = Counter(tuple(r) for r in v.verify_tables(**t, parts=parts).select(*names).collect())
    assert got == want and {r[0] for r in got} == {f"V{k}" for k in range(1, 10)}


def test_verify_an_empty_corpus(spark):
    from corpusloom.jobs.queries import corpus_tables

    t = {name: rows.limit(0) for name, rows in corpus_tables(spark, "/root/testdata/sf0.001").items()}
    assert verification.verify_tables(**t).count() == 0


def test_many_references(spark):
    """Thousands of URLs of one document: those that stand in it alone, within others, or in brackets are there; a lost one is named as often as it is listed."""
    urls = [f"https://a.org/{k}" for k in range(9000)] + ["https://b.org/x(1)", "https://lost.org/1", "https://a.org/8", "https://lost.org/1", "https://whole.org/p"]
    document = "# D\n" + "".join(f"- https://a.org/{k}\n" for k in range(9000)) + "[t](https://b.org/x(1)) https://whole.org/pages/2\n"
    records = spark.createDataFrame([(1, "d.md", urls, None, ["https://lost.org/2"], ["f"], [])], "id int, output_file string, source_urls array<string>, linked_source_urls array<string>, reference_urls array<string>, source_files array<string>, linked_source_files array<string>")
    found = verification.document_references(records, spark.createDataFrame([("d.md", document)], "path string, document string")).collect()
    assert sorted((r.subject, r.detail) for r in found) == [("https://lost.org/1", "missing source URL")] * 2 + [("https://lost.org/2", "missing reference URL")]
