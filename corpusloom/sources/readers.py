"""Readers: every file goes through Spark's own sources, so that any path Spark can open will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.rules import NOT_RULES

ENTRY = (
    "id string, title string, collection string, jurisdiction string, scope_note string, source_authority string, language string, language_group string, "
    "status_note string, enabled boolean, output_file string, source_url string, source_urls array<string>, reference_urls array<string>, "
    "linked_source_urls array<string>, linked_source_url_patterns array<string>, linked_source_exclude_url_patterns array<string>, max_linked_sources int, "
    "linked_source_discovery_depth int, require_linked_sources boolean, extract_linked_sources boolean, fetch_method string, extractor string, "
    "source_extension string, boundary_start string, boundary_end string, include_boundary_end boolean, skip_line_patterns array<string>, min_body_chars int, "
    "required_phrases array<string>, reject_challenge_pages boolean, prefer_cached_primary_sources_first boolean, prefer_cached_linked_sources_first boolean, "
    "platform_group string, platform_name string, risk_categories array<string>"
)
HASH = "struct<source_file:string,sha256:string,bytes:bigint,downloader:string,fallback_from:string,content_type:string>"
RECORD = (
    "id string, title string, collection string, jurisdiction string, output_file string, source_urls array<string>, source_url string, "
    "reference_urls array<string>, linked_source_urls array<string>, linked_source_errors array<struct<url:string,error:string>>, source_files array<string>, "
    "source_file string, linked_source_files array<string>, retrieved_date string, language string, language_group string, extraction_status string, "
    "extraction_note string, paragraph_count int, body_sha256 string, attempted_text_sha256 string, attempted_text_length int, source_sha256 string"
)


def read_registry(spark: SparkSession, path: str, as_of: str | None = None) -> DataFrame:
    """One row for each entry, with its position and the retrieval date: the argument, the registry's, or today in Shanghai.

    A registry of another version than 1 fails the job when it is read.
    """
    raw = spark.read.schema(f"schema_version int, retrieval_date string, entries array<struct<{_fields(ENTRY)}>>").json(path, multiLine=True)
    today = F.to_date(F.from_utc_timestamp(F.current_timestamp(), "Asia/Shanghai")).cast("string")
    date = F.coalesce(F.lit(as_of), F.nullif("retrieval_date", F.lit("")), today)
    checked = F.when(F.col("schema_version") == 1, F.col("entries")).otherwise(F.raise_error(F.lit("expected registry schema version 1")))
    return raw.select(date.alias("retrieved_date"), F.posexplode(checked).alias("position", "e")).select("retrieved_date", "position", "e.*")


def _fields(ddl: str) -> str:
    return ", ".join(part.replace(" ", ":", 1) for part in ddl.split(", "))


def read_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """``path, content, length`` of the files under ``sources`` directories, manifests left out; paths count from the root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = _relative("path", root)
    rows = files.select(path.alias("path"), "content", "length")
    return rows.where(F.contains("path", F.lit("sources/")) & ~F.col("path").endswith("verification-manifest.json"))


def _relative(column: str, root: str):
    name = root.rstrip("/").rpartition("/")[2]
    return F.regexp_replace(F.col(column), rf"^.*?/\Q{name}\E/", "")


def read_manifests(spark: SparkSession, root: str, name: str = "verification-manifest.json") -> DataFrame:
    """The records of all manifests under a root, both schemas as one, with manifest path and position; ``name`` is the files' name or pattern.

    The older schema has one source URL, file and hash where the current one has lists; ``source_sha256`` is read as text and parsed
    by its shape.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name).text(root, wholetext=True)
    rows = files.select(F.col("_metadata.file_path").alias("manifest"), F.posexplode(F.from_json("value", f"array<struct<{_fields(RECORD)}>>")).alias("position", "r"))
    rows = rows.select(_relative("manifest", root).alias("manifest"), "position", "r.*")
    legacy = ~F.col("source_sha256").startswith("[")
    one = F.from_json(F.to_json(F.array(F.struct(F.col("source_file"), F.col("source_sha256").alias("sha256")))), f"array<{HASH}>")
    hashes = F.when(legacy, one).otherwise(F.from_json("source_sha256", f"array<{HASH}>"))
    urls = F.coalesce("source_urls", F.when(F.col("source_url").isNotNull(), F.array("source_url")))
    files_ = F.coalesce("source_files", F.when(F.col("source_file").isNotNull(), F.array("source_file")))
    return rows.withColumns({"source_urls": urls, "source_files": files_, "source_sha256": hashes}).drop("source_url", "source_file")


def read_indexes(spark: SparkSession, root: str, fields: tuple[str, ...] = ("collection", "jurisdiction", "language", "retrieval_date")) -> DataFrame:
    """The stored directory indexes as ``stale_indexes`` compares them: ``location``, and what each ``index.json`` says; null where it says nothing readable."""
    rule = ",".join(f"{name}:string" for name in ("file", "path", "title", *fields))
    child = "name:string,path:string,index:string,rule_count:bigint,descendant_rule_count:bigint"
    shape = f"schema_version int, directory string, generated_by string, rule_count bigint, descendant_rule_count bigint, rules array<struct<{rule}>>, children array<struct<{child}>>"
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "index.json").text(root, wholetext=True)
    rows = files.select(_relative("_metadata.file_path", root).alias("path"), F.from_json("value", shape).alias("x"))
    return rows.select(F.regexp_replace("path", r"/?index\.json\z", "").alias("location"), "x.*")


def read_rule_documents(spark: SparkSession, root: str, name: str = "*.md") -> DataFrame:
    """``path, document`` of the Markdown files (named by a pattern) that are rule documents."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name).text(root, wholetext=True)
    rows = files.select(_relative("_metadata.file_path", root).alias("path"), F.col("value").alias("document"))
    return rows.where(~F.regexp_extract("path", r"[^/]*\z", 0).isin(*NOT_RULES) & ~F.col("path").rlike(r"(^|/)sources/"))
