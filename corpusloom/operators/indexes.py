"""Roll-ups: directories, rule and risk indexes, duplicates, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import rules
from corpusloom.functions.text import first_heading, metadata_of


def ancestors(path: Column) -> Column:
    """The directories above a file, the top one (``""``) first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def directory_of(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, r"/[^/]*\z", "")).otherwise("")


def directory_rollup(documents: DataFrame) -> DataFrame:
    """``directory, rule_count, descendant_rule_count, children`` of ``path``: every ancestor in one aggregation."""
    rows = documents.where(~F.regexp_extract("path", r"[^/]*\z", 0).isin(*rules.NOT_RULES))
    rows = rows.select("path", F.explode(ancestors(F.col("path"))).alias("directory"))
    direct = directory_of(F.col("path")) == F.col("directory")
    counts = rows.groupBy("directory").agg(F.count_if(direct).cast("long").alias("rule_count"), F.count("*").alias("descendant_rule_count"))
    child = counts.where("directory <> ''").groupBy(directory_of(F.col("directory")).alias("directory")).agg(F.array_sort(F.collect_list(F.regexp_extract("directory", r"[^/]*\z", 0))).alias("children"))
    none = F.expr("cast(array() as array<string>)")
    return counts.join(child, "directory", "left").withColumn("children", F.coalesce("children", none))


GENERATOR = "corpusloom"


def rule_records(documents: DataFrame, fields: tuple[str, ...] = ("collection", "jurisdiction", "language", "retrieval_date")) -> DataFrame:
    """``directory, file, path, title`` and metadata of ``path, document``; README and risk pages are no rules."""
    name = F.regexp_extract("path", r"[^/]*\z", 0)
    rows = documents.where(~name.isin(*rules.NOT_RULES)).withColumn("meta_", metadata_of(F.col("document")))
    meta = [F.try_element_at("meta_", F.lit(f)).alias(f) for f in fields]
    return rows.select(directory_of(F.col("path")).alias("directory"), name.alias("file"), "path", first_heading(F.col("document"), name).alias("title"), *meta)


def directory_heads(documents: DataFrame) -> DataFrame:
    """What an index says of its directory itself: version, directory, generator and counts."""
    return directory_rollup(documents).select(F.lit(1).alias("schema_version"), "directory", F.lit(GENERATOR).alias("generated_by"), "rule_count", "descendant_rule_count")


def rule_index(documents: DataFrame, fields: tuple[str, ...] = ("collection", "jurisdiction", "language", "retrieval_date")) -> DataFrame:
    """One row for each directory: version, directory, generator, counts, its rules by file name and its child directories.

    A row is one index file, so it is as large as its directory. ``rule_records`` has the same rules as rows, for directories that are too
    large for a file; the checks work on rows alone.
    """
    records = rule_records(documents, fields)
    listed = records.groupBy("directory").agg(F.array_sort(F.collect_list(F.struct("file", "path", "title", *fields))).alias("rules"))
    roll = directory_rollup(documents)
    child = roll.where("directory <> ''").groupBy(directory_of(F.col("directory")).alias("directory")).agg(
        F.array_sort(F.collect_list(F.struct(
            F.regexp_extract("directory", r"[^/]*\z", 0).alias("name"), F.col("directory").alias("path"), F.concat("directory", F.lit("/index.json")).alias("index"), "rule_count", "descendant_rule_count"
        ))).alias("children")
    )
    out = roll.drop("children").join(listed, "directory", "left").join(child, "directory", "left")
    none = F.filter(F.array(F.struct(*(F.lit("").alias(n) for n in ("file", "path", "title", *fields)))), lambda x: F.lit(False))
    nobody = F.expr("cast(array() as array<struct<name:string,path:string,index:string,rule_count:bigint,descendant_rule_count:bigint>>)")
    return out.select(F.lit(1).alias("schema_version"), "directory", F.lit(GENERATOR).alias("generated_by"), "rule_count", "descendant_rule_count", F.coalesce("rules", none).alias("rules"), F.coalesce("children", nobody).alias("children"))


def risk_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(rules.RISK_LABELS), "category string, label_en string, label_cn string")


def risk_index(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """``platform_group, directory, name, categories, labels_en, labels_cn, sources`` of the enabled platform entries.

    The directory is that of the first entry's ``output_file``, the group itself where entries have none. ``labels`` has one row for each category, a dozen, and is broadcast.
    """
    rows = entries.where((F.col("collection") == "platforms") & F.coalesce("enabled", F.lit(True)) & (F.coalesce("platform_group", F.lit("")) != ""))
    place = directory_of(F.min_by("output_file", "position")) if "output_file" in entries.columns else F.col("platform_group")
    named = rows.groupBy("platform_group").agg(
        place.alias("directory"),
        F.coalesce(F.min_by("platform_name", "position"), F.col("platform_group")).alias("name"),
        F.transform(F.array_sort(F.collect_list(F.struct("position", F.concat(F.lit("- "), F.col("title"), F.lit(": "), F.array_join("source_urls", ", ")).alias("line")))), lambda x: x["line"]).alias("sources"),
    )
    tags = rows.select("platform_group", F.explode("risk_categories").alias("category")).distinct().join(F.broadcast(labels), "category", "left")
    tags = tags.groupBy("platform_group").agg(F.array_sort(F.collect_list(F.struct("category", F.coalesce("label_en", "category").alias("en"), F.coalesce("label_cn", "category").alias("cn")))).alias("t"))
    out = named.join(tags, "platform_group", "left")
    return out.select("platform_group", "directory", "name", *(F.coalesce(F.col(f"t.{f}"), F.expr("cast(array() as array<string>)")).alias(a) for f, a in (("category", "categories"), ("en", "labels_en"), ("cn", "labels_cn"))), "sources")


def duplicate_values(df: DataFrame, key: str) -> DataFrame:
    """``key, count`` of values seen more than once; null and empty ones do not count."""
    return df.where((F.col(key).isNotNull()) & (F.col(key).cast("string") != "")).groupBy(key).agg(F.count("*").alias("count")).where("count > 1")


def index_summary(index: DataFrame) -> DataFrame:
    """How many directory indexes there are, and how many rules they list."""
    return index.agg(F.count("*").alias("indexes"), F.coalesce(F.sum(F.size("rules")), F.lit(0)).cast("long").alias("indexed_rules"))


def corpus_summary(records: DataFrame, by: str | None = None) -> DataFrame:
    """Counts of records checked, extracted, stubs and failed ones, over all or by a column."""
    grouped = records.groupBy(by) if by else records.groupBy()
    return grouped.agg(
        F.count("*").alias("checked"), F.count_if(F.col("extraction_status") == "extracted").cast("long").alias("extracted"),
        F.count_if(F.col("extraction_status") == "stub").cast("long").alias("stubs"), F.coalesce(F.sum("failures"), F.lit(0)).cast("long").alias("failures"),
    )
