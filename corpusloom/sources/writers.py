"""Writers: manifests, indexes and risk pages in the places where they are looked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import rules
from corpusloom.sources.files import write_files

MANIFEST, INDEX = "sources/verification-manifest.json", "index.json"


def _below(directory: Column, name: str) -> Column:
    return F.when(directory == "", name).otherwise(F.concat(directory, F.lit(f"/{name}")))


def write_texts(texts: DataFrame, path: str) -> None:
    """The ``value`` of each ``dir`` as a text file of Spark's own below ``dir=<dir>``; a line feed follows it."""
    texts.select("dir", "value").repartition("dir").write.mode("overwrite").partitionBy("dir").text(path)


def write_manifests(records: DataFrame, root: str, order: str = "id") -> None:
    """The records of each ``dir`` as one JSON array in ``<dir>/sources/verification-manifest.json``, by the column ``order``.

    A column ``record`` is taken as the record's JSON; else all columns but ``dir`` make it, null ones left out. Other directories keep their files.
    """
    fields = [c for c in records.columns if c != "dir"]
    record = F.col("record") if "record" in fields else F.to_json(F.struct(*fields))
    rows = records.select(_below(F.col("dir"), MANIFEST).alias("file"), F.lit(1).alias("section"), record.alias("value"), F.col(order).alias("order"))
    ends = F.array(F.struct(F.lit(0).alias("section"), F.lit("[\n").alias("value")), F.struct(F.lit(2).alias("section"), F.lit("\n]\n").alias("value")))
    ends = rows.select("file").distinct().select("file", F.inline(ends))
    write_files(rows.unionByName(ends, allowMissingColumns=True), root, ",\n", ("order",))


def write_indexes(heads: DataFrame, records: DataFrame, root: str) -> None:
    """``<directory>/index.json`` of each directory, rule by rule and child by child, so that no row holds a directory.

    ``heads`` as of ``directory_heads``; ``records`` as of ``rule_records``, whose columns but ``directory`` make a rule.
    """
    file = _below(F.col("directory"), INDEX).alias("file")

    def section(k: int, value: Column, order: Column) -> list[Column]:
        return [file, F.lit(k).alias("section"), value.alias("value"), order.alias("order")]

    none, name = F.lit(None).cast("string"), F.regexp_extract("directory", r"[^/]*\z", 0)
    head = F.to_json(F.struct("schema_version", "directory", "generated_by", "rule_count", "descendant_rule_count"))
    head = F.concat(F.regexp_replace(head, r"\}\z", ""), F.lit(',"rules":[\n'))
    rule = F.to_json(F.struct(*(c for c in records.columns if c != "directory")))
    child = F.to_json(F.struct(name.alias("name"), F.col("directory").alias("path"), F.concat("directory", F.lit(f"/{INDEX}")).alias("index"), "rule_count", "descendant_rule_count"))
    above = F.when(F.col("directory").contains("/"), F.regexp_replace("directory", r"/[^/]*\z", "")).otherwise("")
    children = heads.where("directory <> ''").select(above.alias("directory"), child.alias("value"), name.alias("order")).select(file, F.lit(3).alias("section"), "value", "order")
    rows = heads.select(*section(0, head, none))
    for part in (records.select(*section(1, rule, F.col("file"))), heads.select(*section(2, F.lit('\n],"children":[\n'), none)), children, heads.select(*section(4, F.lit("\n]}\n"), none))):
        rows = rows.unionByName(part)
    write_files(rows, root, ",\n", ("order",))


def risk_page(language: str) -> Column:
    """A page of a row of ``risk_index`` in English or Chinese."""
    title, tags, sources = rules.RISK_TITLES[language]
    labels = F.array_join(F.transform(f"labels_{language}", lambda x: F.concat(F.lit("- "), x)), "\n")
    return F.concat(F.concat_ws("\n\n", F.concat(F.lit("# "), F.col("name"), F.lit(f" {title}")), F.lit(f"## {tags}"), labels, F.lit(f"## {sources}"), F.array_join("sources", "\n")), F.lit("\n"))


def write_risk_indexes(risks: DataFrame, root: str) -> None:
    """An English and a Chinese page for each platform group, in its ``directory``."""
    pages = F.array(*(F.struct(F.lit(name).alias("name"), risk_page(x).alias("value")) for x, name in rules.RISK_PAGES.items()))
    rows = risks.select("directory", F.inline(pages))
    file = F.when(F.col("directory") == "", F.col("name")).otherwise(F.concat_ws("/", "directory", "name"))
    write_files(rows.select(file.alias("file"), F.lit(0).alias("section"), "value"), root)
