"""Selection of entries, their sources, and the choice of artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import rules
from corpusloom.functions.text import is_challenge_page, trim

#: The order in which kept artifacts of other types stand in for the expected one.
TYPE_ORDER = ("html", "pdf", "txt", "xml", "json")


def select_entries(entries: DataFrame, ids: list | None = None, collections: list[str] | None = None, include_disabled: bool = False) -> DataFrame:
    """Entries by id and collection; an empty filter passes all, and an unknown ``enabled`` counts as enabled."""
    keep = F.lit(True) if include_disabled else F.coalesce("enabled", F.lit(True))
    if ids:
        keep &= F.col("id").isin(ids)
    if collections:
        keep &= F.col("collection").isin(collections)
    return entries.where(keep)


def explode_sources(entries: DataFrame) -> DataFrame:
    """``id, role, ordinal, url``: primary sources (the list before the single one), references and linked sources."""
    one = F.when(F.col("source_url").isNotNull() & (F.col("source_url") != ""), F.array("source_url"))
    lists = {"source": F.coalesce("source_urls", one), "reference": F.col("reference_urls"), "linked": F.col("linked_source_urls")}
    each = F.array(*(F.struct(F.lit(role).alias("role"), urls.alias("urls")) for role, urls in lists.items()))
    rows = entries.select("id", F.explode(each).alias("x"))
    return rows.select("id", "x.role", F.posexplode("x.urls").alias("ordinal", "url"))


def choose_artifact(candidates: DataFrame, prefer_cached: bool = False) -> DataFrame:
    """One artifact for each ``id, ordinal`` of ``id, ordinal, cached, failed, text, type, expected``; none where nothing is fit.

    Fresh artifacts come before cached ones, or after them with ``prefer_cached``. A fresh one is fit unless it failed or is a challenge page.
    Of the cached ones only the first by type counts: if that is a challenge page, there is no cached one.
    """
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, TYPE_ORDER)), F.col("type")), F.lit(99))
    by_type = F.when(F.col("type") == F.col("expected"), 0).otherwise(rank)
    first_cached = F.row_number().over(Window.partitionBy("id", "ordinal", "cached").orderBy(by_type, "artifact"))
    rows = candidates.withColumn("challenge", is_challenge_page(F.coalesce("text", F.lit("")))).withColumn("nth", first_cached)
    fit = ~F.col("challenge") & ~F.coalesce("failed", F.lit(False)) & (~F.col("cached") | (F.col("nth") == 1))
    order = F.when(F.col("cached") == F.lit(prefer_cached), 0).otherwise(1)
    best = F.row_number().over(Window.partitionBy("id", "ordinal").orderBy(order, "nth"))
    return rows.where(fit).withColumn("best", best).where("best = 1").drop("best", "nth", "challenge")


def is_low_value(host: Column, path: Column, lines: Column) -> Column:
    """Whether the rules of a host call a page worthless by its path and number of lines that are not blank."""
    count = F.size(F.filter(lines, lambda x: trim(x) != ""))
    out = F.lit(False)
    for h, needs, lacks, most in rules.LOW_VALUE:
        hit = host.endswith(h[1:]) if h.startswith("%") else host == h
        if needs:
            hit &= F.lower(path).rlike(needs)
        if lacks:
            hit &= ~F.contains(F.lower(path), F.lit(lacks))
        if most is not None:
            hit &= count <= most
        out |= F.coalesce(hit, F.lit(False))
    return out


def drop_low_value(pages: DataFrame) -> DataFrame:
    """``host, path, lines`` without worthless pages."""
    return pages.where(~is_low_value(F.col("host"), F.col("path"), F.col("lines")))


def compact_record(df: DataFrame, columns: list[str]) -> Column:
    """The row as JSON without null, empty text and empty lists."""

    def value(name: str) -> Column:
        kind = df.schema[name].dataType.simpleString()
        if kind == "string":
            return F.nullif(F.col(name), F.lit(""))
        return F.when(F.size(name) > 0, F.col(name)) if kind.startswith("array") else F.col(name)

    return F.to_json(F.struct(*(value(c).alias(c) for c in columns)), {"ignoreNullFields": "true"})
