"""Operator 8, mixing sources to target weights: pivotal dependent rounding, in DataFrame expressions only.

Every source gets a target in words, every document of it the same expected number of copies (target / size of the source).
The whole part of that number is taken outright. The fractional parts are rounded against each other: two documents
exchange words at random, each raised as likely as the other in proportion, until one of them is at 0 or 1, so that the
words a source expects stay what they were and each document keeps its own expectation. What is left of a pair meets
the next document. This runs in small blocks of a reduction tree: each block passes at most one fractional document up, and the
last one of a source is rounded alone. A source so misses its target by less than its longest document.

Defined cases: a null text has size 0; documents of size 0 are not taken; null is a source of its own, after all others; rows
equal in id, source, size and text are counted before the shuffle and share the copies drawn for them; with no words at
all every target is 0; an empty table gives an empty result. The draw depends on the rows and the seed alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD, cut, let, times

WEIGHTS = (5.0, 2.0, 1.0)
FAN_BITS = 6  # a block of the tree takes in about 2^6 documents or block residuals at most
TINY = 1e-9


def unit(*cols) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / float(1 << 53)


def numbered(rows: DataFrame, column: str) -> DataFrame:
    """``nth`` from 1 in the order of a column, null last: numbered range by range, so that only the ranges' counts meet in one task."""
    order = F.col(column).asc_nulls_last()
    rows = cut(rows.repartitionByRange(order).withColumn("range_", F.spark_partition_id()))
    before = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("range_").agg(F.count("*").alias("n_"))
    ahead = counts.select("range_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("ahead_"))
    nth = F.row_number().over(Window.partitionBy("range_").orderBy(order)) + F.col("ahead_")
    return rows.join(F.broadcast(ahead), "range_").withColumn("nth", nth).drop("range_", "ahead_")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0) -> DataFrame:
    """``source, source_size, target, documents`` from ``source, size, n``: shares by weight, at most ``most`` sizes each.

    One row per source. The level, which times its weight is the target of a source that is not full, rises as the excess of the
    full ones is shared again, until no more of them fill up; each round is one sum over all sources.
    """
    by = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("documents"))
    by = numbered(by, "source").withColumn("weight", F.array(*map(F.lit, weights))[((F.col("nth") - 1) % len(weights)).cast("int")])
    by = cut(by.withColumn("full", most * F.col("source_size")))
    total, level, filled = by.agg(F.sum("source_size")).first()[0] or 0, 0.0, -1
    while True:
        is_full = F.col("full") <= F.col("weight") * level
        r = by.agg(F.count_if(is_full).alias("n"), F.sum(F.when(is_full, F.col("full"))).alias("full"), F.sum(F.when(~is_full, F.col("weight"))).alias("weight")).first()
        if r.weight is None or r.n == filled:
            return by.select("source", "source_size", F.when(is_full, F.col("full")).otherwise(F.col("weight") * level).alias("target"), "documents")
        level, filled = (total - (r.full or 0.0)) / r.weight, r.n


def _meet(one: Column, two: Column, seed: int) -> Column:
    """Round two fractional items against each other: the array of both, with at least one at 0 or 1."""

    def moved(x: Column, part: Column) -> Column:
        snapped = F.when(part < TINY, 0.0).when(part > 1 - TINY, 1.0).otherwise(part)
        return x.withField("part", snapped)

    def drawn(r: Column) -> Column:
        ratio = two["size"] / one["size"]  # parts of one that equal one part of two, in words
        up = F.least(1 - one["part"], two["part"] * ratio)
        down = F.least(one["part"], (1 - two["part"]) * ratio)
        return let(
            F.when(r * (up + down) < down, up).otherwise(-down),
            lambda step: F.array(moved(one, one["part"] + step), moved(two, two["part"] - step / ratio)),
        )

    return let(unit(one["h"], two["h"], F.lit(seed)), drawn)


def _fold(items: Column, seed: int) -> Column:
    """Run a sorted array of items through the pivot: ``done`` (at 0 or 1) and ``left`` (none or one)."""
    none = F.filter(items, lambda x: F.lit(False))

    def open_part(x: Column) -> Column:
        return (x["part"] > 0) & (x["part"] < 1)

    def step(state: Column, x: Column) -> Column:
        met = F.when(F.size(state["left"]) == 0, F.array(x)).otherwise(_meet(state["left"][0], x, seed))
        return let(met, lambda both: F.struct(F.concat(state["done"], F.filter(both, lambda v: ~open_part(v))).alias("done"), F.filter(both, open_part).alias("left")))

    return F.aggregate(items, F.struct(none.alias("done"), none.alias("left")), step)


def mix(rows: DataFrame, keys: list[str], weights: tuple[float, ...] = WEIGHTS, most: float = 3.0, seed: int = 8) -> DataFrame:
    """``keys, source, size, n, source_size, target, copies`` from ``keys, source, size``: one row per group of equal rows.

    ``copies`` is what the ``n`` rows of the group take together, between n * floor and n * ceil of their expectation.
    """
    rows = cut(rows.groupBy(*keys, "source", "size").agg(F.count("*").alias("n")))
    targets = cut(source_targets(rows, weights, most))
    items = rows.join(targets, rows.source.eqNullSafe(targets.source), "left").drop(targets.source)
    # so many levels that a block of the first one holds 1 to 2^FAN_BITS documents on average
    levels = F.greatest(F.lit(0), F.ceil(F.log2(F.col("documents") / float(1 << FAN_BITS)) / FAN_BITS)).cast("int")
    mass = F.when(F.col("size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most)) * F.col("n")).otherwise(0.0)
    items = items.withColumns({"levels": levels, "mass": mass, "h": F.shiftrightunsigned(F.xxhash64(*keys, "size", F.lit(seed)), 4)})
    items = items.withColumn("base", F.floor(F.col("mass") + TINY)).withColumn("part", F.greatest(F.col("mass") - F.col("base"), F.lit(0.0)))
    items = items.withColumn("part", F.when(F.col("part") < TINY, 0.0).otherwise(F.col("part")))
    # longest first, so that what is left at the end of a block is short
    item = F.struct((-F.col("size")).alias("longest"), "h", "size", *keys, "n", "base", "part")
    block = F.call_function("shiftrightunsigned", F.col("h"), F.lit(60) - FAN_BITS * F.col("levels"))
    depth = targets.agg(F.max(F.greatest(F.lit(0), F.ceil(F.log2(F.col("documents") / float(1 << FAN_BITS)) / FAN_BITS)))).first()[0]
    group = ["source", "source_size", "target", "levels"]
    settled = items.where("part = 0").select(*group, item.alias("x"))
    at = items.where("part > 0").select(*group, F.when(F.col("levels") == 0, 0).otherwise(block).alias("block"), item.alias("x"))
    out = [settled]
    for level in range(int(depth or 0) + 1):
        ran = at.groupBy(*group, "block").agg(_fold(F.array_sort(F.collect_list("x")), seed).alias("r"))
        ran = cut(ran)
        out.append(ran.select(*group, F.explode("r.done").alias("x")))
        left = ran.select(*group, "block", F.explode("r.left").alias("x"))
        last = left.where(F.col("levels") <= level)
        out.append(last.select(*group, F.col("x").withField("part", F.when(unit("x.h", F.lit(seed + 1)) < F.col("x.part"), 1.0).otherwise(0.0)).alias("x")))
        at = left.where(F.col("levels") > level).select(*group, F.shiftrightunsigned("block", FAN_BITS).alias("block"), "x")
    decided = reduce(DataFrame.unionByName, out)
    return decided.select(*(F.col(f"x.{k}").alias(k) for k in keys), "source", F.col("x.size").alias("size"), F.col("x.n").alias("n"), "source_size", "target", (F.col("x.base") + F.col("x.part").cast("long")).alias("copies"))


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mixture(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0, seed: int = 8, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and the copies taken."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"), words(docs[text_col]).alias("size"))
    each = times(mix(rows, ["doc_id"], weights, most, seed), "n", "nth")
    copies = F.floor(F.col("copies") / F.col("n")) + (F.col("nth") < F.col("copies") % F.col("n")).cast("long")
    return each.select("doc_id", "source", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0, seed: int = 8, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mixture, each as often as it is taken, with the columns of ``docs``.

    Documents are matched to their copies by a hash of the whole row; equal rows come once to the match.
    """
    columns = [f"c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*columns)
    col = {name: columns[i] for i, name in reversed(list(enumerate(docs.columns)))}
    keyed = renamed.withColumn("row_key", F.xxhash64(*columns)).withColumn("row_key2", F.xxhash64(F.lit(seed), *reversed(columns)))
    rows = keyed.select("row_key", "row_key2", F.col(col[source_col]).alias("source"), words(F.col(col[text_col])).alias("size"))
    taken = mix(rows, ["row_key", "row_key2"], weights, most, seed).where("copies > 0").select("row_key", "row_key2", "copies")
    kept = keyed.dropDuplicates(["row_key", "row_key2"]).join(taken, ["row_key", "row_key2"])
    return times(kept, "copies", "nth").select(*columns).toDF(*docs.columns)
