"""Operator 10, sharding: jump consistent hashing of stable keys.

A row's shard follows from its key and the number of shards alone, so no ring table is kept, and
with one more shard only about 1/(n+1) of the rows move, all of them into the new shard.

Defined cases: a null id has the key ``NO_ID``, so that all rows without one share a shard; a null text has size 1 and the checksum of
an empty one; rows that are equal in id, size and checksum take consecutive slots; an
empty table gives an empty manifest; columns other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, times


NO_ID = -1  # the key of a null id


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key, all keys advanced together."""
    out = np.zeros(len(keys), np.int64)
    live, state = np.arange(len(keys)), keys.astype(np.uint64)
    at = np.zeros(len(keys), np.int64)
    while len(live):
        out[live] = at
        state = state * np.uint64(2862933555777941757) + np.uint64(1)
        at = ((at + 1).astype(np.float64) * (float(1 << 31) / ((state >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        stay = at < shards
        live, state, at = live[stay], state[stay], at[stay]
    return out


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a long key as a column, in Arrow batches."""

    @F.pandas_udf("int")
    def assign(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards), dtype="int32")

    return assign(key)


def with_shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", name: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row; one narrow pass, no shuffle."""
    return docs.withColumn(name, shard_of(_key(docs[id_col]), shards))


def _crc(docs: DataFrame, text_col: str) -> Column:
    return F.crc32(F.coalesce(docs[text_col], F.lit("")).cast("binary"))


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def shard_manifest(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", buckets: int = 4096) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    Slots count from 0 without gaps in each shard. They are numbered in ``buckets`` parts of each
    shard, each part after the rows of the parts before it, so that no task sorts a whole shard; equal
    rows are counted before the shuffle and numbered as one. The table of parts has at most ``shards * buckets``
    rows and is broadcast.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), (F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("long") + 1).alias("size"), _crc(docs, text_col).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    key = _key(F.col("doc_id"))
    rows = rows.select("*", shard_of(key, shards).alias("shard"), shard_of(key, shards + 1).alias("grown_shard"), F.pmod(F.coalesce("doc_id", F.lit(0)).bitwiseXOR(F.col("text_crc32")), F.lit(buckets)).alias("part"))
    rows = cut(rows)
    parts = rows.groupBy("shard", "part").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "part").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("above", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    rows = rows.join(F.broadcast(parts), ["shard", "part"])
    rows = times(rows, "n", "nth")
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("above") + F.col("nth")).alias("slot"), "grown_shard")
