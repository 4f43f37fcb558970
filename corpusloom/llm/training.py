"""Bounded samples of labelled documents, drawn by hash, and models fitted to them in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import held_out


def drawn(rows: DataFrame, id_col: str, most: int, seed: int) -> DataFrame:
    """At most ``most`` distinct ids, those with the smallest hashes.

    Only ids under a bound of the hash are made distinct and ordered. The bound fits unique ids, and rises where
    repeated ones leave too few.
    """
    ids = rows.select(F.col(id_col).alias("drawn_id")).where("drawn_id is not null")
    hashed = F.xxhash64("drawn_id", F.lit(seed))
    share = 4 * most / max(1, ids.count())
    while share < 1 and ids.where(hashed < _bound(share)).distinct().count() < most:
        share *= 8
    low = ids.where(hashed < _bound(share)) if share < 1 else ids
    return low.distinct().orderBy(hashed, "drawn_id").limit(most)


def _bound(share: float) -> int:
    """The hash below which a share of all hashes lies."""
    return int(share * 2**64) - 2**63


def training_ids(rows: DataFrame, id_col: str, keep: Column, most: int, seed: int) -> DataFrame:
    """Ids outside the held-out fold that satisfy ``keep``."""
    return drawn(rows.where(keep & ~held_out(F.col(id_col))), id_col, most, seed)


def texts_of(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The texts of a bounded set of ids, whole, one for each id: of several, the one with the smallest hash."""
    own = docs.select(docs[id_col].alias("drawn_id"), docs[text_col].cast("string").alias("text")).where("drawn_id is not null and text is not null")
    own = own.join(F.broadcast(ids.select("drawn_id")), "drawn_id", "left_semi")
    one = own.groupBy("drawn_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return one.join(F.broadcast(ids), "drawn_id")


def fitted(examples: DataFrame, fit: Callable[[pa.Table], object]) -> object | None:
    """What ``fit`` makes of the bounded examples, in the order of their ids, in one task; their texts never reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(pa.Table.from_batches(found).sort_by("drawn_id")))], pa.binary())], ["model"])

    made = examples.repartition(1).mapInArrow(run, "model binary").first()
    return None if made is None else pickle.loads(made.model)
