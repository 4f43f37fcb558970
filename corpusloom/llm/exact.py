"""Operator 13, exact dedup: a minimal perfect hash over the digests that were seen before.

The index of the past is a table with one row for each hash range of its distinct digests. A row holds the levels of a minimal perfect
hash, which gives each of its digests a slot of its own, and the slots: the full digest, and where the winner of that text is found. A batch is
reduced to its distinct digests, each is looked up in its range and compared with the digest in the slot, byte by byte. Members meet the winner of the past;
the others are groups of their own. So a text that a third of all rows hold is one row of an aggregation that starts before the shuffle, and one row of a lookup.

Digests are SHA-256 of the text without white space. The row with the most code points stays, then the one with the smallest id.

Defined cases: a null text is an empty one, and so equal to a text of white space only; null ids come after all others; of rows that agree in all of
this exactly one stays; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Scratch, cut, mix64

SPACES = " \t\n\x0b\x0c\r"
RANGE = 1 << 10  # digests of a hash range, about
ROOM = 1.5  # places for each digest on a level
HEAVY = 1000  # digests that hold more than this part of all rows are dealt in parts
COPIES = 64

SLOTS = "doc_id long, points long, locator long, rows long"
INDEX = "bucket int, sizes array<long>, bits binary, digests binary, doc_id array<long>, points array<long>, locator array<long>, rows array<long>"
DECISIONS = "digest binary, in_history boolean, " + SLOTS


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    h = mix64(keys[:, 0] + np.uint64(level))
    for k in (1, 2, 3):
        h = mix64(h ^ keys[:, k])
    return (h % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Levels of bits; a key's slot is the rank of the first bit it meets that is set. Keys are rows of four 64-bit numbers."""

    def __init__(self, sizes: list[int], bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits
        self.ranks = np.concatenate([[0], np.cumsum(bits)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct keys: those alone at their place on a level stay there, the others go to the next."""
        sizes, levels = [], []
        while len(keys):
            size = max(8, int(ROOM * len(keys)))
            at = _places(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has it; a key that is not of the set may get any slot."""
        out, base = np.full(len(keys), -1), 0
        live = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = base + _places(keys[live], level, size)
            hit = self.bits[at]
            out[live[hit]] = self.ranks[at[hit]]
            live, base = live[~hit], base + size
        return out


def _keys(digests: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), np.uint64).reshape(-1, 4)


def digests(docs: DataFrame, locator: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, points, locator``: one narrow pass; the locator is a number of the row's own."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    plain = text
    for c in SPACES:
        plain = F.replace(plain, F.lit(c), F.lit(""))
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.unhex(F.sha2(plain, 256)).alias("digest"), F.length(text).cast("long").alias("points"), locator.alias("locator"))


def winners(rows: DataFrame, *keys: str) -> DataFrame:
    """For each digest the row that stays and the count of all; combined in the tasks before the shuffle."""
    best = F.min(F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator"))
    found = rows.groupBy("digest", *keys).agg(best.alias("best"), F.count("*").alias("rows"))
    return found.select("digest", *keys, "best.doc_id", (-F.col("best.less")).alias("points"), "best.locator", "rows")


def _bucket(ranges: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(ranges)).cast("int")


def index_of(history: DataFrame, ranges: int) -> DataFrame:
    """The index of the past: one row for each of ``ranges`` hash ranges of ``history``, a table of winners."""

    def build(part: pa.Table) -> pa.Table:
        keys = _keys(part["digest"])
        perfect = PerfectHash.build(keys)
        order = pa.array(np.argsort(perfect.slots(keys)))
        part = part.take(order)
        lists = [pa.array([part[c].to_pylist()], pa.list_(pa.int64())) for c in ("doc_id", "points", "locator", "rows")]
        head = [pa.array([part["bucket"][0].as_py()], pa.int32()), pa.array([perfect.sizes], pa.list_(pa.int64())), pa.array([np.packbits(perfect.bits).tobytes()], pa.binary()), pa.array([b"".join(part["digest"].to_pylist())], pa.binary())]
        return pa.Table.from_arrays([*head, *lists], ["bucket", "sizes", "bits", "digests", "doc_id", "points", "locator", "rows"])

    return history.select(_bucket(ranges).alias("bucket"), "digest", "doc_id", "points", "locator", "rows").groupBy("bucket").applyInArrow(build, INDEX)


def decide(batch: DataFrame, index: DataFrame, ranges: int) -> DataFrame:
    """One row for each digest of the past or of ``batch``, a table of winners: who stays, and how many rows have that text.

    A digest of the batch is a member if its slot holds the same 32 bytes; then the better of both rows stays. Others come as they are.
    """
    names = ("doc_id", "points", "locator", "rows")

    def lookup(new: pa.Table, past: pa.Table) -> pa.Table:
        keys = _keys(new["digest"])
        own = list(zip(*(new[c].to_pylist() for c in names), strict=True))
        slots, known, held = [-1] * len(own), [], []
        if past.num_rows:
            at = past.to_pylist()[0]
            sizes = at["sizes"]
            perfect = PerfectHash(sizes, np.unpackbits(np.frombuffer(at["bits"], np.uint8), count=sum(sizes)).astype(bool))
            stored = np.frombuffer(at["digests"], np.uint64).reshape(-1, 4)
            slot = perfect.slots(keys)
            member = slot >= 0
            member[member] = (stored[slot[member]] == keys[member]).all(axis=1)
            slots = np.where(member, slot, -1).tolist()
            known = [at["digests"][k : k + 32] for k in range(0, len(at["digests"]), 32)]
            held = list(zip(*(at[c] for c in names), strict=True))
        rows = [(d, True, *h) for d, h in zip(known, held, strict=True)]
        for k, digest, row in zip(slots, new["digest"].to_pylist(), own, strict=True):
            if k < 0:
                rows.append((digest, False, *row))
            else:
                best = min(rows[k][2:5], row[:3], key=lambda r: (-r[1], r[0] is None, r[0] or 0, r[2]))
                rows[k] = (digest, True, *best, rows[k][5] + row[3])
        kinds = [pa.binary(), pa.bool_(), *[pa.int64()] * 4]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], ["digest", "in_history", *names])

    new = batch.select(_bucket(ranges).alias("bucket"), "digest", *names)
    return new.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(lookup, DECISIONS)


def _decided(rows: DataFrame, past: Column) -> DataFrame:
    """``rows`` with who stays of their text, how many have it, and whether the row itself stays.

    Only texts of several rows are sent to the rows. Those of more than a thousandth of all rows, fewer than a thousand, are broadcast by digest
    and met in parts.
    """
    groups = cut(winners(rows.withColumn("past", F.coalesce(past, F.lit(False))), "past"))
    sums = groups.agg(F.count_if("past").alias("n"), F.sum("rows").alias("rows")).first()
    ranges, most = -(-sums.n // RANGE) or 1, max(HEAVY, (sums.rows or 0) // HEAVY)
    scratch = Scratch(rows.sparkSession)
    index = scratch.table(index_of(groups.where("past"), ranges))
    made = cut(decide(groups.where("not past"), index, ranges).where("rows > 1").select("digest", F.col("doc_id").alias("keep_id"), F.col("locator").alias("winner"), F.col("rows").alias("group_size")))
    scratch.clear()
    heavy = F.broadcast(made.where(F.col("group_size") > most).select("digest", F.lit(True).alias("heavy")))
    part = F.when(F.col("heavy"), F.pmod(F.xxhash64("locator"), F.lit(COPIES)).cast("int")).otherwise(0)
    dealt = rows.join(heavy, "digest", "left").withColumn("part", part).drop("heavy")
    parts = F.when(F.col("group_size") > most, F.sequence(F.lit(0), F.lit(COPIES - 1))).otherwise(F.array(F.lit(0)))
    met = dealt.join(made.withColumn("part", F.explode(parts)), ["digest", "part"], "left")
    alone = F.col("group_size").isNull()
    return met.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), (alone | (F.col("winner") == F.col("locator"))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "locator")


def half(doc_id: Column) -> Column:
    """The half of a table that stands for the past where there is no other: by a hash of the id."""
    return F.pmod(F.xxhash64(doc_id), F.lit(2)) == 0


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for each document: half of them are the past, the others the batch."""
    rows = cut(digests(docs, F.monotonically_increasing_id(), id_col, text_col))
    return _decided(rows, half(F.col("doc_id"))).drop("locator")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text, columns as they were. Documents are written once, so that their rows keep their numbers."""
    number = "row_number_"
    while number in docs.columns:
        number += "_"
    held = Scratch(docs.sparkSession).table(docs.withColumn(number, F.monotonically_increasing_id()))
    rows = cut(digests(held, held[number], id_col, text_col))
    gone = _decided(rows, half(F.col("doc_id"))).where("not kept").select(F.col("locator").alias(number))
    return held.join(gone, number, "left_anti").select(*docs.columns)
