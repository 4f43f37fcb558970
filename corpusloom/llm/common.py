"""What the operators of this subpackage share: tables, checkpoints, Arrow text buffers and components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
MOST_ROWS = 1 << 16  # of a piece of a batch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there.

    The folder is the one the session names in ``spark.checkpoint.dir``. Where none is named, a local
    one is made for a local master only: executors of a cluster could not read it.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint()


class Scratch:
    """Tables in the shared checkpoint folder, for rows that pack better in columns than in a checkpoint."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths, self.names = spark, [], []

    def _path(self) -> str:
        sc = self.spark.sparkContext
        if sc.getCheckpointDir() is None:
            cut(self.spark.range(1))
        self.paths.append(f"{sc.getCheckpointDir()}/table-{uuid.uuid4().hex}")
        return self.paths[-1]

    def table(self, df: DataFrame) -> DataFrame:
        path = self._path()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, buckets: int, column: str) -> DataFrame:
        """A table in buckets of a column, which joins on that column without another shuffle."""
        name = f"scratch_{uuid.uuid4().hex}"
        df.write.option("path", self._path()).bucketBy(buckets, column).saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def clear(self, keep: DataFrame | None = None) -> None:
        """Remove the tables, but for ``keep``, once nothing reads them any more."""
        kept = {p.rpartition("/")[0] for p in keep.inputFiles()} if keep is not None else set()
        jvm = self.spark._jvm
        for path in self.paths:
            if not any(k.endswith(path.rpartition("/")[2]) for k in kept):
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        for name in self.names:
            self.spark.sql(f"drop table if exists {name}")
        self.paths, self.names = [], []


def let(value: Column, body) -> Column:
    """Bind ``value`` once inside an expression."""
    return F.transform(F.array(value), body)[0]


def times(rows: DataFrame, count: str, nth: str, most: int = 1 << 12) -> DataFrame:
    """Each row ``count`` times, numbered from 0 in the column ``nth``; in ranges, so that no list is longer than ``most``."""
    zero, last = F.lit(0).cast("long"), F.col(count) - 1
    ranges = rows.where(F.col(count) > 0).withColumn("first_", F.explode(F.sequence(zero, last, F.lit(most).cast("long"))))
    return ranges.withColumn(nth, F.explode(F.sequence("first_", F.least(F.col("first_") + (most - 1), last)))).drop("first_")


def heavy_join(rows: DataFrame, others: DataFrame, key: str, salt: Column, most: int, how: str = "inner", copies: int = 64) -> DataFrame:
    """Join ``rows`` to ``others`` (one row for each key) where some keys may hold a great part of ``rows``.

    Keys of more than ``most`` rows are dealt over ``copies`` parts by ``salt``, which must not change from run to run, and their
    other rows are copied to each part. Only those keys are broadcast: there are fewer than the count of rows divided by ``most``.
    """
    heavy = F.broadcast(rows.groupBy(key).agg(F.count("*").alias("n_")).where(F.col("n_") > most).select(key, F.lit(True).alias("heavy_")))
    part, parts = F.pmod(salt, F.lit(copies)).cast("int"), F.sequence(F.lit(0), F.lit(copies - 1))
    dealt = rows.withColumn("part_", part).join(heavy, key, "left").withColumn("part_", F.when(F.col("heavy_"), F.col("part_")).otherwise(0)).drop("heavy_")
    copied = others.join(heavy, key, "left").withColumn("part_", F.explode(F.when(F.col("heavy_"), parts).otherwise(F.array(F.lit(0))))).drop("heavy_")
    return dealt.join(copied, [key, "part_"], how).drop("part_")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the row stays out of training: crc32 of the id as text divides by ``folds``. Null ids train."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and the offsets of its values; nulls count as empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.null_count:  # a null may still span bytes
        sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(at), 0)
        if (sizes != np.diff(at)).any():
            return text_buffer(column.fill_null(""))
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``most`` bytes of text, or one row."""
    for batch in batches:
        _, at = text_buffer(batch.column(column))
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
            stop = min(stop, row + MOST_ROWS)
            yield batch.slice(row, stop - row)
            row = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift, multiply, shift), in place where possible."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def sort_places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of so many bits (none negative) in order, and their places; equal ones stay in order.

    Where key and place fit into a word, words are sorted, which takes a fraction of the time.
    """
    shift = len(keys).bit_length()
    if bits + shift > 64:
        order = np.argsort(keys, kind="stable")
        return keys[order].astype(np.uint64), order
    words = keys.astype(np.uint64) << np.uint64(shift)
    words |= np.arange(len(keys), dtype=np.uint64)
    words.sort()
    order = (words & np.uint64((1 << shift) - 1)).astype(np.int64)
    words >>= np.uint64(shift)
    return words, order


BASE = 0x9E3779B97F4A7C15  # of running polynomial sums; odd
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base modulo 2^64, and those of its inverse."""
    if len(_POWERS[0]) < n:
        for k, x in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(1 << (n - 1).bit_length(), x, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of an integer array, from one running polynomial sum."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] ^ (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the row it stands in. No word crosses from one row to the next."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    word = ~space
    begin = word.copy()
    begin[1:] &= space[:-1] | edge[1:-1]
    end = word
    end[:-1] &= space[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    rows = np.searchsorted(at, starts, "right") - 1
    return starts, ends, rows


def connected_components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is its smallest node.

    Each round lets every node adopt the smallest label among its neighbours' labels and then the
    label of its label, so that paths halve. State is one row per node and one per edge, checkpointed each
    round; only a count of changes reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    both = cut(both)
    label = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("l")).select(F.col("a").alias("node"), "l"))
    for _ in range(rounds):
        near = both.join(label, both.b == label.node).groupBy("a").agg(F.min("l").alias("m"))
        low = label.join(near, label.node == near.a, "left").select("node", F.col("l").alias("old"), F.least("l", F.coalesce("m", "l")).alias("low"))
        # hooks: the old label's node also learns of the smaller label
        hook = low.where("low < old").groupBy(F.col("old").alias("hooked")).agg(F.min("low").alias("h"))
        low = cut(low.join(hook, low.node == hook.hooked, "left").select("node", "old", F.least("low", F.coalesce("h", "low")).alias("low")))
        up = low.select(F.col("node").alias("parent"), F.col("low").alias("grand"))
        new = cut(low.join(up, low.low == up.parent, "left").select("node", "old", F.least("low", F.coalesce("grand", "low")).alias("l")))
        if new.where("l < old").isEmpty():
            return new.select("node", F.col("l").alias("component"))
        label = new.select("node", "l")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
