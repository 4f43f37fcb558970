"""Documents in compressed blocks, and tallies of the hashes that the blocks hold.

A tally counts hashes over the whole corpus and brings each count back to the blocks that sent the hash, so that later
passes know what is rare without a table of counts in any one place. Each block sends its distinct hashes by hash range, packed in bytes; the
number of ranges grows with the number of hashes, so that a range keeps its size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import pieces, sort_places, text_buffer

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 1 << 16
ROW_BITS = 17  # of a row within its block
RANGE_HASHES = 1 << 20  # hashes of one range, about
PRINT = 5  # bytes of a hash that are sent besides those that its range tells
EXACT = 64  # counts are exact up to this, and in eighths of an octave beyond

LAYOUT = "block long, ids binary, known binary, keys binary, offsets binary, sizes binary, bytes long, text binary"


class Block:
    """A block as arrays: bytes, offsets of the texts, and id, whether it is known, key and place in its document of each."""

    def __init__(self, row: dict) -> None:
        text = zstandard.ZstdDecompressor().decompress(row["text"], max_output_size=row["bytes"]) if row["bytes"] else b""
        self.number = row["block"]
        self.data = np.frombuffer(text, np.uint8)
        self.at = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], np.int64))])
        self.ids, self.keys, self.offsets = (np.frombuffer(row[k], np.int64) for k in ("ids", "keys", "offsets"))
        self.known = np.frombuffer(row["known"], bool)


def buckets_of(rows: DataFrame, text_col: str) -> tuple[int, int]:
    """How many buckets a table of blocks of these texts gets, about 16 MB of text each, and the bytes of all texts.

    With fewer buckets than partitions of a shuffle, a join would shuffle the table.
    """
    total = rows.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(32768, -(-total // (16 << 20)))), total


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


_SQUEEZE, _EXPAND = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def squeezed(values: np.ndarray | bytes) -> bytes:
    return _SQUEEZE.compress(values if isinstance(values, bytes) else values.tobytes())


def expanded(raw: bytes, dtype) -> np.ndarray:
    return np.frombuffer(_EXPAND.decompress(raw), dtype)


def pack(rows: DataFrame, facts: Callable[[np.ndarray, np.ndarray], list[np.ndarray]] | None = None, names: tuple[str, ...] = (), part: int | None = None, overlap: int = 0, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of about ``block_bytes`` of ``doc_id, key, text``, and the arrays of ``facts`` about their texts.

    With ``part``, longer texts come as several rows, each with the ``overlap`` bytes that follow it; they share a key of
    their own, which takes the place of the given one, and other texts have the key -1.
    """

    def units(batches: Iterator[pa.RecordBatch]):
        """Pieces of rows: ids, known, keys, offsets, bytes, sizes."""
        nth = TaskContext.get().partitionId() << 37
        for batch in pieces(batches, "text", BLOCK_BYTES // 2):
            data, at = text_buffer(batch.column(2))
            ids, known = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            size = batch.num_rows
            keys = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64) if part is None else np.full(size, -1)
            nth += size
            if part is None or size > 1 or len(data) <= part + overlap:
                yield ids, known, keys, np.zeros(size, np.int64), data, np.diff(at)
                continue
            for lo in range(0, len(data) - overlap, part):
                piece = data[lo : lo + part + overlap]
                yield ids, known, np.array([nth]), np.array([lo]), piece, np.array([len(piece)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 20, [], 0

        def emit() -> pa.RecordBatch:
            ids, known, keys, offsets, data, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
            more = facts(data, np.concatenate([[0], np.cumsum(sizes)])) if facts is not None else []
            values = [number, ids.tobytes(), known.tobytes(), keys.tobytes(), offsets.tobytes(), sizes.astype(np.int64).tobytes(), len(data), squeezed(data), *(m.tobytes() for m in more)]
            kinds = [pa.int64(), *[pa.binary()] * 5, pa.int64(), *[pa.binary()] * (1 + len(more))]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [x.split()[0] for x in schema.split(", ")])

        for unit in units(batches):
            held.append(unit)
            size += len(unit[4])
            if size >= block_bytes - BLOCK_BYTES // 2 or sum(len(u[0]) for u in held) >= BLOCK_ROWS:
                yield emit()
                held, size, number = [], 0, number + 1
        if held:
            yield emit()

    schema = ", ".join([LAYOUT, *(f"{n} binary" for n in names)])
    return rows.select("doc_id", "key", "text").mapInArrow(run, schema)


def level(count: np.ndarray) -> np.ndarray:
    """A count in one byte; larger counts never have smaller levels."""
    high = EXACT + np.floor(8 * np.log2(np.maximum(count, EXACT) / EXACT))
    return np.where(count <= EXACT, count, np.minimum(high, 255)).astype(np.uint8)


#: The least count of each level.
COUNTS = np.where(np.arange(256) <= EXACT, np.arange(256), EXACT * 2.0 ** ((np.arange(256) - EXACT) / 8))


def range_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def range_bits(items: int, each: int = RANGE_HASHES) -> int:
    return max(0, -(-items // each) - 1).bit_length()


def tally(blocks: DataFrame, hashes: Callable[[dict], tuple[np.ndarray, np.ndarray]], bits: int) -> DataFrame:
    """``block, levels``: for each block the levels of the corpus-wide counts of its hashes, by range.

    ``hashes`` gives the sorted distinct hashes of a block and how often each counts.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            values, counts = hashes(row)
            bucket = range_of(values, bits)
            heads = np.flatnonzero(np.diff(bucket, prepend=-1))
            if not len(heads):
                continue
            raw = ((values << np.uint64(bits)) >> np.uint64(64 - 8 * PRINT)).view(np.uint8).reshape(-1, 8)[:, :PRINT]
            counts = np.minimum(counts, 65535).astype(np.uint16)
            spans = list(zip(heads.tolist(), [*heads[1:].tolist(), len(values)], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[heads]), pa.array(np.full(len(heads), row["block"])), pa.array([raw[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([squeezed(counts[a:b]) for a, b in spans], pa.binary())], ["bucket", "block", "prints", "counts"])

    def count(table: pa.Table) -> pa.Table:
        prints = []
        for raw in table["prints"].to_pylist():
            wide = np.zeros((len(raw) // PRINT, 8), np.uint8)
            wide[:, :PRINT] = np.frombuffer(raw, np.uint8).reshape(-1, PRINT)
            prints.append(wide.view(np.uint64).ravel())
        counts = np.concatenate([expanded(c, np.uint16) for c in table["counts"].to_pylist()])
        every, order = sort_places(np.concatenate(prints), 8 * PRINT)
        heads = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        found = np.empty(len(order), np.uint8)
        found[order] = np.repeat(level(np.add.reduceat(counts[order].astype(np.int64), heads)), np.diff(np.append(heads, len(order))))
        ends = np.cumsum([len(p) for p in prints])
        out = [squeezed(found[e - len(p) : e]) for p, e in zip(prints, ends, strict=True)]
        return pa.table({"block": table["block"], "bucket": table["bucket"], "levels": pa.array(out, pa.binary())})

    sent = blocks.mapInArrow(send, "bucket long, block long, prints binary, counts binary")
    back = sent.groupBy("bucket").applyInArrow(count, "block long, bucket long, levels binary")
    return back.groupBy("block").agg(F.collect_list(F.struct("bucket", "levels")).alias("levels"))


def levels_of(row: dict) -> np.ndarray:
    """The levels of a block's hashes, in the order of the hashes."""
    parts = [expanded(x["levels"], np.uint8) for x in sorted(row["levels"] or [], key=lambda x: x["bucket"])]
    return np.concatenate([*parts, np.zeros(0, np.uint8)])
