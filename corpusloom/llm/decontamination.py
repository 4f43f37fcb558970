"""Operator 1, benchmark decontamination: q-gram lemma filtering with banded verification.

Texts are compared as folded bytes: small letters, one space for any run of what is no letter or digit. A benchmark
item is covered by windows of ``WINDOW`` bytes, half overlapping, the last one at its end (a shorter item is one window). A document leaks
a window when a stretch of it is within k edits of it, k = floor(RATE * length), but at most length // Q - 1. Such a stretch shares at least
length - Q + 1 - k * Q of the window's q-grams with it (one or more, by that limit of k, which holds for lengths of 34 and 35 only), on diagonals at most 2k apart. So q-grams are counted in bands of 2 * BAND diagonals
that overlap by half, bands below the bound are dropped, and what remains is aligned in its band.

The distinct texts of the benchmark are read in blocks of about ``block_bytes``; each block's q-gram index is broadcast and the documents
pass it once, in one narrow stage. A benchmark of any size so needs a bounded index per pass.

Items of ``Q`` to 23 folded bytes have no edits to spare, so the same count asks for all of their q-grams; what is found must also begin and end with
a word, so that no part of a longer word counts. A shorter item, a word or two that any text may hold, leaks only into a document that is nothing else.

Defined cases: null and empty texts, and items without a letter or digit, leak nothing; a null item id is reported as null; equal items are reported each; repeated documents each get their rows; an empty
benchmark or table gives an empty result; other columns are kept by ``without_leaks`` and not read by ``leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, mix64, pieces, text_buffer
from corpusloom.llm.grams import FOLDED

Q = 12
WINDOW = 72
RATE = 0.06
BAND = 16
WORDS = 24  # folded bytes below which a match begins and ends with a word
PART = 2 << 20
PARTS = 16  # of the rows found with one text
CHAINED = 4  # passes, each with an index and a worker of its own, in one stage


def fold(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes of all rows, their offsets, and which input bytes were kept."""
    low = FOLDED[data]
    low[low == 48] = data[low == 48]  # digits stay apart
    if len(low) > 1:  # capitals of Latin-1 in UTF-8
        capital = np.zeros(len(low), bool)
        capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        low[capital] += 0x20
    space = low == 32
    keep = ~space
    if len(low):
        keep[1:] |= ~space[:-1]
        starts = at[:-1][np.diff(at) > 0]
        keep[starts] = ~space[starts]
    total = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])
    return low[keep], total[at], keep


def budget(size: np.ndarray) -> np.ndarray:
    """The edits that a window of a size may differ by; its q-gram bound stays at one or more."""
    return np.minimum((RATE * size).astype(np.int64), size // Q - 1)


def gram_keys(text: np.ndarray) -> np.ndarray:
    """A 64-bit key of the 12 bytes at each position."""
    if len(text) < Q:
        return np.zeros(0, np.uint64)
    two = (text[:-1].astype(np.uint32) << 8) | text[1:]
    four = (two[:-2] << np.uint32(16)) | two[2:]
    n = len(text) - Q + 1
    eight = (four[:n].astype(np.uint64) << np.uint64(32)) | four[4 : 4 + n]
    eight *= np.uint64(0x9E3779B97F4A7C15)
    eight ^= four[8 : 8 + n]
    eight *= np.uint64(0xD6E8FEB86659FD93)
    return eight


@dataclass
class Index:
    """The q-grams of a block of the benchmark and its windows."""

    items: np.ndarray  # number of the item of each window
    text: np.ndarray
    begins: np.ndarray  # of windows in the text
    sizes: np.ndarray
    keys: np.ndarray  # sorted
    places: np.ndarray  # of the keys in the text
    seen: np.ndarray  # which key hashes occur
    shift: np.uint64
    whole: dict[bytes, list[int]]  # items of fewer than Q bytes, by what they are

    @classmethod
    def of(cls, texts: list[str | None]) -> Index:
        data, at = text_buffer(pa.array([t or "" for t in texts], pa.large_string()))
        text, at, _ = fold(data, at)
        items, begins, sizes, keys, places, whole = [], [], [], [], [], {}
        for i in range(len(texts)):
            lo, hi = int(at[i]), int(at[i + 1])
            if hi - lo < Q:
                if word := text[lo:hi].tobytes().strip():
                    whole.setdefault(word, []).append(i)
                continue
            first = list(range(lo, hi - WINDOW, WINDOW // 2)) + [max(lo, hi - WINDOW)]
            items += [i] * len(first)
            begins += first
            sizes += [min(WINDOW, hi - lo)] * len(first)
            keys.append(gram_keys(text[lo:hi]))
            places.append(np.arange(lo, hi - Q + 1))
        keys, places = np.concatenate([*keys, np.zeros(0, np.uint64)]).astype(np.uint64), np.concatenate([*places, np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        bits = int(np.clip(np.ceil(np.log2(32 * max(1, len(keys)))), 16, 24))
        seen = np.zeros(1 << bits, bool)
        seen[mix64(keys) >> np.uint64(64 - bits)] = True
        return cls(np.array(items, np.int64), text, np.array(begins, np.int64), np.array(sizes, np.int64), keys[order], places[order], seen, np.uint64(64 - bits), whole)

    def hits(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``text`` and in the benchmark that share a q-gram."""
        keys = gram_keys(text)
        at = np.flatnonzero(self.seen[mix64(keys) >> self.shift])
        lo, hi = np.searchsorted(self.keys, keys[at], "left"), np.searchsorted(self.keys, keys[at], "right")
        n = hi - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.places[np.repeat(lo, n) + nth]

    def search(self, text: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Row, window, begin and end in ``text``, and edits, of each verified window of each row."""
        if len(self.begins) == 0 or len(text) < Q:
            return []
        spot, place = self.hits(text)
        row = np.searchsorted(at, spot, "right") - 1
        own = spot + Q <= at[row + 1]
        spot, place, row = spot[own], place[own], row[own]
        if not len(spot):
            return []
        # a place lies in a short run of windows: those that begin at most WINDOW - Q before it
        first, last = np.searchsorted(self.begins, place - (WINDOW - Q), "left"), np.searchsorted(self.begins, place, "right")
        n = last - first
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        window = np.repeat(first, n) + nth
        spot, place, row = np.repeat(spot, n), np.repeat(place, n), np.repeat(row, n)
        inside = place + Q <= self.begins[window] + self.sizes[window]
        window, spot, place, row = window[inside], spot[inside], place[inside], row[inside]
        offset = place - self.begins[window]
        diagonal = spot - at[row] - offset + WINDOW  # not negative
        found = []
        band = np.concatenate([diagonal // BAND, np.maximum(diagonal // BAND - 1, 0)])
        row, window, offset = np.tile(row, 2), np.tile(window, 2), np.tile(offset, 2)
        order = np.lexsort((offset, band, window, row))
        row, window, band, offset = row[order], window[order], band[order], offset[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (window[1:] != window[:-1]) | (band[1:] != band[:-1])
        fresh = new.copy()
        fresh[1:] |= offset[1:] != offset[:-1]
        heads = np.flatnonzero(new)
        shared = np.add.reduceat(fresh.astype(np.int64), heads)
        size = self.sizes[window[heads]]
        heads = heads[shared >= size - Q + 1 - budget(size) * Q]
        for lo in range(0, len(heads), 2048):
            h = heads[lo : lo + 2048]
            found += self._align(text, at, row[h], window[h], band[h] * BAND - WINDOW)
        return found

    def _align(self, text: np.ndarray, at: np.ndarray, row: np.ndarray, window: np.ndarray, diagonal: np.ndarray) -> list:
        """Edit distance of each window to the best stretch of its band; both ends of the stretch are free."""
        width = 2 * BAND + Q
        column = np.arange(width)
        size = self.sizes[window]
        cost = np.zeros((len(row), width))
        for i in range(int(size.max(initial=0))):
            spot = at[row][:, None] + diagonal[:, None] - Q // 2 + i + column
            real = (spot >= at[row][:, None]) & (spot < at[row + 1][:, None])
            same = real & (text[np.clip(spot, 0, len(text) - 1)] == self.text[np.minimum(self.begins[window] + i, len(self.text) - 1)][:, None])
            step = cost + ~same
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
            step = np.minimum.accumulate(step - column, axis=1) + column
            cost = np.where((i < size)[:, None], step, cost)
        edits = cost.min(axis=1).astype(np.int64)
        end = at[row] + diagonal - Q // 2 + size + cost.argmin(axis=1)
        good = edits <= budget(size)
        short = np.flatnonzero(good & (size < WORDS))
        for r in short.tolist():  # of the ends of exact matches, those between words
            begin, stop = int(at[row[r]]), int(at[row[r] + 1])
            ends = int(end[r]) - int(cost[r].argmin()) + np.flatnonzero(cost[r] == 0)
            starts = ends - size[r]
            item = self.text[self.begins[window[r]] : self.begins[window[r]] + size[r]]
            free = [e for s, e in zip(starts.tolist(), ends.tolist(), strict=True) if (s <= begin or 32 in (text[s - 1], item[0])) and (e >= stop or 32 in (text[e], item[-1]))]
            good[r] = bool(free)
            end[r] = free[0] if free else end[r]
        return [(int(r), int(w), int(max(e - s, a)), int(min(e, z)), int(d)) for r, w, e, s, d, a, z in zip(row[good], window[good], end[good], size[good], edits[good], at[row][good], at[row + 1][good], strict=True)]


def regions(index: Index, data: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """Row, item, begin and end in code points, fewest edits and number of windows, for each row and item that leak."""
    text, offsets, keep = fold(data, at)
    found = []
    if len(at) == 2 and len(text) > PART:  # one long text: parts that overlap by more than a window can take
        step = PART - 2 * (WINDOW + 2 * BAND + Q)
        for lo in range(0, len(text), step):
            hi = min(len(text), lo + PART)
            found += [(r, w, b + lo, e + lo, d) for r, w, b, e, d in index.search(text[lo:hi], np.array([0, hi - lo]))]
    else:
        found = index.search(text, offsets)
    alone = _alone(index, text, offsets)
    if not found and not alone:
        return []
    origin = np.flatnonzero(keep)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    by: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
    for r, w, b, e, d in found:
        begin, end = int(origin[b]), int(origin[e - 1]) + 1 if e > b else int(origin[b])
        by.setdefault((r, int(index.items[w])), []).append((int(points[begin] - points[at[r]]), int(points[end] - points[at[r]]), d, w))
    for r, i, b, e in alone:
        by[r, i] = [(int(points[origin[b]] - points[at[r]]), int(points[origin[e - 1] + 1] - points[at[r]]), 0, -1)]
    return [(r, i, min(x[0] for x in v), max(x[1] for x in v), min(x[2] for x in v), len({x[3] for x in v})) for (r, i), v in sorted(by.items())]


def _alone(index: Index, text: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Row, item, begin and end of each row that is one of the items without a q-gram and nothing else."""
    found = []
    for r in np.flatnonzero(np.diff(at) <= Q + 1) if index.whole else ():
        row = text[at[r] : at[r + 1]].tobytes()
        word, lead = row.strip(), int(at[r]) + len(row) - len(row.lstrip())
        found += [(int(r), i, lead, lead + len(word)) for i in index.whole.get(word, ())]
    return found


def blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list[str], Index]]:
    """Keys and index of each block of the distinct texts of the benchmark; a block comes to the driver alone."""
    texts = items.select("item_key", "text").dropDuplicates(["item_key"])
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        rows = sorted(texts.where(F.pmod(F.xxhash64("item_key"), F.lit(n)) == k).collect())
        yield [r.item_key for r in rows], Index.of([r.text for r in rows])


def keyed(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, item_key, text`` of the items with a text; equal texts have equal keys."""
    text = benchmark[text_col].cast("string")
    return benchmark.select(benchmark[id_col].alias("item_id"), F.sha2(text.cast("binary"), 256).alias("item_key"), text.alias("text")).where("text is not null")


def leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, start, end, edits, windows``: a row for each document and item of which it holds a window.

    Texts are searched once whatever the number of items that have them; ids return by a join of the rows found, dealt in parts so that a
    passage that very many documents hold is not one task's.
    """
    rows, items = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")), keyed(benchmark, item_col, item_text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def passed(keys: list[str], index: Index) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast((keys, index))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, index = shared.value
            for batch in pieces(batches, "text", PART):
                found = regions(index, *text_buffer(batch.column(1)))
                if found:
                    r, i, b, e, d, n = (list(x) for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(r, pa.int64())), pa.array([keys[x] for x in i], pa.string()), *(pa.array(x, pa.int64()) for x in (b, e, d, n))], ["doc_id", "item_key", "start", "end", "edits", "windows"])

        return rows.mapInArrow(run, f"doc_id {kind}, item_key string, start long, end long, edits long, windows long")

    found = reduce(DataFrame.unionByName, (passed(keys, index) for keys, index in blocks(items, block_bytes)))
    found = found.withColumn("part_", F.pmod(F.xxhash64("doc_id", "start", "end"), F.lit(PARTS)).cast("int"))
    names = items.select("item_id", "item_key", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part_"))
    return found.join(names, ["item_key", "part_"]).select("doc_id", "item_id", "start", "end", "edits", "windows")


def without_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = 1 << 20, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that leak no item, all columns kept; one narrow pass for each block, ``CHAINED`` of them in a stage."""
    place = docs.columns.index(text_col)

    def passed(rows: DataFrame, index: Index) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, text_col, PART):
                keep = np.ones(batch.num_rows, bool)
                keep[[r for r, *_ in regions(shared.value, *text_buffer(batch.column(place)))]] = False
                yield batch.filter(pa.array(keep))

        return rows.mapInArrow(run, docs.schema)

    rows = docs
    for k, (_, index) in enumerate(blocks(keyed(benchmark, item_col, item_text_col), block_bytes)):
        rows = passed(cut(rows) if k and k % CHAINED == 0 else rows, index)
    return rows
