"""Operator 6, suffix-array dedup: run-length indexes over the repeated parts of a corpus, and matching statistics against them.

A byte goes if a string of ``WIDTH`` bytes that covers it also starts in a document with a smaller id. One index of a whole corpus
cannot be spread over machines, so the corpus is first split by content. Every window of ``WIDTH`` bytes has an
anchor, the smallest hash of its ``GRAM``-byte grams; equal windows have equal anchors. Windows in a row with the same anchor form a segment.

1. Documents are packed into compressed blocks, in a table bucketed by block, so that later steps join it in place; texts
   beyond ``PART`` bytes come in parts that overlap by a window.
2. Blocks tally their anchors (``blocks.tally``); those that occur in two documents matter.
3. Each block sends the segments of such anchors by hash range. Copies within a block stay behind: all but those of the smallest id are
   covered in full. An anchor found in more than ``hot`` blocks is split, each of its windows going by its own hash.
4. For each range, equal segments become one string with its smallest id. Strings that share their anchor with others are built into run-length
   indexes (a run-compressed Burrows-Wheeler transform with samples at the ends of repeated stretches) and streamed against them;
   matches of ``WIDTH`` bytes with a smaller owner are marked. The number of ranges grows with the bytes, without a bound.
5. Marks return to the blocks, where what is left of each document is hashed. The parts of a long text are stitched in order, a part at a time.

Defined cases: null text is empty; documents shorter than ``WIDTH`` keep all; equal ids do not remove from each other, so repeated rows
keep what no smaller id has; null ids neither remove nor lose bytes; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.blocks import Block, buckets_of, expanded, level, levels_of, pack, range_bits, range_of, rows_of, squeezed, tally
from corpusloom.llm.common import Scratch, mix64, powers, sort_places
from corpusloom.llm.rindex import RunIndex

WIDTH = 50
GRAM = 24
CHUNK = 1 << 15
PART = 1 << 19  # bytes of a text that make a part
BLOCK_BYTES = 4 << 20  # of text in a block
RANGE_BYTES = 16 << 20  # of text for one hash range
LEAST_BLOCKS, LEAST_RANGES = 256, 64  # of an input that is small, if it has a MB for each
INDEX_BYTES = 3 << 17  # of strings from which one index is made, but for a single anchor
LONGEST = 64  # windows in a segment
HOT = 8192  # segments of one anchor
LOOSE = 20  # low bits of an anchor that are left out; that they agree is of no use


def _sums(data: np.ndarray, size: int) -> np.ndarray:
    """A polynomial of the ``size`` bytes from each place."""
    n = len(data) - size + 1
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    values = data.astype(np.uint64)
    values += np.uint64(1)
    values *= up[:-1]
    np.cumsum(values, out=sums[1:])
    out = sums[size:] - sums[:-size]
    out *= down[:n]
    return out


def window_hashes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash of the window at each of the places, which ascend."""
    return contents(data, start, np.full(len(start), WIDTH))[0]


def anchors(data: np.ndarray) -> np.ndarray:
    """The smallest polynomial of a gram in the window at each place."""
    out = np.zeros(max(0, len(data) - WIDTH + 1), np.uint64)
    span = WIDTH - GRAM + 1
    for lo in range(0, len(out), CHUNK):
        hi = min(len(out), lo + CHUNK)
        h = _sums(data[lo : hi + WIDTH - 1], GRAM)
        width = 1
        while 2 * width <= span:
            h = np.minimum(h[:-width], h[width:])
            width *= 2
        rest = span - width
        np.minimum(h[: len(h) - rest], h[rest:], out=out[lo:hi])
    return out


def segments(data: np.ndarray, at: np.ndarray, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, number of windows and anchor of each segment; none reaches over the end of a document."""
    low = anchors(data)
    n = len(low)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    size = np.diff(at)
    reach = np.where(usable, np.maximum(0, size - WIDTH + 1), 0)  # windows of each text
    open_ = np.repeat(np.tile([True, False], len(size)), np.stack([reach, size - reach], axis=1).ravel())[:n]
    change = low[1:] != low[:-1]
    new, end = open_.copy(), open_.copy()
    new[1:] &= ~open_[:-1] | change
    end[:-1] &= ~open_[1:] | change
    start, size = np.flatnonzero(new), np.flatnonzero(end) + 1
    size -= start
    parts = -(-size // LONGEST)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start, size = np.repeat(start, parts) + nth * LONGEST, np.repeat(size, parts) - nth * LONGEST
    return start, np.minimum(size, LONGEST), spread(low[start])


def spread(values: np.ndarray) -> np.ndarray:
    """An even hash of them: the smallest of many are not spread evenly, and ranges go by the high bits."""
    return mix64(values) >> np.uint64(LOOSE) << np.uint64(LOOSE)


def equals(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal pairs together, and where in it each group of equals begins."""
    shift = np.uint64(len(first).bit_length())
    order = sort_places(first >> shift, 64 - int(shift))[1]
    for _ in range(2):
        a, b = first[order], second[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        if not (new[1:] & (a[1:] >> shift == a[:-1] >> shift)).any():
            break
        order = np.lexsort((second, first))  # pairs that differ in low bits only may stand mixed
    return order, np.flatnonzero(new)


def _anchored(row: dict) -> tuple[Block, np.ndarray, np.ndarray, np.ndarray]:
    """A block with place, number of windows and anchor of its segments."""
    block = Block(row)
    return block, *segments(block.data, block.at, block.known)


def _hashes(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The distinct anchors of a block, counted once or, where two of its rows have them, for each segment."""
    block, start, _, anchor = _anchored(row)
    order, heads = _by_anchor(anchor)
    if not len(heads):
        return anchor, np.zeros(0, np.int64)
    tails = np.append(heads[1:], len(order))
    doc = np.searchsorted(block.at, start, "right")
    return anchor[order[heads]], np.where(doc[order[heads]] < doc[order[tails - 1]], tails - heads, 1)


def _by_anchor(anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of anchors, and where in it each begins."""
    ordered, order = sort_places(anchor >> np.uint64(LOOSE), 64 - LOOSE)
    return order, np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(order)])


SENT = "bucket long, block long, copies long, facts binary, text binary"


def _send_segments(levelled: DataFrame, bits: int, hot: int) -> DataFrame:
    """Segments of repeated anchors by hash range, with the places that copies within a block cover. ``facts`` are places and sizes
    of copies, and places, sizes, owners and anchors of the segments that are sent."""
    names = [x.split()[0] for x in SENT.split(", ")]
    crowded = int(level(np.array(2 * hot)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block, start, size, anchor = _anchored(row)
            order, heads = _by_anchor(anchor)
            seen = np.empty(len(anchor), np.uint8)
            seen[order] = np.repeat(levels_of(row), np.diff(np.append(heads, len(order))))
            keep = seen > 1
            start, size, anchor, many = start[keep], size[keep], anchor[keep], seen[keep] > crowded
            if many.any():  # each window of a hot anchor by its own hash
                n = np.where(many, size, 1)
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                many = np.repeat(many, n)
                start, size, anchor = np.repeat(start, n) + nth, np.where(many, 1, np.repeat(size, n)), np.repeat(anchor, n)
                anchor[many] = spread(window_hashes(block.data, start[many]))
            if not len(start):
                continue
            owner = block.ids[np.searchsorted(block.at, start, "right") - 1]
            order, heads = equals(*contents(block.data, start, size + WIDTH - 1))
            ordered = owner[order]
            copy = np.zeros(len(order), bool)
            copy[order] = ordered > np.repeat(np.minimum.reduceat(ordered, heads), np.diff(np.append(heads, len(order))))
            bucket = range_of(anchor, bits)
            order = sort_places(2 * bucket + ~copy, bits + 1)[1]
            start, size, owner, copy, bucket = start[order].astype(np.int32), size[order].astype(np.uint8), owner[order], copy[order], bucket[order]
            anchor = _tail(anchor[order], bits)
            raw, begin, stop = block.data.tobytes(), start.tolist(), (start + size + (WIDTH - 1)).tolist()
            heads = np.flatnonzero(np.diff(bucket, prepend=-1))
            copies = np.add.reduceat(copy, heads, dtype=np.int64)
            facts, text = [], []
            for a, c, b in zip(heads.tolist(), (heads + copies).tolist(), [*heads[1:].tolist(), len(order)], strict=True):
                facts.append(squeezed(b"".join([start[a:c].tobytes(), size[a:c].tobytes(), start[c:b].tobytes(), size[c:b].tobytes(), owner[c:b].tobytes(), anchor[c:b].tobytes()])))
                text.append(squeezed(b"".join([raw[x:y] for x, y in zip(begin[c:b], stop[c:b], strict=True)])))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[heads]), pa.array(np.full(len(heads), row["block"])), pa.array(copies), pa.array(facts, pa.binary()), pa.array(text, pa.binary())], names)

    return levelled.mapInArrow(run, SENT)


def _tail(anchor: np.ndarray, bits: int) -> np.ndarray:
    """32 bits of an anchor below those that its range tells. Anchors that agree in them go into one index, which loses nothing."""
    return (anchor << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)


def _received(copies: int, facts: bytes) -> list[np.ndarray]:
    """The arrays of one row that was sent."""
    raw, out, at = expanded(facts, np.uint8), [], 0
    rest = (len(raw) - 5 * copies) // 17
    for n, kind in ((copies, np.int32), (copies, np.uint8), (rest, np.int32), (rest, np.uint8), (rest, np.int64), (rest, np.uint32)):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * out[-1].itemsize
    return out


def contents(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash of each stretch, in two words; stretches begin in ascending order, and are hashed a chunk at a time."""
    first, second = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
    row = 0
    while row < len(start):
        base = int(start[row])
        stop = max(row + 1, int(np.searchsorted(start, base + CHUNK, "right")))
        a, n = start[row:stop] - base, length[row:stop]
        part = data[base : base + int((a + n).max())].astype(np.uint64)
        up, down = powers(len(part) + 1)
        square = (part + np.uint64(3)) * np.uint64(0xBF58476D1CE4E5B9)
        square ^= square >> np.uint64(31)
        for out, values in ((first, part + np.uint64(1)), (second, square)):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(values * up[: len(part)], out=sums[1:])
            out[row:stop] = mix64((sums[a + n] - sums[a]) * down[a] ^ n.astype(np.uint64))
        row = stop
    return first, second


def related(data: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Which strings may share a window with one of another owner.

    A window has at least half of the bytes beside its anchor's gram on one side of it, so the strings that share it share the gram
    with that half.
    """
    half = (WIDTH - GRAM) // 2
    at = np.cumsum(lengths) - lengths
    grams = np.full(len(data), np.iinfo(np.uint64).max)
    for lo in range(0, len(data) - GRAM + 1, CHUNK):
        part = _sums(data[lo : lo + CHUNK + GRAM - 1], GRAM)
        grams[lo : lo + len(part)] = part
    within = np.repeat(at + lengths - GRAM, lengths)
    place = np.arange(len(data))
    grams[place > within] = np.iinfo(np.uint64).max  # those reach into the next string
    spot = np.flatnonzero((grams == np.repeat(np.minimum.reduceat(grams, at), lengths)) & (place <= within))
    string = np.searchsorted(at, spot, "right") - 1
    before, after = spot - at[string] >= half, spot + GRAM + half <= (at + lengths)[string]
    keys, who = [], np.concatenate([string[before], string[after]])
    for k, start in enumerate((spot[before] - half, spot[after])):
        keys.append(contents(data, start, np.full(len(start), GRAM + half))[0] >> np.uint64(22) << np.uint64(1) | np.uint64(k))
    out = np.zeros(len(lengths), bool)
    ordered, order = sort_places(np.concatenate(keys), 43)
    if len(order):
        heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        owner = owners[who[order]]
        told = np.minimum.reduceat(owner, heads) < np.maximum.reduceat(owner, heads)
        out[who[order][np.repeat(told, np.diff(np.append(heads, len(order))))]] = True
    return out


def _search(table: pa.Table) -> pa.Table:
    """For one hash range, the places to mark in each block."""
    facts = [_received(n, x.as_py()) for n, x in zip(table["copies"].to_pylist(), table["facts"], strict=True)]
    near, near_size, place, size, owner, anchor = (np.concatenate(x) for x in zip(*facts, strict=True))
    near_row, row = (np.repeat(np.arange(len(facts)), [len(f[k]) for f in facts]) for k in (0, 2))
    data = np.concatenate([expanded(x.as_py(), np.uint8) for x in table["text"]])
    size = size.astype(np.int64)
    length = size + WIDTH - 1
    begin = np.cumsum(length) - length
    marks = [(near_row, near, near_size)]  # copies that stayed behind in their blocks
    if len(size):
        order, heads = equals(*contents(data, begin, length))
        lowest = np.minimum.reduceat(owner[order], heads)  # owner of each distinct string
        string = np.empty(len(order), np.int64)
        string[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
        copy = owner > lowest[string]
        marks.append((row[copy], place[copy], size[copy]))
        # strings whose anchor other strings share
        head = order[heads]
        told, shared = sort_places(anchor[head], 32)
        same = told[1:] == told[:-1]
        other = np.append(same, False) | np.append(False, same)
        chosen = shared[other]
        if len(chosen):
            # strings of different anchors share no window, so that a range may have several indexes of a bounded size
            new = np.append(True, told[other][1:] != told[other][:-1])
            long = length[head[chosen]]
            begun = (np.cumsum(long) - long)[new]
            part = (begun // INDEX_BYTES)[np.cumsum(new) - 1]
            chosen = chosen[np.lexsort((lowest[chosen], part))]
            found = []
            for lo, hi in zip(np.flatnonzero(np.diff(part, prepend=-1)), np.append(np.flatnonzero(np.diff(part)) + 1, len(part)), strict=True):
                seg, owners = head[chosen[lo:hi]], lowest[chosen[lo:hi]]
                long = length[seg]
                taken = data[np.repeat(begin[seg] - (np.cumsum(long) - long), long) + np.arange(long.sum())]
                near = related(taken, long, owners)
                if near.any():
                    strings, places = RunIndex.build(taken[np.repeat(near, long)], long[near], owners[near], WIDTH).statistics()
                    found.append((np.flatnonzero(near)[strings] + lo, places))
            which, at = (np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 2, *found, strict=True))
            # matches go to every segment of that string and owner
            rank = np.full(len(head), -1)
            rank[chosen] = np.arange(len(chosen))
            mine = np.flatnonzero(~copy & (rank[string] >= 0))
            mine = mine[sort_places(rank[string[mine]], 32)[1]]
            per = np.bincount(rank[string[mine]], minlength=len(chosen))
            first_of = np.cumsum(per) - per
            n = per[which]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            target = mine[np.repeat(first_of[which], n) + nth]
            marks.append((row[target], place[target] + np.repeat(at, n), np.ones(len(target), np.int64)))
    where, spot, count = (np.concatenate(x) for x in zip(*marks, strict=True))
    order = sort_places(where, len(facts).bit_length())[1]
    where, spot, count = where[order], spot[order].astype(np.int32), count[order].astype(np.uint8)
    heads = np.flatnonzero(np.diff(where, prepend=-1))
    out = [squeezed(spot[a:b].tobytes() + count[a:b].tobytes()) for a, b in zip(heads.tolist(), np.append(heads, len(order))[1:].tolist(), strict=True)]
    return pa.table({"block": table["block"].combine_chunks().take(pa.array(where[heads])), "marks": pa.array(out, pa.binary())})


def _covered(block: Block, marks: list[bytes]) -> np.ndarray:
    """Which bytes of a block the marks cover."""
    step = np.zeros(len(block.data) + 1, np.int32)
    for raw in marks:
        both = expanded(raw, np.uint8)
        n = len(both) // 5
        place, size = np.frombuffer(both, np.int32, n).astype(np.int64), both[4 * n :]
        np.add.at(step, place, 1)
        np.add.at(step, place + size + (WIDTH - 1), -1)
    return np.cumsum(step, dtype=np.int32, out=step)[:-1] > 0


def _remains(marked: DataFrame) -> DataFrame:
    """What is left of each row of the blocks; rows of one part of a long text carry its key, their place and their bytes."""
    names = ["doc_id", "key", "place", "n_bytes", "n_removed", "n_spans", "kept_sha256", "edges", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = Block(row)
            gone, at, part = _covered(block, row["marks"] or []), block.at, block.keys >= 0
            edge = np.zeros(len(gone) + 1, bool)
            edge[at] = True
            first, last = gone.copy(), gone.copy()
            first[1:] &= ~gone[:-1] | edge[1:-1]
            last[:-1] &= ~gone[1:] | edge[1:-1]
            begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
            of = np.searchsorted(at, begin, "right") - 1
            spans = np.bincount(of, minlength=len(block.ids))
            removed = np.bincount(of, weights=end - begin, minlength=len(block.ids)).astype(np.int64)
            upto = np.concatenate([[0], np.cumsum(spans)])
            raw, cuts = memoryview(block.data), np.stack([begin, end], axis=1).ravel().tolist()
            kept, text = [], []
            for r, (a, b, lo, hi) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), upto[:-1].tolist(), upto[1:].tolist(), strict=True)):
                text.append(squeezed(block.data[a:b]) if part[r] else None)
                if part[r]:
                    kept.append(None)
                    continue
                digest, own = hashlib.sha256(), [a, *cuts[2 * lo : 2 * hi], b]
                for x, y in zip(own[::2], own[1::2], strict=True):
                    digest.update(raw[x:y])
                kept.append(digest.hexdigest())
            inner = np.stack([begin, end], axis=1) - at[of][:, None]
            columns = [pa.array(block.ids, pa.int64(), mask=~block.known), pa.array(block.keys, pa.int64(), mask=~part), pa.array(block.offsets), pa.array(np.diff(at)), pa.array(removed), pa.array(spans), pa.array(kept, pa.string())]
            columns += [pa.ListArray.from_arrays(pa.array((2 * upto).astype(np.int32)), pa.array(inner.ravel())), pa.array(text, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return marked.mapInArrow(run, "doc_id long, key long, place long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, edges array<long>, text binary")


def _stitched(parts: DataFrame) -> DataFrame:
    """Long texts from their parts, in order. The last bytes of a part wait for what the next one says of them."""

    class Text:
        def __init__(self, doc_id: int | None) -> None:
            self.doc_id, self.kept, self.size, self.removed, self.edges = doc_id, hashlib.sha256(), 0, 0, []
            self.tail, self.gone = np.zeros(0, np.uint8), np.zeros(0, bool)

        def add(self, data: np.ndarray, gone: np.ndarray, last: bool = False) -> None:
            gone[: len(self.gone)] |= self.gone
            stop = len(data) if last else max(0, len(data) - WIDTH + 1)
            self.kept.update(data[:stop][~gone[:stop]].tobytes())
            before = len(self.edges) % 2
            self.edges += (self.size + np.flatnonzero(np.diff(gone[:stop].astype(np.int8), prepend=before))).tolist()
            self.size, self.removed = self.size + stop, self.removed + int(gone[:stop].sum())
            self.tail, self.gone = data[stop:], gone[stop:]

        def result(self) -> tuple:
            self.add(self.tail, self.gone, True)
            if len(self.edges) % 2:
                self.edges.append(self.size)
            return self.doc_id, self.size, self.removed, len(self.edges) // 2, self.kept.hexdigest(), self.edges

    def batch_of(x: tuple) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(x, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "edges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, text = None, None
        for row in rows_of(batches):
            if row["key"] != key:
                if text is not None:
                    yield batch_of(text.result())
                key, text = row["key"], Text(row["doc_id"])
            step = np.zeros(row["n_bytes"] + 1, np.int8)
            step[row["edges"][::2]] = 1
            step[row["edges"][1::2]] = -1
            text.add(expanded(row["text"], np.uint8), np.cumsum(step)[:-1] > 0)
        if text is not None:
            yield batch_of(text.result())

    ordered = parts.select("doc_id", "key", "place", "n_bytes", "edges", "text").repartition("key").sortWithinPartitions("key", "place")
    return ordered.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, edges array<long>")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, part: int = PART, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, edges`` for every document; ``edges`` are begin and end of each removed run."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.lit(0).cast("long").alias("key"), docs[text_col].cast("string").alias("text"))
    buckets, total = buckets_of(rows, "text")
    size = max(1 << 20, min(BLOCK_BYTES, total // LEAST_BLOCKS))
    blocks = scratch.bucketed(pack(rows, part=part, overlap=WIDTH - 1, block_bytes=size), buckets, "block")
    levels = tally(blocks, _hashes, range_bits(total // 12))
    levelled = blocks.join(levels.hint("shuffle_hash"), "block")
    bits = range_bits(total, min(range_bytes, max(1 << 20, total // LEAST_RANGES)))
    sent = _send_segments(levelled, bits, hot).repartition(min(1 << bits, 1024), "bucket")
    marks = sent.groupBy("bucket").applyInArrow(_search, "block long, marks binary").groupBy("block").agg(F.collect_list("marks").alias("marks"))
    out = scratch.table(_remains(blocks.join(marks.hint("shuffle_hash"), "block", "left")))
    whole = out.where("key is null").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "edges")
    scratch.clear(keep=out)
    return whole.unionByName(_stitched(out.where("key is not null")))
