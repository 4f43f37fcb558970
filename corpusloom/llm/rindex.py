"""A run-length index of a set of strings: a run-compressed Burrows-Wheeler transform with samples, and its matching."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from corpusloom.llm.common import sort_places

SEPARATOR = 255  # never a byte of UTF-8
FIRST = 5  # bytes that the first sort looks at, so that a key and its place share a word


def _dense(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The stable sorting order of the keys, which have ``bits`` bits, and their dense ranks from 1."""
    ordered, order = sort_places(keys, bits)
    step = np.ones(len(keys), np.int64)
    step[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(step, out=step)
    return order, rank


@dataclass
class RunIndex:
    """The transform of strings in the order of their owners.

    Rows are all suffixes in sorted order, equal ones in the order of the strings. Kept are the runs of equal
    preceding bytes (their first row, byte and where that row's preceding suffix stands), and a sample for each maximal run of
    rows that agree in ``width`` bytes and belong to different owners: its first and last row and smallest owner.
    """

    run_start: np.ndarray
    run_target: np.ndarray
    sample_start: np.ndarray
    sample_end: np.ndarray
    sample_owner: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray
    rows: int
    width: int
    run_of: np.ndarray  # of each row

    @classmethod
    def build(cls, data: np.ndarray, lengths: np.ndarray, owners: np.ndarray, width: int) -> RunIndex:
        """``owners`` ascend; ``data`` holds the strings one after the other."""
        m = len(lengths)
        ends = np.cumsum(lengths + 1) - 1  # of the separators
        n = int(ends[-1]) + 1
        text = np.full(n, SEPARATOR, np.uint8)
        body = np.ones(n, bool)
        body[ends] = False
        text[body] = data
        left = np.repeat(ends, lengths + 1) - np.arange(n)  # bytes before the separator
        keys = np.zeros(n, np.uint64)
        for k in range(FIRST):
            keys <<= np.uint64(8)
            stop = max(0, n - k)
            keys[:stop] |= np.where(left[:stop] >= k, text[k:], 0)
        order, rank = _dense(keys, 8 * FIRST)
        depth, half = FIRST, None
        longest = int(lengths.max()) + 1
        bits = n.bit_length()

        def ahead(ranks: np.ndarray, by: int, least: int) -> np.ndarray:
            """The ranks of the suffixes that begin so many bytes further on, where at least ``least`` bytes are left."""
            out = np.zeros(n, np.int64)
            out[: max(0, n - by)] = ranks[by:]
            out *= left >= least
            return out

        agree = np.zeros(n, np.int64)
        while depth < longest or half is None:
            if half is None and 2 * depth >= width:  # ranks that tell strings apart by half the width or more
                half = rank
                agree = half * (n + 1) + ahead(half, width - depth, width)
            follow = ahead(rank, depth, depth)
            follow |= rank << bits
            order, rank = _dense(follow, 2 * bits)
            depth *= 2
        before = np.where(order > 0, text[order - 1], SEPARATOR)
        new = np.ones(n, bool)
        new[1:] = before[1:] != before[:-1]
        start = np.flatnonzero(new)
        byte = before[start].astype(np.int64)
        size = np.diff(np.append(start, n))
        smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=256))])[byte]
        by_byte = np.argsort(byte, kind="stable")
        within = np.cumsum(size[by_byte]) - size[by_byte]
        first = np.searchsorted(byte[by_byte], byte[by_byte], "left")
        target = np.empty(len(start), np.int64)
        target[by_byte] = smaller[by_byte] + within - within[first]
        # rows that agree in ``width`` bytes
        wide = left[order] >= width
        join = np.zeros(n, bool)
        join[1:] = wide[1:] & wide[:-1] & (agree[order[1:]] == agree[order[:-1]])
        heads = np.flatnonzero(~join)
        owner = np.repeat(owners, lengths + 1)[order]
        low, high = np.minimum.reduceat(owner, heads), np.maximum.reduceat(owner, heads)
        tails = np.append(heads[1:], n)
        told = low < high
        return cls(start, target, heads[told], tails[told], low[told], lengths, owners, n, width, np.repeat(np.arange(len(start), dtype=np.int32), size))

    def preceding(self, rows: np.ndarray) -> np.ndarray:
        """The row of the suffix one byte longer, for each row."""
        run = self.run_of[rows]
        return self.run_target[run] + rows - self.run_start[run]

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """String and place of every match of ``width`` bytes that a string shares with one of a smaller owner.

        All strings stream through the index together, last byte first, one backward step for each byte.
        """
        m = len(self.lengths)
        if not len(self.sample_start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        live = np.argsort(-self.lengths, kind="stable")
        sizes = self.lengths[live]
        rows = self.rows - m + live  # separators sort last, in the order of the strings
        sample_of = np.zeros(self.rows + 1, np.int32)  # the last sample that begins at each row or before it, from 1
        sample_of[self.sample_start] = 1
        sample_of = np.cumsum(sample_of, dtype=np.int32)
        strings, places = [], []
        for step in range(1, int(sizes[0]) + 1):
            n = int(np.searchsorted(-sizes, -step, "right"))
            live, sizes, rows = live[:n], sizes[:n], self.preceding(rows[:n])
            if step >= self.width:
                at = sample_of[rows] - 1
                hit = (at >= 0) & (rows < self.sample_end[at]) & (self.sample_owner[at] < self.owners[live])
                strings.append(live[hit])
                places.append(sizes[hit] - step)
        return np.concatenate([*strings, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*places, np.zeros(0, np.int64)]).astype(np.int64)
