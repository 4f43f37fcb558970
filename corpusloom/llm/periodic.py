"""Operator 11, periodic run detection: a harmonic grid of word pairs whose common extensions are searched together.

A run of period q holds at least ``max(q, 12 - q)`` consecutive words that equal the word q further on, so one of them stands on a
multiple of that step: for all periods these are about n ln n pairs of a word and the one q further on. All pairs whose words agree are
extended to both sides at once, by binary search over hashes of prefixes. What is found is compared word by word and, where
a hash deceived, searched again with hashes over other moduli. An interval found with several periods has the smallest one: the others are its multiples.

Texts are worked on in pieces of about 1 MB and never cut: a long text is a piece by itself, its pairs come in chunks of
``PAIRS``, and only arrays with one number for each of its words and bytes are held. One narrow pass, no shuffle.

Defined cases: a null or empty text, and one of white space only, has no words, no run and the hash of nothing;
a null id leaves its text as it is; repeated rows each get their own result; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import mix64, pieces, powers, span_hashes, text_buffer, word_spans

SHORTEST = 12  # words of a run
PAIRS = 1 << 20  # worked on at a time
WORDS = 1 << 16  # hashed at a time
PRIMES = (2147483647, 2147483629)  # moduli of the second and later searches
TRIES = 6


class Prefixes:
    """Hashes of all stretches of a sequence of numbers, modulo 2^64 at first and modulo two primes with another base in every later try."""

    def __init__(self, values: np.ndarray, seed: int = 0) -> None:
        n, self.rows = len(values), []
        if seed == 0:
            up = powers(n + 1)[0]
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(values * up[:-1], out=sums[1:])
            self.rows.append((None, up, sums))
            return
        for k, prime in enumerate(PRIMES):
            p, base = np.uint64(prime), np.uint64((0x1F3D5B79 * (2 * seed + k) + 12345) % (prime - 2) + 2)
            up = np.ones(n + 1, np.uint64)
            have = 1
            while have <= n:  # doubled: the powers above are those below times one of them
                up[have : 2 * have] = up[: len(up[have : 2 * have])] * (up[have - 1] * base % p) % p
                have *= 2
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(values % p * up[:-1] % p, out=sums[1:])
            self.rows.append((p, up, sums))

    def equal(self, at: np.ndarray, far: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the stretches that begin at ``at`` and ``far`` (not before it) agree over ``sizes`` numbers."""
        out = np.ones(len(at), bool)
        for p, up, sums in self.rows:
            near, other = sums[at + sizes] - sums[at], sums[far + sizes] - sums[far]
            out &= near * up[far - at] == other if p is None else near % p * up[far - at] % p == other % p
        return out


def _extent(equal, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest length, ``low`` to ``high``, for which ``equal(rows, lengths)`` holds; for all rows together."""
    low, high = low.copy(), high.copy()
    live = np.flatnonzero(low < high)
    while len(live):
        mid = (low[live] + high[live] + 1) // 2
        same = equal(live, mid)
        low[live] = np.where(same, mid, low[live])
        high[live] = np.where(same, high[live], mid - 1)
        live = live[low[live] < high[live]]
    return low


def _grid(counts: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of all pairs of the grid: position, period, and the first word and the end of the text."""
    most = np.where(counts >= SHORTEST, counts // 2, 0)
    texts = np.repeat(np.arange(len(counts)), most)
    period = np.arange(len(texts)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(period, SHORTEST - period)
    size = (counts[texts] - period - 1) // step + 1
    ends = np.cumsum(size)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + PAIRS, "right")))
        n = size[row:stop]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first = firsts[texts[row:stop]]
        yield np.repeat(first, n) + nth * np.repeat(step[row:stop], n), np.repeat(period[row:stop], n), np.repeat(first, n), np.repeat(first + counts[texts[row:stop]], n)
        row = stop


def _smallest(found: np.ndarray) -> np.ndarray:
    """Rows ``start, end, period`` by start, one for each interval, with its smallest period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[new]


def search(values: np.ndarray, counts: np.ndarray, seed: int = 0) -> np.ndarray:
    """Rows ``start, end, period`` of all runs of texts of ``counts`` words each, laid end to end; ``values`` are hashes of the words."""
    prefixes = Prefixes(values, seed)
    found = np.zeros((0, 3), np.int64)
    for at, period, first, last in _grid(counts, np.cumsum(counts) - counts):
        live = np.flatnonzero(values[at] == values[at + period])
        at, period, first, last = at[live], period[live], first[live], last[live]
        need = np.maximum(period, SHORTEST - period)
        # of the words needed half stand on one side: ahead, or all of the other half and one more behind
        ahead, behind = (need + 1) // 2, need // 2 + 1
        fits = at + period + ahead <= last
        ahead = np.where(fits, ahead, 0)
        good = fits & prefixes.equal(at, at + period, ahead)
        fits = at - behind >= first
        behind = np.where(fits, behind, 0)
        good |= fits & prefixes.equal(at - behind, at - behind + period, behind)
        at, period, first, last, need = at[good], period[good], first[good], last[good], need[good]
        far = at + period
        ahead = _extent(lambda r, n, at=at, far=far: prefixes.equal(at[r], far[r], n), np.ones_like(at), last - far)
        behind = _extent(lambda r, n, at=at, far=far: prefixes.equal(at[r] - n, far[r] - n, n), np.zeros_like(at), at - first)
        good = ahead + behind >= need
        if good.any():
            found = _smallest(np.concatenate([found, np.stack([at - behind, far + ahead, period], axis=1)[good]]))
    return found


def verified(found: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bool:
    """Whether every word of every run has the bytes of the one a period further on, or a period before."""
    sizes = found[:, 1] - found[:, 2] - found[:, 0]
    for row in range(len(found)):
        for lo in range(0, int(sizes[row]), WORDS):
            a = np.arange(found[row, 0] + lo, found[row, 0] + min(lo + WORDS, int(sizes[row])))
            b = a + found[row, 2]
            n = ends[a] - starts[a]
            if (n != ends[b] - starts[b]).any():
                return False
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(n) >> 20)) + 1).tolist(), len(a)]
            for i, j in zip(cuts, cuts[1:], strict=False):
                within = np.arange(n[i:j].sum()) - np.repeat(np.cumsum(n[i:j]) - n[i:j], n[i:j])
                if (data[np.repeat(starts[a[i:j]], n[i:j]) + within] != data[np.repeat(starts[b[i:j]], n[i:j]) + within]).any():
                    return False
    return True


def runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows ``start, end, period`` of all runs of words at ``starts`` to ``ends`` of ``data``, in texts of ``counts`` words each."""
    found = search(span_hashes(data, starts, ends), counts)
    if verified(found, data, starts, ends):
        return found
    raw, numbers = data.tobytes(), {}
    values = np.fromiter((numbers.setdefault(raw[s:e], len(numbers)) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))
    for seed in range(1, TRIES):
        found = search(mix64(values + np.uint64(1)), counts, seed)
        if verified(found, data, starts, ends):
            return found
    raise RuntimeError(f"no hash told the words apart in {TRIES} tries")


def rewritten(order: np.ndarray, counts: np.ndarray, hashes: list[int | None]) -> np.ndarray:
    """``order``, the numbers of all words, with a tenth of the texts made periodic from some word on, as their hash says."""
    first = 0
    for n, h in zip(counts.tolist(), hashes, strict=True):
        if n and h is not None and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            order[first + a : first + n] = first + a + np.arange(n - a) % p
        first += n
    return order


def _kept_hash(raw: memoryview, starts: np.ndarray, ends: np.ndarray, order: np.ndarray) -> str:
    """Hash of the words ``order`` joined by one space; words that stand side by side in the text are taken together."""
    out, sep = hashlib.sha256(), b""
    cuts = [0, *(np.flatnonzero(np.diff(order) != 1) + 1).tolist(), len(order)]
    for i, j in zip(cuts, cuts[1:], strict=False):
        for k in range(i, j, WORDS):
            stop = min(j, k + WORDS)
            out.update(sep + b" ".join(bytes(raw[starts[order[k]] : ends[order[stop - 1]]]).split()))
            sep = b" "
    return out.hexdigest()


DIGEST = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _piece(column: pa.Array, hashes: list[int | None]) -> list[tuple]:
    data, at = text_buffer(column)
    starts, ends, rows = word_spans(data, at)
    counts = np.bincount(rows, minlength=len(column)).astype(np.int64)
    order = rewritten(np.arange(len(starts)), counts, hashes)
    found = runs(data, starts[order], ends[order], counts)
    gone = np.zeros(len(starts) + 1, np.int64)  # opened and closed where what a run repeats begins and ends
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 1], -1)
    keep = np.cumsum(gone)[:-1] == 0
    bounds = np.concatenate([[0], np.cumsum(counts)])
    spans, raw, out = np.searchsorted(found[:, 0], bounds), memoryview(data), []
    for row in range(len(column)):
        lo, hi = int(bounds[row]), int(bounds[row + 1])
        own = found[spans[row] : spans[row + 1]]
        own = own[np.lexsort((own[:, 2], own[:, 0]))].tolist()
        listed = "".join(f"{s - lo},{e - s},{q}\n" for s, e, q in own)
        s, e, q = min(own, key=lambda r: (r[0] - r[1], r[0], r[2]), default=(None, None, None))
        best = (None,) * 4 if s is None else (s - lo, e - s, q, 1000 * (e - s) // q)
        out.append((len(own), *best, hashlib.sha256(listed.encode()).hexdigest(), _kept_hash(raw, starts, ends, order[lo:hi][keep[lo:hi]])))
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: bool = True) -> DataFrame:
    """``doc_id`` and, for each document, the count of its runs, its longest run, and hashes of all runs and of what is left without repeats.

    With ``rewrite`` a tenth of the texts, chosen by the id, are made periodic first; without it texts are taken as they are.
    """
    h = F.crc32(docs[id_col].cast("string").cast("binary")) if rewrite else F.lit(None).cast("long")
    rows = docs.select(docs[id_col].alias("doc_id"), h.alias("h"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    types = [pa.int64()] * 5 + [pa.string()] * 2
    names = ["doc_id", *(x.split()[0] for x in DIGEST.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 20):
            got = list(zip(*_piece(batch.column(2), batch.column(1).to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, t) for v, t in zip(got, types, strict=True))], names)

    return rows.mapInArrow(run, f"doc_id {kind}, {DIGEST}")
