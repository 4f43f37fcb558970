"""Character n-gram features of whole texts and small linear models on them, vectorised over Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from corpusloom.llm.common import pieces, span_hashes, text_buffer, word_spans

BITS = 18
#: Bytes of text handled at once; a longer text is counted in parts.
PART = 1 << 18


def _folding() -> np.ndarray:
    """Letters in lower case, bytes of other scripts as they are, digits as 0 and everything else as a space."""
    out = np.full(256, 32, np.uint8)
    out[128:] = np.arange(128, 256)
    out[97:123] = out[65:91] = np.arange(97, 123)
    out[48:58] = 48
    return out


FOLDED = _folding()


@dataclass
class Grams:
    """Which n-grams of bytes count: their length, and whether case and punctuation are folded away."""

    size: int
    fold: bool

    def codes(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hash code of the gram at each position and the row of that position; none crosses rows."""
        n = len(data) - self.size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        low = FOLDED[data] if self.fold else data
        h = np.zeros(n, np.uint64)
        for k in range(self.size):
            h = (h << np.uint64(8)) | low[k : k + n]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h >>= np.uint64(64 - BITS)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))[:n]
        inside = at[row + 1] - np.arange(n) >= self.size
        return h[inside].astype(np.int64), row[inside]


@dataclass
class Features:
    """A choice of gram codes, as columns of a matrix."""

    grams: Grams
    chosen: np.ndarray
    slot: np.ndarray = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.slot = np.full(1 << BITS, -1, np.int32)
        self.slot[self.chosen] = np.arange(len(self.chosen))

    def counts(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the chosen grams in each row, and how many grams each row has."""
        rows, width = len(at) - 1, len(self.chosen)
        out, total = np.zeros((rows, width)), np.zeros(rows)
        for lo in range(0, len(data), PART):
            hi = min(len(data), lo + PART + self.grams.size - 1)
            # a part holds the rows from first to last; a gram counts in the part that it begins in
            first, last = int(np.searchsorted(at, lo, "right")) - 1, int(np.searchsorted(at, hi, "left"))
            code, row = self.grams.codes(data[lo:hi], np.clip(at[first : last + 1], lo, hi) - lo)
            total[first:last] += np.bincount(row, minlength=last - first)
            col = self.slot[code]
            hit = col >= 0
            out[first:last] += np.bincount(row[hit] * width + col[hit], minlength=(last - first) * width).reshape(last - first, width)
        return out, total

    def matrix(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log(1 + count) against the length of the text."""
        out, total = self.counts(data, at)
        np.log1p(out, out=out)
        out /= (1 + np.log1p(total / 2000))[:, None]
        return out


def presence(grams: Grams, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of each row, and their rows, in 32 bits: one task holds them for all examples at once."""

    def distinct(lo: int, hi: int) -> np.ndarray:
        stops = [(a, min(hi, a + PART + grams.size - 1)) for a in range(lo, max(lo + 1, hi), PART)]
        found = [np.unique(grams.codes(data[a:b], np.array([0, b - a]))[0]).astype(np.int32) for a, b in stops]
        return found[0] if len(found) == 1 else np.unique(np.concatenate(found))

    codes = [distinct(int(at[r]), int(at[r + 1])) for r in range(len(at) - 1)]
    rows = np.repeat(np.arange(len(codes), dtype=np.int32), [len(c) for c in codes])
    return np.concatenate([*codes, np.zeros(0, np.int32)]), rows


def select(codes: np.ndarray, rows: np.ndarray, y: np.ndarray, use: np.ndarray, width: int, least: int = 3) -> np.ndarray:
    """The codes whose presence in a row tells most of ``y``, by the z value of a difference of proportions.

    Only rows with ``use`` count; a code must be in ``least`` of them.
    """
    with_, without = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for lo in range(0, len(codes), 1 << 18):
        code, row = codes[lo : lo + (1 << 18)], rows[lo : lo + (1 << 18)]
        for out, of in ((with_, use & (y == 1)), (without, use & (y == 0))):
            out += np.bincount(code[of[row]], minlength=1 << BITS)
    n1 = max(1.0, float(y[use].sum()))
    n0 = max(1.0, float(use.sum()) - n1)
    p = (with_ + without + 1) / (n1 + n0 + 2)
    z = np.abs(with_ / n1 - without / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    z[with_ + without < least] = 0
    order = np.lexsort((np.arange(len(z)), -z))[:width]
    return np.sort(order[z[order] > 0])


def shape(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Shares of a text that are symbols, capitals, digits, and words that repeat the word before."""
    rows = len(at) - 1
    sums = np.zeros((rows, 6))
    for lo in range(0, max(1, len(data)), PART):
        hi = min(len(data), lo + PART)
        part, sub = data[lo:hi], np.clip(at, lo, hi) - lo
        starts, ends, row = word_spans(part, sub)
        words = span_hashes(part, starts, ends)
        again = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
        capital = (part >= 65) & (part <= 90)
        digit = (part >= 48) & (part <= 57)
        letter = capital | ((part >= 97) & (part <= 122)) | (part >= 128)
        symbol = ~(letter | digit | (part == 32) | ((part >= 9) & (part <= 13)))
        for k, flags in enumerate((symbol, capital, digit)):
            total = np.concatenate([[0], np.cumsum(flags)])
            sums[:, k] += total[sub[1:]] - total[sub[:-1]]
        sums[:, 3] += np.bincount(row[1:][again], minlength=rows)
        sums[:, 4] += np.bincount(row, minlength=rows)
        sums[:, 5] += np.diff(sub)
    share = sums[:, :4] / np.maximum(1, np.stack([sums[:, 5]] * 3 + [sums[:, 4]], axis=1))
    return np.log1p(100 * share)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def descend(gradient, width: int, rounds: int, rate: float) -> np.ndarray:
    """Adam from zero on a full-batch gradient."""
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, rounds + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 0.05, l2: float = 1e-4) -> np.ndarray:
    """Weights of a logistic regression, its intercept last."""
    n = max(1, len(x))

    def gradient(w: np.ndarray) -> np.ndarray:
        off = sigmoid(linear(x, w)) - y
        return np.append(x.T @ off / n + l2 * w[:-1], off.sum() / n)

    return descend(gradient, x.shape[1] + 1, rounds, rate)


def linear(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A list of texts as one buffer with offsets."""
    return text_buffer(pa.array([t or "" for t in texts], pa.large_string()))


def text_pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in pieces(batches, column, PART):
        yield (batch, *text_buffer(batch.column(column)))
