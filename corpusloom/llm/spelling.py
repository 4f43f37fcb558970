"""Operator 12, spelling variant grouping: every word's whole neighbourhood, joined to the vocabulary.

For each word all distinct deletions, replacements and insertions over the observed alphabet are made. A word that one of them equals differs by exactly
one code point, so the join on the whole string is the result and no distance is computed. Candidates are made as numbers first: the
hash of a changed word follows from sums over its beginning and its end. Only candidates that a bit set of the
vocabulary may hold become strings and are shuffled. The set is of ``MOST_BITS`` bits at most; a larger vocabulary is searched in passes, one
for each hash range of it.

The vocabulary is counted in the tasks before the shuffle. A word is the candidate of no more words than its own neighbourhood
holds, so no key of the join grows with the corpus.

Defined cases: null and empty texts have no words; a null id counts as an empty one where a hash is taken; repeated rows
count each; words of any length take part; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import BASE, Scratch, cut, mix64, pieces, powers

LEAST = 7  # code points of a word
#: Fixed pattern: longer runs of letters, as whole as the shorter ones that are left out.
RUN = re.compile(r"[a-zÀ-ÿ]{%d,}" % LEAST)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
HELD = 1 << 17  # words counted in a task before they are passed on
WORD_BITS, MOST_BITS, SEGMENT = 16, 1 << 28, 1 << 18
CELLS = 1 << 18  # candidates at a time
WORDS = 1 << 14  # of a task
LONG = 32  # longer words set and ask more bits, as their wrong candidates would cost more


def probes(size):
    return np.where(np.asarray(size) > LONG, 24, 3)


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 31) -> DataFrame:
    """``word, n``: counts of words in parts of the corpus. Where the hash of id and word divides by ``every``, a letter is left out."""
    rows = docs.select(docs[id_col].cast("string").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in pieces(batches, "text"):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                low = (text or "").encode().translate(LOWER).decode()
                start = zlib.crc32(f"{doc_id or ''}:".encode())
                for word, n in Counter(RUN.findall(low) if len(low) < 1 << 20 else (m[0] for m in RUN.finditer(low))).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= LEAST:
                        held[word] += n
                if len(held) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
                    held = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    return rows.mapInArrow(run, "word string, n long")


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the words of each length and their code points, a row for each word, in blocks."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    lo = 0
    while lo < len(order):
        size = int(sizes[order[lo]])
        hi = min(int(np.searchsorted(sizes[order], size, "right")), lo + max(1, CELLS // size))
        codes = np.frombuffer("".join(words[k] for k in order[lo:hi]).encode("utf-32-le"), np.uint32).astype(np.uint64)
        yield order[lo:hi], codes.reshape(hi - lo, size)
        lo = hi


def _sums(codes: np.ndarray) -> np.ndarray:
    """Running sums of code point times power of the base, one more than there are code points."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    np.cumsum(codes * powers(codes.shape[1] + 2)[0][: codes.shape[1]], axis=1, out=out[:, 1:])
    return out


def _steps(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return h, mix64(h + np.uint64(BASE)) | np.uint64(1)


class Vocabulary:
    """The bits of one hash range of the vocabulary: of all words whose hash is ``nth`` modulo ``passes``."""

    def __init__(self, bits: np.ndarray, nth: int, passes: int) -> None:
        self.bits, self.mask, self.nth, self.passes = bits, np.uint64(len(bits) * 8 - 1), np.uint64(nth), np.uint64(passes)

    def holds(self, sums: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the sums that may be those of words of ``size`` code points."""
        h = mix64(sums)
        live = np.arange(len(h)) if self.passes == 1 else np.flatnonzero((h >> np.uint64(40)) % self.passes == self.nth)
        at, step = h[live], None
        for k in range(int(probes(size))):
            if k == 1:
                step = _steps(h[live])[1]
            if k:
                at = at + step
            place = at & self.mask
            hit = np.flatnonzero(self.bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
            live, at = live[hit], at[hit]
            step = step[hit] if k else None
        return live


def neighbours(words: list[str], alphabet: str, vocabulary: Vocabulary) -> Iterator[tuple[int, str]]:
    """Number of a word and a string one edit away that the vocabulary may hold; each pair once.

    A letter is left out where the one before it differs, and put in where the one after it differs, so that no string is made twice.
    """
    letters = np.frombuffer(alphabet.encode("utf-32-le"), np.uint32).astype(np.uint64)
    base, back = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))
    for numbers, codes in _by_length(words):
        size = codes.shape[1]
        sums, up = _sums(codes), powers(size + 2)[0]
        rows, wide = max(1, CELLS // ((size + 1) * len(letters))), max(1, CELLS // len(letters))
        for r in range(0, len(numbers), rows):
            part, total, own = sums[r : r + rows], sums[r : r + rows, -1:], codes[r : r + rows]
            for lo in range(0, size + 1, wide):
                hi = min(lo + wide, size + 1)
                last = min(hi, size)  # of the places where a code point stands
                if size > LEAST and lo < last:
                    gone = part[:, lo:last] + (total - part[:, lo + 1 : last + 1]) * back
                    fresh = np.ones(gone.shape, bool)
                    fresh[:, 0 if lo else 1 :] = own[:, max(lo, 1) : last] != own[:, max(lo, 1) - 1 : last - 1]
                    at = np.flatnonzero(fresh)
                    for k in at[vocabulary.holds(gone.reshape(-1)[at], size - 1)].tolist():
                        row, i = divmod(k, last - lo)
                        w = words[numbers[r + row]]
                        yield int(numbers[r + row]), w[: lo + i] + w[lo + i + 1 :]
                if lo < last:
                    put = (total - part[:, lo + 1 : last + 1] + part[:, lo:last])[:, :, None] + letters * up[lo:last, None]
                    at = vocabulary.holds(put.reshape(-1), size)
                    row, i, a = np.unravel_index(at, put.shape)
                    new = own[row, lo + i] != letters[a]
                    for row, i, a in zip(row[new].tolist(), i[new].tolist(), a[new].tolist(), strict=True):
                        w = words[numbers[r + row]]
                        yield int(numbers[r + row]), w[: lo + i] + alphabet[a] + w[lo + i + 1 :]
                put = (part[:, lo:hi] + (total - part[:, lo:hi]) * base)[:, :, None] + letters * up[lo:hi, None]
                at = vocabulary.holds(put.reshape(-1), size + 1)
                row, i, a = np.unravel_index(at, put.shape)
                new = (lo + i == size) | (own[row, np.minimum(lo + i, size - 1)] != letters[a])
                for row, i, a in zip(row[new].tolist(), i[new].tolist(), a[new].tolist(), strict=True):
                    w = words[numbers[r + row]]
                    yield int(numbers[r + row]), w[: lo + i] + alphabet[a] + w[lo + i :]


def _bit_set(words: DataFrame, bits: int, nth: int, passes: int) -> Vocabulary:
    """The bit set of one hash range, made in segments by hash; at most ``MOST_BITS`` / 8 bytes reach the driver."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes in _by_length(batch.column(0).to_pylist()):
                h = mix64(_sums(codes)[:, -1])
                at, step = _steps(h[(h >> np.uint64(40)) % np.uint64(passes) == nth])
                place = (at[:, None] + step[:, None] * np.arange(int(probes(codes.shape[1])), dtype=np.uint64)).reshape(-1) & np.uint64(bits - 1)
                place = np.unique(place).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((place // SEGMENT).astype(np.int32)), pa.array((place % SEGMENT).astype(np.int32))], ["segment", "place"])

    def packed(part: pa.Table) -> pa.Table:
        held = np.zeros(SEGMENT, bool)
        held[part["place"].to_numpy()] = True
        return pa.Table.from_arrays([pa.array([part["segment"][0].as_py()], pa.int32()), pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())], ["segment", "bits"])

    out = np.zeros(bits // 8, np.uint8)
    for row in words.select("word").mapInArrow(places, "segment int, place int").groupBy("segment").applyInArrow(packed, "segment int, bits binary").collect():
        out[row.segment * SEGMENT // 8 : (row.segment + 1) * SEGMENT // 8] = np.frombuffer(row.bits, np.uint8)
    return Vocabulary(out, nth, passes)


def candidates(words: DataFrame, alphabet: str, vocabulary: Vocabulary) -> DataFrame:
    """``candidate, word, n``: strings one edit away from a word of ``words (word, n)`` that the vocabulary may hold."""
    held = words.sparkSession.sparkContext.broadcast((vocabulary.bits.tobytes(), int(vocabulary.nth), int(vocabulary.passes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, nth, passes = held.value
        known = Vocabulary(np.frombuffer(raw, np.uint8), nth, passes)
        for batch in pieces(batches, "word", 1 << 18):
            own, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            near: list[str] = []
            at: list[int] = []
            room = 0
            for k, candidate in neighbours(own, alphabet, known):
                near.append(candidate)
                at.append(k)
                room += len(candidate)
                if room > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(near, pa.string()), pa.array([own[k] for k in at], pa.string()), pa.array([n[k] for k in at], pa.int64())], ["candidate", "word", "n"])
                    near, at, room = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string()), pa.array([own[k] for k in at], pa.string()), pa.array([n[k] for k in at], pa.int64())], ["candidate", "word", "n"])

    return words.mapInArrow(run, "candidate string, word string, n long")


def _alphabet(words: DataFrame) -> str:
    """All letters of the vocabulary, of which the pattern allows fewer than a hundred."""

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            seen.update(*batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.string())], ["letter"])

    return "".join(sorted(r.letter for r in words.select("word").mapInArrow(letters, "letter string").distinct().collect()))


def _bits_of(word: Column) -> Column:
    return F.when(F.length(word) > LONG, 24).otherwise(3)


def links(words: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``word, n, near, near_n``: every word of ``words (word, n)`` with every word one edit away."""
    size = words.agg(F.count("*").alias("n"), F.coalesce(F.sum(_bits_of(F.col("word"))), F.lit(0)).alias("bits")).first()
    room = max(SEGMENT, size.bits * WORD_BITS // 3)
    bits = min(most_bits, 1 << (room - 1).bit_length())
    passes = -(-room // (2 * bits))
    alphabet = _alphabet(words)
    spread = words.repartition(-(-size.n // WORDS) or 1, "word")
    out = None
    for nth in range(passes):
        found = candidates(spread, alphabet, _bit_set(words, bits, nth, passes))
        out = found if out is None else out.unionByName(found)
    near = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return out.join(near, out.candidate == near.near).select("word", "n", "near", "near_n")


def roots(forms: DataFrame, least: int, most: int, factor: int) -> DataFrame:
    """``word, root``: the last form that ``forms (word, form)`` lead to.

    Counts grow from ``least`` to ``most`` by ``factor`` with each step, so no way is longer than that allows; each round doubles what is behind.
    """
    out, way = forms.select("word", F.col("form").alias("root")), 1
    while least * factor ** (way + 1) <= most:
        ahead = out.select(F.col("word").alias("root"), F.col("root").alias("next"))
        out = cut(out.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
        way *= 2
    return out


def variants(docs: DataFrame, least_count: int = 2, factor: int = 10, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the corpus.

    A word's form is its near word of largest count, ties by code points, if that is ``factor`` times its own or more.
    """
    if factor < 2:
        raise ValueError("the factor is 2 at least, so that forms lead to an end")
    scratch = Scratch(docs.sparkSession)
    words = scratch.table(counted(docs, id_col, text_col).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))
    none = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near")))
    each = links(words, most_bits).unionByName(none).groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    formed = -F.col("best.less") >= factor * F.col("n")
    each = cut(each.select("word", "n", "n_near", F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")))
    scratch.clear()
    last = roots(each.where("form is not null"), least_count, each.agg(F.max("n")).first()[0] or 0, factor)
    return each.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
