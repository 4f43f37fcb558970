"""Runs of words, spelling variants and exact copies against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import exact, periodic, spelling

ODD = [None, "", " \n\t", "é", "🙂 token", "x" * 100_000]
CLASHING = "doc_id long, text string, n long, word string, digest string, bucket int, locator long, h long, row_number_ int, rows long, past string"


def docs_of(spark, rows, kind="doc_id long, text string"):
    return spark.createDataFrame(rows, kind).repartition(3)


def odd_docs(spark, texts):
    """Clashing columns, null ids and texts, repeated rows, an id with several texts."""
    rows = list(enumerate(texts)) + [(3, texts[3])] * 3 + [(4, texts[5] + " zz"), (None, texts[0]), (None, None), (None, texts[0])] + [(900 + k, t) for k, t in enumerate(ODD)]
    return rows, docs_of(spark, [(*r, 1, "w", "d", 2, 3, 4, 5, 6, "p") for r in rows], CLASHING)


def periodic_texts():
    rng = random.Random(11)
    texts = []
    for k in range(90):
        words = [rng.choice("abcdefgh"[: 2 + k % 7]) for _ in range(rng.randint(0, 60))]
        for _ in range(k % 4):
            at, q = rng.randint(0, len(words)), rng.randint(1, 9)
            words[at:at] = [rng.choice("abxyz") for _ in range(q)] * rng.randint(2, 15)
        texts.append(rng.choice([" ", "\n", "\t \r\n"]).join(words) + rng.choice(["", " "]))
    return texts


def test_runs(spark):
    rows, docs = odd_docs(spark, periodic_texts())
    rows += [(zlib_multiple(10, k), " ".join(f"w{j}" for j in range(k))) for k in range(1, 60, 3)]
    docs = docs_of(spark, rows)
    got = Counter(map(tuple, periodic.periodic_runs(docs).collect()))
    assert got == Counter(plain.runs_row(i, t) for i, t in rows)
    assert sum(r[1] for r in got) > 100
    for table in (odd_docs(spark, periodic_texts())[1], docs.limit(0)):
        assert periodic.periodic_runs(table).count() == table.count()
    texts = periodic_texts()
    got = {r.doc_id: r.n_runs for r in periodic.periodic_runs(docs_of(spark, list(enumerate(texts))), rewrite=False).collect()}
    assert got == {k: len(plain.periodic(plain.WORD.findall(t))) for k, t in enumerate(texts)}


def zlib_multiple(k, skip):
    """An id from 10 000 whose hash divides by ``k``."""
    return [i for i in range(10_000, 12_000) if zlib.crc32(str(i).encode()) % k == 0][skip]


def laid_out(texts):
    data, at = periodic.text_buffer(pa.array(texts))
    starts, ends, rows = periodic.word_spans(data, at)
    return data, starts, ends, np.bincount(rows, minlength=len(texts))


@pytest.mark.parametrize("chunk", [7, 1000, 1 << 20])
def test_runs_in_chunks(monkeypatch, chunk):
    monkeypatch.setattr(periodic, "PAIRS", chunk)
    texts = [t for t in periodic_texts() if t.strip()]
    data, starts, ends, counts = laid_out(texts)
    found = periodic.runs(data, starts, ends, counts)
    want, first = [], 0
    for t in texts:
        words = plain.WORD.findall(t)
        want += [(first + s, first + s + n, q) for s, n, q in plain.periodic(words)]
        first += len(words)
    assert sorted(map(tuple, found.tolist())) == sorted(want)


def test_runs_where_hashes_deceive(monkeypatch):
    """Words of equal hash, and a sequence whose halves agree modulo 2^64 for every base, are told apart by the words."""
    texts = ["a b c " * 9 + "a b d e", " ".join("xy"[k % 2] for k in range(40))]
    data, starts, ends, counts = laid_out(texts)
    right = periodic.runs(data, starts, ends, counts)
    monkeypatch.setattr(periodic, "span_hashes", lambda data, starts, ends: np.ones(len(starts), np.uint64))
    assert (periodic.runs(data, starts, ends, counts) == right).all()
    monkeypatch.undo()
    n = 1 << 13
    morse = ["ab"[bin(k).count("1") % 2] for k in range(n)]
    words = morse + ["ab"[x == "a"] for x in morse]
    data, starts, ends, counts = laid_out([" ".join(words)])
    found = periodic.runs(data, starts, ends, counts)
    assert periodic.verified(found, data, starts, ends)
    for seed in (1, 2):
        values = periodic.mix64(np.array([ord(w) for w in words], np.uint64))
        assert (periodic.search(values, counts, seed) == found).all()
    for s, e, q in found.tolist():
        assert all(words[j] == words[j + q] for j in range(s, e - q)) and (s == 0 or words[s - 1] != words[s - 1 + q]) and (e == len(words) or words[e] != words[e - q])


def test_long_runs(spark):
    rng = random.Random(5)
    base = [rng.choice(["lorem", "ipsum", "é", "dolor"]) for _ in range(50_000)]
    words = base + base[:30_000] + ["end"] + ["same"] * 60_000
    one = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10)
    r = periodic.periodic_runs(docs_of(spark, [(one, " ".join(words))])).first()
    assert (r.start, r.length, r.period, r.exponent_milli) == (80_001, 60_000, 1, 60_000_000)


def spelled(spark):
    rng = random.Random(3)
    stems = ["anderen", "elleèque", "lettres", "wortlich", "aaaaaaaa", "öffnungen", "x" * 40]
    words = [s for s in stems for _ in range(60)]
    for s in stems:
        for _ in range(25):
            w = list(s)
            for _ in range(rng.randint(1, 2)):
                k = rng.randrange(len(w))
                rng.choice([lambda: w.insert(k, rng.choice("abé÷")), lambda: w.pop(k), lambda: w.__setitem__(k, rng.choice("abze"))])()
            words += ["".join(w)] * rng.choice([1, 2, 2, 6])
    words += ["kettenwort"] * 500 + ["kettenworte"] * 35 + ["kettenworter"] * 2
    rng.shuffle(words)
    return [" ".join(w.title() if rng.random() < 0.2 else w for w in words[k : k + 9]) + rng.choice([".", "1", "\n"]) for k in range(0, len(words), 9)]


@pytest.mark.parametrize("bits", [spelling.MOST_BITS, 1 << 10])
def test_spelling(spark, monkeypatch, bits):
    if bits < spelling.SEGMENT:  # several passes, small blocks and chunks
        for name, value in (("SEGMENT", 1 << 9), ("CELLS", 64), ("WORDS", 50)):
            monkeypatch.setattr(spelling, name, value)
    rows, docs = odd_docs(spark, spelled(spark))
    got = spelling.variants(docs, most_bits=bits).collect()
    want = plain.spelling(rows)
    assert len(got) == len(want) and {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert sum(v[0] is not None for v in want.values()) > 20 and any(v[0] != v[1] for v in want.values() if v[0])
    assert spelling.variants(docs.limit(0)).count() == 0


def test_whole_neighbourhood():
    """With a set that holds everything, all strings one edit away come, each once."""
    every = spelling.Vocabulary(np.full(8, 255, np.uint8), 0, 1)
    words = ["aaaaaaab", "abcabcabc", "é" * 7, "b" * 45]
    alphabet = "abcé"
    got = list(spelling.neighbours(words, alphabet, every))
    assert len(got) == len(set(got))
    for k, w in enumerate(words):
        assert {c for j, c in got if j == k} == {c for c in plain.edits(w, alphabet) if len(c) >= spelling.LEAST}


def test_set_of_long_words():
    """Only near words of a very long word become strings."""
    rng = random.Random(9)
    word = "".join(rng.choice("abcdefghij") for _ in range(20_000))
    other = word[:777] + word[778:]
    bits = np.zeros(1 << 17, np.uint8)
    sums = spelling._sums(np.array([[ord(c) for c in other]], np.uint64))[:, -1]
    at, step = spelling._steps(spelling.mix64(sums))
    for k in range(24):
        p = int((at + step * np.uint64(k))[0]) & (len(bits) * 8 - 1)
        bits[p >> 3] |= 1 << (p & 7)
    assert list(spelling.neighbours([word], "abcdefghij", spelling.Vocabulary(bits, 0, 1))) == [(0, other)]


def test_roots(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(11)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string"), 2, 2 * 10**11, 10).collect()}
    assert got == {w: "w11" for w, _ in chain}


def copies(spark):
    rng = random.Random(2)
    texts = [plain.prose(rng, rng.randint(0, 12)) for _ in range(60)]
    out = []
    for k in range(400):
        t = texts[int(60 * rng.random() ** 3)]
        out.append(t.replace(" ", rng.choice([" ", "", "\n", "  ", "\t\x0b\x0c\r"])) if k % 2 else t)
    return out + [" ", "  ", " "]


def test_exact(spark):
    rows, docs = odd_docs(spark, copies(spark))
    want = plain.exact(rows)
    got = [tuple(r) for r in exact.exact_duplicates(docs).collect()]
    assert Counter(got) == Counter(want)
    kept = exact.without_repeats(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) <= Counter(rows) and kept.count() == sum(w[3] for w in want)
    for out in (exact.exact_duplicates(docs.limit(0)), exact.without_repeats(docs.limit(0))):
        assert out.count() == 0


@pytest.mark.parametrize("past", [True, False])
def test_exact_of_one_side(spark, monkeypatch, past):
    """All rows in the past, or none; small ranges; copies that are dealt in parts."""
    monkeypatch.setattr(exact, "half", lambda doc_id: F.lit(past))
    monkeypatch.setattr(exact, "RANGE", 5)
    monkeypatch.setattr(exact, "HEAVY", 20)
    rows, docs = odd_docs(spark, copies(spark))
    assert Counter(tuple(r) for r in exact.exact_duplicates(docs).collect()) == Counter(plain.exact(rows))


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3000):
        keys = rng.integers(0, 1 << 63, (n, 4)).astype(np.uint64)
        keys[:, :3] = 7  # keys that differ in one place only
        perfect = exact.PerfectHash.build(keys)
        assert sorted(perfect.slots(keys).tolist()) == list(range(n))
        others = perfect.slots(rng.integers(0, 1 << 63, (500, 4)).astype(np.uint64))
        assert others.max(initial=-1) < n


def test_vectors_of_any_length(spark):
    """Lengths whose squares a double does not hold change no cosine."""
    from corpusloom.llm import embeddings

    rows = [(1, [1e200, 1e200]), (2, [1.0, 1.01]), (3, [1e-300, 1.02e-300]), (4, [1e308, -1e308]), (5, [5e-324, -5e-324]), (6, [0.0, 1e-320])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6)}
