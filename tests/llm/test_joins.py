"""Near-duplicate operators against brute force."""

import random

import numpy as np
import plain
import pyarrow as pa
import pytest

from corpusloom.llm import blocks, embeddings, jaccard, rindex, substrings
from corpusloom.llm.common import connected_components, text_buffer


def documents(spark, rows, kind="doc_id long, text string"):
    return spark.createDataFrame(rows, kind).repartition(3)


def corpus(seed=5):
    rng = random.Random(seed)
    line = plain.prose(rng, 30)
    rows, base = [], plain.prose(rng, 80)
    for k in range(12):  # a group of near copies
        w = base.split()
        w[rng.randrange(len(w))] = f"x{k}"
        rows.append(" ".join(w))
    rows += [base.upper()] * 5 + ["", None, " \t\n", "a b", "A  B", "one"]
    rows += [line + " " + plain.prose(rng, n) for n in (1, 3, 8, 9, 10, 11, 40, 200)]
    rows += [plain.prose(rng, 60) for _ in range(10)]
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(200 + k, 201 + k) for k in range(40)]
    pairs = [(a, b) for a, b in pairs if a != b]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == plain.components(pairs, {v for p in pairs for v in p})
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", [5, 6])
def test_jaccard(spark, seed):
    rows = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(documents(spark, rows)).collect()}
    assert got == plain.jaccard_components(rows)


def test_jaccard_small_batches(spark):
    """Runs of equal tokens that reach over Arrow batches."""
    rows = corpus(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(documents(spark, rows)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain.jaccard_components(rows)


def test_jaccard_odd_tables(spark):
    assert jaccard.components(documents(spark, [])).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "z"), (2, None)]
    got = sorted(((r.doc_id, r.component_id) for r in jaccard.components(documents(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (None, 1), (None, None), (2, 2)], key=str)
    docs = documents(spark, [(1, "a b c d e f", 9), (3, "a b c d e f", 8), (None, "q", 7)], "doc_id long, text string, component_id int")
    assert sorted((r.doc_id or 0, r.component_id) for r in jaccard.one_of_each(docs).collect()) == [(0, 7), (1, 9)]


def test_jaccard_null_ids(spark):
    """Sets that only rows without an id hold link near copies, and bridge groups, beside ids beyond 2^53."""
    words = [f"w{k}" for k in range(64)]
    middle = words[:56]
    texts = {2**53 + 1: words[:48], 2**53 + 3: middle + ["tail", "end"], None: middle, 2**60 + 7: words[8:56], 7: [f"v{k}" for k in range(20)]}
    rows = [(i, " ".join(w)) for i, w in texts.items()]
    label = plain.jaccard_components([(i or -1, t) for i, t in rows])
    assert [label[i or -1][1] for i in texts] == [-1, -1, -1, -1, 7]
    got = {r.doc_id: r.component_id for r in jaccard.components(documents(spark, rows)).collect()}
    assert got == {i: 7 if i == 7 else 2**53 + 1 for i in texts}
    assert {r.doc_id for r in jaccard.one_of_each(documents(spark, rows)).collect()} == {None, 7, 2**53 + 1}


def test_one_of_each_shared_ids(spark):
    """Unlike texts of one id both stay; of like ones the same stays whatever the partitions."""
    rows = [(1, "a b c d e f", "x"), (1, "A B c d e f", "y"), (1, "a b c d e f", "z"), (1, "q r s t u v", "x"), (2, "q r s t u v", "x"), (3, None, "x"), (3, "", "x")]
    seen = set()
    for n in (1, 2, 5):
        out = jaccard.one_of_each(documents(spark, rows, "doc_id long, text string, source string").repartition(n)).collect()
        assert sorted((r.doc_id, (r.text or "").lower()) for r in out) == [(1, "a b c d e f"), (1, "q r s t u v"), (3, "")]
        seen.add(frozenset(map(tuple, out)))
    assert len(seen) == 1


def test_jaccard_long_texts():
    """Texts hashed in parts, with words and shingles across their ends, have the sets of texts hashed at once."""
    rng = random.Random(8)
    texts = [" ".join("x" * rng.randint(1, 40) + str(rng.randrange(9)) for _ in range(n)) for n in (0, 1, 3, 4, 5, 6, 60, 300)] + ["y" * 700, "  a b" + " " * 500 + "c d e f"]
    data, at = text_buffer(pa.array(texts))
    whole = jaccard.shingle_sets(data, at)
    for most in (1, 7, 64, 200, 1000):
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(whole, jaccard.shingle_sets(data, at, most), strict=True))


@pytest.mark.parametrize("most", [3, 12])
def test_jaccard_cut_clusters(spark, most):
    """Clusters larger than one task takes lose no link, whatever their components."""
    rng = random.Random(21)
    rows = []
    for g in range(3):
        base = plain.prose(rng, 60).split()
        for k in range(25):
            w = list(base)
            for at in rng.sample(range(60), 1 + k % 3):
                w[at] = f"z{rng.randrange(5)}"
            rows.append((100 * g + k, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(documents(spark, rows), most=most).collect()}
    assert got == plain.jaccard_components(rows)


def test_levels_grow_with_counts():
    counts = np.arange(1, 5000)
    assert (np.diff(blocks.level(counts).astype(int)) >= 0).all() and (blocks.COUNTS[blocks.level(counts)] <= counts).all()


def test_prefix_rule():
    """The matches asked for never exceed the overlap that the threshold guarantees."""
    for n in range(1, 60):
        l, length = jaccard.prefix_of(np.full(n, 50, np.uint8))
        need = -(-3 * n // 4)
        assert 1 <= l <= need and length == n - need + l <= n


def test_run_index():
    rng = random.Random(3)
    for _ in range(60):
        width = rng.choice([8, 9, 12, 16, 20])
        base = "".join(rng.choice("ab") for _ in range(60))
        strings = []
        for _ in range(rng.randint(1, 10)):
            a = rng.randint(0, 40)
            s = list(base[a : a + rng.randint(1, 45)])
            s[rng.randrange(len(s))] = rng.choice("ab")
            strings.append("".join(s).encode())
        owners = np.sort(np.array([rng.randint(0, 6) for _ in strings]))
        index = rindex.RunIndex.build(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]), owners, width)
        got = set(zip(*(x.tolist() for x in index.statistics()), strict=True))
        assert got == {(j, p) for j, s in enumerate(strings) for p in range(len(s) - width + 1) if any(owners[i] < owners[j] and s[p : p + width] in t for i, t in enumerate(strings))}


def substring_rows(seed):
    rng = random.Random(seed)
    passage, other = plain.prose(rng, 40), "é" * 70 + "ünï" * 30
    rows = []
    for k in range(40):
        text = plain.prose(rng, rng.randint(0, 60))
        if k % 3 == 0:
            a = rng.randint(0, 100)
            text = text[:80] + passage[a : a + rng.randint(30, 200)] + text[80:]
        if k % 5 == 0:
            text += other[rng.randint(0, 50) :]
        if k % 7 == 0:
            text = "ab" * rng.randint(20, 150) + text
        rows.append((k % 33, text))
    return [*rows, (None, passage), (50, None), (51, ""), (52, passage[:49]), (53, passage[:50]), (7, rows[7][1])]


@pytest.mark.parametrize("hot", [1024, 0])
def test_substrings(spark, hot, monkeypatch):
    rows = substring_rows(11)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.repeated(documents(spark, rows), hot=hot).collect()), key=str)
    assert got == sorted(plain.removed(rows), key=str)


def test_substrings_odd_tables(spark):
    assert substrings.repeated(documents(spark, [])).count() == 0
    long = "word " * 30_000
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in substrings.repeated(documents(spark, [(1, long, "x"), (2, long, "y")], "doc_id long, text string, n_bytes string")).collect()}
    assert got == {1: (0, 0), 2: (len(long), 1)}


@pytest.mark.parametrize("part", [60, 97])
def test_substrings_in_parts(spark, part):
    """Texts that come in parts, searched in many ranges, lose what they lose in one piece."""
    rows = substring_rows(12)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.repeated(documents(spark, rows), part=part, range_bytes=500).collect()), key=str)
    assert got == sorted(plain.removed(rows), key=str)


def test_substrings_long_text(spark):
    """One text of 20 MB, and a passage in more blocks than ``hot``."""
    rng = np.random.default_rng(5)
    passage = bytes(rng.integers(97, 123, 400, np.uint8)).decode()
    long = bytes(rng.integers(97, 123, 20 << 20, np.uint8)).decode()
    rows = [(1, passage), (2, long[:700_000] + passage + long[700_000:]), (3, long[5_000_000:7_000_000]), (4, passage[50:]), (5, passage)]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in substrings.repeated(documents(spark, rows), hot=1).collect()}
    assert got == {1: (0, 0), 2: (400, 1), 3: (2_000_000, 1), 4: (350, 1), 5: (400, 1)}


def test_substring_ranges_are_even():
    """No range gets much more than its share, and a block sends all its ranges in one batch."""
    rng = np.random.default_rng(6)
    data = rng.integers(97, 123, 1 << 20, np.uint8)
    at = np.array([0, 1 << 19, 1 << 20])
    start, size, anchor = substrings.segments(data, at, np.ones(2, bool))
    per = np.bincount(blocks.range_of(anchor, 6), minlength=64)
    assert size.sum() == 2 * ((1 << 19) - 49) and per.max() < 2 * per.mean()

    class Rows:
        def mapInArrow(self, run, schema):
            self.run = run

    row = {"block": 7, "ids": np.array([1, 2]).tobytes(), "known": np.ones(2, bool).tobytes(), "keys": np.full(2, -1).tobytes(), "offsets": np.zeros(2, np.int64).tobytes()}
    row |= {"sizes": np.diff(at).tobytes(), "bytes": len(data), "text": blocks.squeezed(data)}
    row["levels"] = [{"bucket": 0, "levels": blocks.squeezed(np.full(len(np.unique(anchor)), 2, np.uint8))}]
    rows = Rows()
    substrings._send_segments(rows, 6, substrings.HOT)
    sent = list(rows.run(iter([pa.RecordBatch.from_pylist([row])])))
    assert [b.num_rows for b in sent] == [64]


def test_related_strings_lose_no_match():
    """Strings that share a window with one of another owner are all kept for the index; most that share no more than the gram are not."""
    rng = random.Random(8)
    grams = ["".join(rng.choice("abcdefgh") for _ in range(24)) for _ in range(12)] + ["a" * 24, "ab" * 12]
    windows, strings, owners = {}, [], []
    for k in range(600):
        left, right = ("".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(2))
        if k > 200 and k % 3:
            s = rng.choice(strings)
            cut = rng.randint(0, 20)
            strings.append(s[: len(s) - cut] + right[:cut] if k % 2 else left[:cut] + s[cut:])
        else:
            strings.append(left[: rng.randint(10, 40)] + rng.choice(grams) + right[: rng.randint(16, 40)])
        owners.append(rng.randint(0, 300))
    owners = np.array(owners)
    for j, s in enumerate(strings):
        for p in range(len(s) - 49):
            windows.setdefault(s[p : p + 50], set()).add(j)
    raw = [s.encode() for s in strings]
    low = [int(substrings._sums(np.frombuffer(r, np.uint8), substrings.GRAM).min()) for r in raw]
    want = set()
    for w, found in windows.items():  # a segment's windows all hold its smallest gram
        found = {j for j in found if low[j] == int(substrings._sums(np.frombuffer(w.encode(), np.uint8), substrings.GRAM).min())}
        want |= found if len({int(owners[j]) for j in found}) > 1 else set()
    kept = substrings.related(np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw]), owners)
    assert len(want) > 50 and want <= set(np.flatnonzero(kept).tolist()) and not kept.all()


def test_equals_where_words_deceive():
    """Pairs that agree in the high bits of the first word, or in all of it, are told apart."""
    rng = np.random.default_rng(3)
    first = (rng.integers(0, 3, 500).astype(np.uint64) << np.uint64(60)) | rng.integers(0, 3, 500).astype(np.uint64)
    second = rng.integers(0, 2, 500).astype(np.uint64)
    order, heads = substrings.equals(first, second)
    groups = [{(int(first[k]), int(second[k])) for k in part} for part in np.split(order, heads[1:])]
    assert all(len(g) == 1 for g in groups) and len(groups) == len(set.union(*groups)) == 18


def vector_table(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<float>, label int").repartition(3)


def plain_vectors(vectors, threshold=0.95):
    ok = [(i, np.array(v, float)) for i, v in vectors if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    pairs, links = [], {i: 0 for i, _ in vectors}
    for k, (a, x) in enumerate(ok):
        for b, y in ok[k + 1 :]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                pairs.append((a, b))
                links[a] += 1
                links[b] += 1
    label = plain.components(pairs, [i for i, _ in vectors])
    return {i: (links[i], label[i], label[i] == i) for i, _ in vectors}


def test_embeddings(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(4, 16))
    vectors = [rng.normal(size=16) for _ in range(60)] + [c + 0.15 * rng.normal(size=16) for c in centre for _ in range(12)] + [centre[0]] * 9 + [3 * centre[0]]
    vectors = [(k, np.float32(v).tolist()) for k, v in enumerate(vectors)]
    vectors += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [float("inf")] + [1.0] * 15), (904, [1.0, None]), (905, [1.0, 0.0]), (906, [2.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(vector_table(spark, vectors)).collect()}
    assert got == plain_vectors(vectors)
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    nodes = embeddings.near_duplicates(vector_table(spark, []))
    assert nodes.count() == 0


def test_interval_pairs_keep_all_that_are_near(spark):
    rng = np.random.default_rng(4)
    low = np.sort(rng.normal(size=70))
    blocks = spark.createDataFrame([(k, [float(x), 0.0], [float(x) + 0.01, 0.1]) for k, x in enumerate(low)], "at long, low array<double>, high array<double>")
    got = {(r.a, r.b) for r in embeddings._interval_pairs(blocks, 0.1).collect()}
    want = {(a, b) for a in range(70) for b in range(a, 70) if low[b] - low[a] - 0.01 <= 0.1}
    assert want <= got and len(got) < 70 * 71 // 2


def test_jaccard_group_of_many_variants(spark):
    """Near copies that are no more like each other than like the original: further leaders join them, none is lost."""
    rng = random.Random(9)
    base, rows = plain.prose(rng, 90).split(), []
    for k in range(70):
        w = list(base)
        for at in rng.sample(range(90), 2 + k % 4):
            w[at] = f"y{rng.randrange(6)}"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, " ".join(base[:60]) + " " + plain.prose(rng, 12 + k)) for k in range(20)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(documents(spark, rows)).collect()}
    want = plain.jaccard_components(rows)
    assert got == want and len({c for _, c in want.values()}) > 1
