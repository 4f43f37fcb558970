"""Operators on single documents, mixtures and shards against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import plain
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import decontamination, language, mixing, quality, secrets, sharding, toxicity
from corpusloom.llm.common import heavy_join

ODD = [None, "", " \n", "é", "🙂 token", "x" * 200_000]


def docs_of(spark, rows, kind="doc_id long, text string, lang string, source string"):
    return spark.createDataFrame(rows, kind).repartition(3)


def spoiled(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        k = rng.randrange(len(out))
        rng.choice([lambda: out.__setitem__(k, "q"), lambda: out.insert(k, "q"), lambda: out.pop(k)])()
    return "".join(out)


def leak_tables(spark, seed=1):
    rng = random.Random(seed)
    items = [plain.prose(rng, n) for n in (8, 12, 20, 40)] + ["tiny", None, plain.prose(rng, 30).title()]
    rows = []
    for k in range(24):
        text = plain.prose(rng, rng.randint(0, 40))
        item = items[k % 4]
        if k % 2:
            text += "  " + spoiled(rng, item, k // 4).upper() + "!\n" + plain.prose(rng, 5)
        rows.append((k, text, "en", "s"))
    rows += [(100 + k, t, "en", None) for k, t in enumerate(ODD)]
    bench = spark.createDataFrame(list(enumerate(items)) + [(None, items[3])], "item_id long, text string")
    return rows, items, docs_of(spark, rows), bench


def test_leaks(spark):
    rows, items, docs, bench = leak_tables(spark)
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()}
    index = decontamination.Index.of(items)
    want = set()
    for i, t, *_ in rows:
        data, at = decontamination.text_buffer(decontamination.pa.array([t or ""]))
        folded = bytes(decontamination.fold(data, at)[0])
        if len(folded) > 10_000:
            continue
        for w in range(len(index.begins)):
            window = bytes(index.text[index.begins[w] : index.begins[w] + index.sizes[w]])
            if plain.best_edits(window, folded) <= decontamination.budget(index.sizes[w]):
                want.add((i, int(index.items[w])))
    assert {p for p in got if p[1] is not None} == want
    assert {i for i, j in got if j is None} == {i for i, j in want if j == 3}
    kept = {r.doc_id for r in decontamination.without_leaks(docs, bench).collect()}
    assert kept == {r[0] for r in rows} - {i for i, _ in want}


def test_leaks_in_blocks_and_empty(spark):
    rows, _, docs, bench = leak_tables(spark, 2)
    one = {tuple(r) for r in decontamination.leaks(docs, bench).collect()}
    assert one == {tuple(r) for r in decontamination.leaks(docs, bench, block_bytes=300).collect()}
    kept = {r.doc_id for r in decontamination.without_leaks(docs, bench, block_bytes=300).collect()}
    assert kept == {r[0] for r in rows} - {r[0] for r in one}
    again = decontamination.leaks(docs, bench.union(bench)).collect()  # equal items are reported each
    assert len(again) == 2 * len(one) and {tuple(r) for r in again} == one
    assert decontamination.leaks(docs, bench.limit(0)).count() == 0
    assert decontamination.without_leaks(docs, bench.limit(0)).count() == len(rows)
    assert decontamination.leaks(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("size", range(24, 81))
def test_spread_edits_of_every_length(size):
    """A window within its budget is found wherever its edits stand."""
    rng = random.Random(size)
    item = plain.prose(rng, 40).replace(" ", "")[:size]
    index = decontamination.Index.of([item])
    k = int(decontamination.budget(index.sizes[:1])[0])
    for _ in range(6):
        text = list(item)
        for n in range(k):  # evenly, where they spoil most q-grams, with some jitter
            text[min(size - 1, (n + 1) * size // (k + 1) + rng.randrange(-1, 2))] = "0"
        data, at = decontamination.text_buffer(decontamination.pa.array(["zz " + "".join(text) + " yy"]))
        assert {i for _, i, *_ in decontamination.regions(index, data, at)} == {0}


def test_leak_in_a_long_text(spark):
    rng = random.Random(8)
    item = plain.prose(rng, 30)
    text = plain.prose(random.Random(9), 450_000)
    mid = decontamination.PART - 60
    docs = docs_of(spark, [(1, text[:mid] + " " + item + " " + text[mid:], "en", "s")])
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    r = decontamination.leaks(docs, bench).first()
    assert (r.item_id, r.start, r.end, r.edits) == (5, mid + 1, mid + 1 + len(item), 0)


def test_short_items(spark):
    """Items of 12 to 23 folded bytes leak where they stand between words, shorter ones where a text is nothing else."""
    items = ["Gull over pier", "the", "Är du", "river: seventeen stones", "%%", "a gull over"]
    texts = ["see Gull, over -- PIER!", "a seagull over pier", "gull over pierces", "gull over pier", "  THE! ", "the the", "är  DU?", "in the river seventeen stones lie", "river seventeen stonesriver seventeen stones", "x gull over pier gull over piers", "%%", "", None]
    docs = docs_of(spark, [(k, t, "en", "s") for k, t in enumerate(texts)])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.start, r.end, r.edits) for r in decontamination.leaks(docs, bench).collect())
    assert got == [(0, 0, 4, 22, 0), (3, 0, 0, 14, 0), (4, 1, 2, 5, 0), (6, 2, 0, 6, 0), (7, 3, 7, 29, 0), (9, 0, 2, 16, 0)]
    assert {r.doc_id for r in decontamination.without_leaks(docs, bench).collect()} == {1, 2, 5, 8, 10, 11, 12}


@pytest.mark.parametrize("size", [12, 15, 23])
def test_short_items_anywhere(size):
    """Against a plain search for whole words."""
    rng = random.Random(size)
    for _ in range(20):
        item = (plain.prose(rng, 12) + " abcdefgh")[:size].strip().ljust(size, "x")
        texts = [plain.prose(rng, rng.randint(0, 9)) + rng.choice([" ", "", "q"]) + item + rng.choice([" ", "", "q"]) + plain.prose(rng, rng.randint(0, 9)) for _ in range(30)]
        index = decontamination.Index.of([item])
        data, at = decontamination.text_buffer(decontamination.pa.array(texts))
        want = {k for k, t in enumerate(texts) if f" {item} " in f" {' '.join(t.split())} "}
        assert {r for r, *_ in decontamination.regions(index, data, at)} == want


def test_repeated_ids_of_examples(spark):
    """Of several texts of an id one is the example, whatever the order of the rows, and long texts are examples too."""
    from corpusloom.llm import training

    rows = [(1, f"text {k}", "en", "s") for k in range(50)] + [(2, "word " * 20_000, "en", "s"), (3, None, "en", "s")]
    ids = spark.createDataFrame([(1, 7), (2, 8), (3, 9), (4, 9)], "drawn_id long, y int")
    found = [sorted(map(tuple, training.texts_of(docs_of(spark, some), ids, "doc_id", "text").select("drawn_id", "text", "y").collect())) for some in (rows, rows[::-1])]
    assert found[0] == found[1] and [(r[0], len(r[1]) > 9000, r[2]) for r in found[0]] == [(1, False, 7), (2, True, 8)]
    mixed = [(k % 9, plain.prose(random.Random(k), 20), "ab"[k % 2], "s") for k in range(60)]
    made = [language.dictionaries(docs_of(spark, some), passages=4) for some in (mixed, mixed[::-1])]
    assert made[0] == made[1] and set(made[0]) == {"a", "b"}


def test_held_out_labels_are_not_read(spark):
    rows, docs, labels = labelled(spark, 5)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic"))).withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    some, other = (toxicity.score_toxicity(docs, toxicity.trained(docs, y)) for y in (labels, turned))
    assert sorted(map(tuple, some.collect()), key=str) == sorted(map(tuple, other.collect()), key=str)


def labelled(spark, seed=0, n=400):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        text, toxic, good = plain.prose(rng, rng.randint(30, 80)), k % 5 == 0, k % 7 != 0
        if toxic:
            words = text.split()
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["nastyword", "vileness", "scornful"]))
            text = " ".join(words)
        if not good:
            text = " ".join(w + "%%" for w in text.split())
        rows.append((k, text, "en", "s"))
        if k % 3:
            labels.append((k, int(good), int(toxic)))
    rows += [(1000 + k, t, None, None) for k, t in enumerate(ODD)]
    labels += [(5000, 1, 1), (None, 1, 0), (7, None, None)]
    return rows, docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    rows, docs, labels = labelled(spark)
    chain = toxicity.trained(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, chain).collect()}
    assert len(got) == len(rows)
    wrong = [k for k in range(400) if k % 3 == 0 and got[k].is_toxic != (k % 5 == 0)]
    assert len(wrong) <= 4
    assert all(0 <= r.p_toxic <= 1 and 0 <= r.p_degraded <= 1 for r in got.values())
    kept = {r.doc_id for r in toxicity.without_toxic(docs, chain).collect()}
    assert kept == {i for i, r in got.items() if not r.is_toxic}
    assert len(chain.links[1].weights) == len(chain.links[1].features.chosen) + 2  # the probability of the first category, and the intercept
    none = toxicity.trained(docs.limit(0), labels)
    assert toxicity.score_toxicity(docs, none).count() == len(rows) and toxicity.score_toxicity(docs.limit(0), chain).count() == 0


def test_quality(spark):
    rows, docs, labels = labelled(spark, 3)
    model = quality.trained(docs, labels)
    got = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    assert len(got) == len(rows)
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k in range(400))
    right = sum(got[k].predicted == int(k % 7 != 0) for k in held)
    assert right >= 0.85 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    blank = quality.trained(docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(docs, blank).collect()} == {0.5}


def test_parts_of_a_long_text_add_up(monkeypatch):
    from corpusloom.llm import grams

    data, at = grams.joined(["ab cd " * 5000, "x%% y%%", ""])
    features = grams.Features(quality.PAIRS, grams.select(*grams.presence(quality.PAIRS, data, at), y=__import__("numpy").array([1.0, 0, 0]), use=__import__("numpy").ones(3, bool), width=8, least=1))
    whole = features.matrix(data, at), grams.shape(data, at)
    monkeypatch.setattr(grams, "PART", 1000)
    cut = features.matrix(data, at), grams.shape(data, at)
    assert (whole[0] == cut[0]).all() and abs(whole[1] - cut[1]).max() < 0.2


def test_secrets(spark):
    rng = random.Random(4)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in (24, 23, 40)]
    own, shared = "Ab3" * 9, "Zy9" * 10
    texts = [
        f"password = \"{hexes[0]}\" é AKIA{'Q' * 16} {hexes[1]}", "secret:token:abcdefg", "PassWord:'short' api_key=abcdef", "toKen=ſecret1 ſecret=abcdefgh", f"x {own} y", f"🙂 {shared}", f"{shared} z", "AKIA" + "B" * 15, hexes[2] * 3, *ODD,
    ]
    rows = [(k, t, "en", f"o{k % 3}") for k, t in enumerate(texts)] + [(0, texts[0], None, None)]
    got = secrets.digest(secrets.secrets(docs_of(spark, rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        base = plain.base_secrets(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b[0] == k for b in base) for k in ("assign", "access", "hex"))
        shown = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert ",".join(x for x in r.spans.split(",") if x and not x.startswith("mixed")) == shown
    spans = {r.doc_id: r.spans for r in got}
    assert spans[4] == f"mixed:2:{2 + len(own)}" and spans[5] == "" and spans[6] == ""
    owners = {r.owners for r in secrets.ownership(secrets.candidates(docs_of(spark, rows))).collect()}
    assert owners == {1, 2}
    assert secrets.secrets(docs_of(spark, [])).count() == 0


def test_heavy_keys_join_in_parts(spark):
    rows = spark.createDataFrame([(k, 1 if k % 3 else k) for k in range(300)] + [(k, None) for k in range(5)], "id long, key long")
    others = spark.createDataFrame([(k, f"v{k}") for k in range(0, 300, 2)] + [(1, "v1")], "key long, value string")
    for how in ("inner", "left"):
        got = heavy_join(rows, others, "key", F.col("id"), 50, how, 4).select("id", "key", "value").collect()
        assert sorted(map(str, got)) == sorted(map(str, rows.join(others, "key", how).select("id", "key", "value").collect()))


def test_language(spark):
    rng = random.Random(6)
    pieces = {"aa": "the of and ing tion er on", "bb": "der und sch ein heit zu ver", "cc": "que los ción mente ado es"}
    rows = [(k, plain.prose(rng, rng.randint(20, 90), pieces[lang]), lang, "s") for k in range(240) for lang in [list(pieces)[k % 3]]]
    rows += [(1000 + k, t, None, None) for k, t in enumerate([*ODD, "12 %% 34"])]
    docs = docs_of(spark, rows)
    got = {r.doc_id: r for r in language.identify(docs, language.dictionaries(docs)).collect()}
    assert len(got) == len(rows)
    held = [r for r in rows if r[2] and zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(got[i].lang_pred == lang for i, _, lang, _ in held) >= 0.97 * len(held)
    assert [got[1000 + k].lang_pred for k in (0, 1, 2, 6)] == ["und"] * 4 and all(0 <= r.score <= 1 for r in got.values())
    small = language.dictionaries(docs, most_bytes=3 * 4 * 50)
    assert sorted(small) == sorted(pieces) and all(0 < len(d) <= 200 for d in small.values())
    empty = language.dictionaries(docs.limit(0))
    assert empty == {} and {r.lang_pred for r in language.identify(docs, empty).collect()} == {"und"}


def mixture_rows():
    rng = random.Random(7)
    rows = [(k, plain.prose(rng, rng.randint(0, 60)), "en", None if k % 11 == 0 else f"s{min(k % 40, 4)}") for k in range(700)]
    return [*rows, *[(900, "a b c", "en", "s1")] * 40, (901, None, None, "s2"), (None, "x y", "en", "s3"), (902, "", "en", "void")]


def test_mixture(spark):
    rows = mixture_rows()
    docs = docs_of(spark, rows)
    got = mixing.mixture(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(plain.WORD.findall(t or ""))
    target = plain.water_fill(sizes)
    taken, longest = Counter(), Counter()
    for r in got:
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in sizes)
    again = mixing.mixture(docs.repartition(5)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str) and max(map(key, got))
    assert mixing.mixture(docs.limit(0)).count() == 0


def test_targets_of_many_sources(spark):
    rng = random.Random(12)
    sizes = {f"h{k:04}": rng.choice([0, 1, 5, 40, 3000]) * rng.randrange(1, 9) for k in range(500)} | {None: 90_000, "\uffee": 7, "🙂": 7, "é": 7}
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, n long").repartition(5)
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    want = plain.water_fill(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)
    numbers = {r.source: r.nth for r in mixing.numbered(rows, "source").collect()}
    assert [s for s, _ in sorted(numbers.items(), key=lambda x: x[1])] == sorted(sizes, key=lambda s: (s is None, s or "")) and sorted(numbers.values()) == list(range(1, len(sizes) + 1))
    void = mixing.source_targets(spark.createDataFrame([("a", 0, 1), ("b", 0, 2)], rows.schema))
    assert [r.target for r in void.collect()] == [0, 0] and mixing.source_targets(rows.limit(0)).count() == 0


def test_expectation_of_a_copy(spark):
    """Over many seeds a document is taken as often as its source's rate says."""
    docs = docs_of(spark, [(k, "w " * (1 + k % 4), "en", "a" if k % 2 else "b") for k in range(40)])
    total, n = Counter(), 12
    for seed in range(n):
        for r in mixing.mixture(docs, seed=seed).select("doc_id", "copies").collect():
            total[r.doc_id % 2] += r.copies
    sizes = {"b": sum(1 + k % 4 for k in range(0, 40, 2)), "a": sum(1 + k % 4 for k in range(1, 40, 2))}
    target = plain.water_fill(sizes)
    assert abs(total[1] / n / 20 - target["a"] / sizes["a"]) < 0.15 and abs(total[0] / n / 20 - target["b"] / sizes["b"]) < 0.15


def test_mixed_documents(spark):
    rows = mixture_rows()
    docs = docs_of(spark, [(*r, 5) for r in rows], "doc_id long, text string, lang string, source string, size int")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    counts, have = Counter(map(tuple, out.collect())), Counter((*r, 5) for r in rows)
    assert set(counts) <= set(have) and all(n <= 3 * have[r] for r, n in counts.items())


def test_sharding(spark):
    rows = [(k, f"text {k}", "en", "s") for k in range(3000)] + [(5, "text 5", "en", "s")] * 50 + [(None, "n", None, None), (None, None, None, None), (9001, "é", "x", "y")]
    got = sharding.shard_manifest(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        key = sharding.NO_ID if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard) == (plain.jump(key, 16), plain.jump(key, 17))
        assert r.grown_shard in (r.shard, 16) and r.law == "key"
    by = plain.grouped((r.shard, r.slot) for r in got)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) < 1.3 * min(map(len, by.values())) + 60
    one = next(r for r in got if r.doc_id == 9001)
    assert (one.size, one.text_crc32) == (3, zlib.crc32("é".encode()))
    assert sharding.shard_manifest(docs_of(spark, [])).count() == 0
    assert sharding.with_shard(docs_of(spark, rows)).where(F.col("doc_id") == 9001).first().shard == plain.jump(9001, 16)


@pytest.mark.parametrize("key", [0, 1, 2**63 - 1, -1, 12345])
def test_jump(key):
    import numpy as np

    for n in (1, 2, 16, 100):
        assert sharding.jump(np.array([key], np.int64).view(np.uint64), n)[0] == plain.jump(key, n)


#: Columns of documents with names that the operators use themselves, nulls everywhere, repeated rows and shared ids.
CLASHING = "doc_id long, text string, lang string, source string, key long, n long, kept_id long, component long, row_key long, size long, shard int, score double, spans string"


def clashing(spark):
    rng = random.Random(77)
    texts = [plain.prose(rng, 30) for _ in range(30)]
    rows = [(k, t, "en" if k % 2 else None, None if k % 5 == 0 else f"s{k % 3}", 1, 2, 3, None, 5, 6, 7, 0.5, "x") for k, t in enumerate(texts)]
    rows += [rows[3]] * 3 + [(4, texts[9] + " zz", None, None, *[None] * 9), (None, texts[0], None, None, *[None] * 9), (None, None, None, None, *[None] * 9), (77, "", "en", "s1", *[None] * 9)]
    return rows, spark.createDataFrame(rows, CLASHING).repartition(3)


def test_odd_tables(spark):
    """Every operator on clashing columns, repeated rows, null and shared ids, and on no rows at all."""
    from corpusloom.llm import embeddings, jaccard, substrings

    rows, docs = clashing(spark)
    labels = spark.createDataFrame([(k, k % 2, (k // 2) % 2, 1) for k in range(30)] + [(None, None, None, None), (3, 1, 0, 1)], "doc_id long, quality int, toxic int, text int")
    bench = spark.createDataFrame([(1, rows[5][1], 0), (1, rows[5][1], 0), (None, None, None)], "item_id long, text string, doc_id int")
    ids = sorted(str(r[0]) for r in rows)
    for table in (docs, docs.limit(0)):
        n = 0 if table is not docs else len(rows)
        for out in (
            toxicity.score_toxicity(table, toxicity.trained(table, labels)), jaccard.components(table), quality.score_quality(table, quality.trained(table, labels)), secrets.digest(secrets.secrets(table)),
            substrings.repeated(table), mixing.mixture(table), language.identify(table, language.dictionaries(table)), sharding.shard_manifest(table),
        ):
            assert sorted(str(r.doc_id) for r in out.collect()) == (ids if n else [])
        assert {r.doc_id for r in decontamination.leaks(table, bench).collect()} == ({5} if n else set())
        kept = jaccard.one_of_each(table).collect()
        assert len(kept) == (n - 4 if n else 0)  # three copies of a row go, and 9 before the second 4; what shares an id, or has none, stays
        for out in (toxicity.without_toxic(table, toxicity.trained(table, labels)), decontamination.without_leaks(table, bench), mixing.mixed_documents(table), jaccard.one_of_each(table)):
            assert out.columns == docs.columns and {tuple(r) for r in out.collect()} <= set(rows)
    vectors = spark.createDataFrame([(1, [1.0, 0.0], 3, "a"), (1, [1.0, 0.0], 3, "a"), (None, [1.0, 0.0], None, None), (2, None, None, None), (3, [0.0, 1.0], 1, "k")], "vec_id long, embedding array<float>, key int, id string")
    got = sorted(embeddings.near_duplicates(vectors).collect(), key=str)
    assert sorted((r.vec_id or 0, r.n_links, r.kept) for r in got) == [(0, 0, False), (1, 1, True), (1, 1, True), (2, 0, True), (3, 0, True)]
    assert embeddings.near_duplicates(vectors.limit(0)).count() == 0


def test_chain_by_hand():
    """The chain's probabilities from its weights, feature by feature."""
    import numpy as np

    from corpusloom.llm import grams

    texts = ["bad bad words here", "good words here", "", "bad"]
    labels = np.array([[1, 1], [0, 0], [0, np.nan], [1, 1]])
    chain = toxicity.fit_chain(texts * 5, np.tile(labels, (5, 1)), width=16)
    data, at = grams.joined(texts)
    got = chain.probabilities(data, at)
    for row, t in enumerate(texts):
        before = []
        for link in chain.links:
            low = bytes(grams.FOLDED[np.frombuffer(t.encode(), np.uint8)]) if t else b""
            codes = [((int.from_bytes(low[k : k + 5], "big") * 0x9E3779B97F4A7C15) % 2**64) >> (64 - grams.BITS) for k in range(len(low) - 4)]
            x = [np.log1p(codes.count(int(c))) / (1 + np.log1p(len(codes) / 2000)) for c in link.features.chosen]
            before.append(1 / (1 + np.exp(-sum(a * b for a, b in zip([*x, *before, 1.0], link.weights, strict=True)))))
        assert np.allclose(got[row], before)


def test_risk_gradient():
    """The gradient against finite differences of the non-negative risk, on both of its sides."""
    import numpy as np

    rng = np.random.default_rng(5)
    xp, xu = np.c_[rng.normal(1, 1, (9, 3)), np.ones(9)], np.c_[rng.normal(0, 1, (11, 3)), np.ones(11)]
    for prior in (0.1, 0.9):
        gradient = quality.risk_gradient(xp, xu, prior, 0.0)
        for w in (np.zeros(4), np.array([3.0, 0, 0, 1]), rng.normal(0, 1, 4)):
            positive = lambda v: prior * np.logaddexp(0, -xp @ v).mean()
            negative = lambda v: np.logaddexp(0, xu @ v).mean() - prior * np.logaddexp(0, xp @ v).mean()
            risk = (lambda v: positive(v) + negative(v)) if negative(w) >= 0 else (lambda v: -negative(v))
            step = np.eye(4) * 1e-6
            assert np.allclose(gradient(w), [(risk(w + s) - risk(w - s)) / 2e-6 for s in step], atol=1e-5)
