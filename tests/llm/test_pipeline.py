"""The pipeline's stages against plain versions, on a small table of its own."""

import random
from collections import Counter

import plain
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(12)
    items = [plain.prose(rng, 30) for _ in range(3)]
    rows, labels = [], []
    for k in range(260):
        text = plain.prose(rng, rng.randint(40, 90))
        toxic = k % 6 == 0
        if toxic:
            text = " ".join(w + (" nastyword vileness" if n % 9 == 0 else "") for n, w in enumerate(text.split()))
        if k % 10 == 1:
            text += " " + items[k % 3]
        rows.append((k, text, "en", f"s{k % 4}", len(text)))
        labels.append((k, 1, int(toxic)))
    rows += [(300 + k, r[1] + f" tail{k}", "en", "s0", 0) for k, r in enumerate(rows[2:60:7])] + [(400, None, None, None, None), (401, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, rows


def test_stages(spark, tables):
    root, rows = tables
    docs = spark.read.parquet(f"{root}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    clean = spark.createDataFrame(stage["toxicity"](spark, docs, root).collect(), docs.schema)
    ids = {r.doc_id for r in clean.collect()}
    assert len({r[0] for r in rows if r[0] < 260 and r[0] % 6 == 0} & ids) <= 2
    assert len({r[0] for r in rows if r[0] < 260 and r[0] % 6} - ids) <= 2
    one = spark.createDataFrame(stage["near_duplicates"](spark, clean, root).collect(), docs.schema)
    label = plain.jaccard_components([(r.doc_id, r.text) for r in clean.collect()])
    assert {r.doc_id for r in one.collect()} == {i for i, (_, c) in label.items() if i == c}
    free = spark.createDataFrame(stage["decontamination"](spark, one, root).collect(), docs.schema)
    assert {r.doc_id for r in free.collect()} == {r.doc_id for r in one.collect() if not (r.doc_id < 260 and r.doc_id % 10 == 1)}
    mixed = stage["mixing"](spark, free, root).collect()
    have = Counter(map(tuple, free.collect()))
    assert set(Counter(map(tuple, mixed))) <= set(have)
    shards = stage["sharding"](spark, spark.createDataFrame(mixed, docs.schema), root).collect()
    assert Counter(r.doc_id for r in shards) == Counter(r.doc_id for r in mixed)
    run = corpus_pipeline.run(spark, root).collect()
    assert sorted(map(tuple, run), key=str) == sorted(map(tuple, shards), key=str)


def test_registered(spark, tables):
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
