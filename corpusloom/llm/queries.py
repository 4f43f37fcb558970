"""The queries of this subpackage and their SQL, for registration by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontamination, embeddings, jaccard, language, quality, secrets, substrings, toxicity
from corpusloom.llm.common import table
from corpusloom.llm.exact import exact_duplicates
from corpusloom.llm.mixing import mixture
from corpusloom.llm.periodic import periodic_runs
from corpusloom.llm.sharding import shard_manifest
from corpusloom.llm.spelling import variants


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.trained(docs, table(spark, sf_dir, "labels")))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.secrets(table(spark, sf_dir, "documents")))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated(table(spark, sf_dir, "documents")).drop("edges")


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.dictionaries(docs))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_manifest(table(spark, sf_dir, "documents"), shards=16)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op13_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_jaccard": op3_jaccard,
    "op4_quality": op4_quality,
    "op5_secrets": op5_secrets,
    "op6_substrings": op6_substrings,
    "op7_embeddings": op7_embeddings,
    "op8_mixing": op8_mixing,
    "op9_language": op9_language,
    "op10_sharding": op10_sharding,
    "op11_runs": op11_runs,
    "op12_spelling": op12_spelling,
    "op13_exact": op13_exact,
}

#: Components by closure over links ``l (a, b)``: every node reaches the smallest node of its component.
_REACHED = "reached(node, low) AS (SELECT a, a FROM l UNION SELECT l.b, r.low FROM reached r JOIN l ON r.node = l.a WHERE l.b > r.low)"

ORACLES: dict[str, str] = {
    "op3_jaccard": rf"""WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) WHEN len(w) > 0 THEN [len(w) || ' ' || array_to_string(w, ' ')] ELSE [] END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS t FROM s),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM e x JOIN e y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
{_REACHED},
m AS (SELECT node, min(low) AS low FROM reached GROUP BY node)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, coalesce(m.low, n.doc_id) AS component_id FROM n LEFT JOIN m ON m.node = n.doc_id""",
    "op7_embeddings": rf"""WITH RECURSIVE
v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
{_REACHED},
m AS (SELECT node, min(low) AS low FROM reached GROUP BY node),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, coalesce(m.low, e.vec_id) AS component_id, coalesce(m.low, e.vec_id) = e.vec_id AS kept FROM embeddings e LEFT JOIN m ON m.node = e.vec_id LEFT JOIN k ON k.a = e.vec_id""",
    "op13_exact": r"""SELECT doc_id, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
doc_id = first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)""",
}
