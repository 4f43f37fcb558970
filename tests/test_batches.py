"""Whole pages go to Python a hundred rows at a time, not in Arrow batches of 10,000."""

import pytest

from corpusloom.functions import helpers
from corpusloom.jobs.queries import QUERIES


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    html = '<article><p>one</p><a href="/é">two</a> <a href="/x?utm_a=1">three</a></article>'
    spark.createDataFrame([(k, f"https://u@h{k}.example.org/{k}", html) for k in range(3)], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return folder


def plan(spark, root, name):
    return QUERIES[name](spark, root)._jdf.queryExecution().executedPlan().toString()


def test_node_tree_batches(spark, root):
    shown = plan(spark, root, "t12_node_tree")
    assert "BatchEvalPython" in shown and "ArrowEvalPython" not in shown


def test_halves_of_characters(spark):
    """Escapes of two halves are one character, and a half alone is replaced; Arrow failed on both."""
    rows = spark.createDataFrame([(r"\ud83d\ude00 \ud83d.",)], "x string")
    assert [r.y for r in rows.select(helpers.unescape_literal("x").alias("y")).collect()] == ["\U0001f600 �."]
    trees = spark.createDataFrame([(r'[{"title": "\ud83d\ude00", "contentXML": "\ude00"}]',)], "x string")
    assert [tuple(n) for n in trees.select(helpers.tree_nodes(trees.x).alias("y")).first().y] == [(2, "\U0001f600", "�")]


def test_decode_bytes_batches(spark, root):
    shown = plan(spark, root, "t1_decode_bytes")
    assert "BatchEvalPython" in shown and "ArrowEvalPython" not in shown


def test_linked_lines_batches(spark, root):
    shown = plan(spark, root, "l4_linked_lines")
    assert "BatchEvalPython" in shown and "ArrowEvalPython" not in shown


def test_lookup_batches(spark, root):
    shown = plan(spark, root, "l9_lookup_targets")
    assert "BatchEvalPython" in shown and "ArrowEvalPython" not in shown


def test_link_map_batches(spark, root):
    shown = plan(spark, root, "l8_build_link_map")
    assert "BatchEvalPython" in shown and "ArrowEvalPython" not in shown


def test_a_round_is_one_table(spark, monkeypatch):
    """A round of ``_first_of_each`` writes one table and joins nothing."""
    from corpusloom.operators import links

    plans, real = [], links.cut

    def kept(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return real(rows)

    monkeypatch.setattr(links, "cut", kept)
    found = [(1, "a", 1, "x"), (1, "b", 2, "x"), (1, "b", 2, "y"), (1, "c", 3, "y"), (2, "b", 1, "x")]
    taken = links._first_of_each(spark.createDataFrame(found, "id long, url string, rank long, alias string"))
    assert {tuple(r) for r in taken.collect()} == {(1, "a"), (1, "c"), (2, "b")}
    assert len(plans) == 3 and not any("Join" in p for p in plans)
