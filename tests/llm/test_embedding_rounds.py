"""Trees whose sampled tops leave open leaves, cut further in rounds."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from trialweave.llm import embedding_dedup

from .test_operators import _brute_links, _vectors


@pytest.fixture
def small_plans(monkeypatch):
    """Plans on 64 vectors and leaves of 40, so that tops are never enough."""
    for name, value in {
        "SAMPLE_ROWS": 64, "LEAST_SAMPLE": 64, "LEAF_ROWS": 40, "BLOCK_ROWS": 25, "PLAN_ROWS": 128
    }.items():
        monkeypatch.setattr(embedding_dedup, name, value)


def _index(spark, vectors, trees=3):
    rows = [(i, 1, v) for i, v in enumerate(vectors.tolist())]
    classes = spark.createDataFrame(rows, "node long, copies long, vector array<double>").repartition(3)
    forest = embedding_dedup.plan_forest(classes, trees)
    return embedding_dedup._index_in_rounds(spark, classes, forest, []), forest


def test_rounds_go_on_until_leaves_are_small(spark, small_plans):
    vectors = np.random.default_rng(41).standard_normal((6000, 12))
    indexed, forest = _index(spark, vectors)
    assert all(tree.unfinished.any() for tree in forest[12])
    leaves = indexed.groupBy("leaf").agg(F.countDistinct("node").alias("n")).collect()
    # Leaves end by their expected size, so chance may leave some a little larger.
    assert max(row["n"] for row in leaves) <= 80
    # Some leaves took more than one round, and every vector is in every tree.
    assert max(bin(row["leaf"] & ((1 << embedding_dedup.TOP_SHIFT) - 1)).count("1") for row in leaves) > 2
    tree = F.col("leaf").bitwiseAND(F.lit(-1 << (embedding_dedup.TOP_SHIFT + embedding_dedup.NODE_BITS)))
    placed = indexed.groupBy(tree.alias("tree")).agg(F.countDistinct("node").alias("n")).collect()
    assert [row["n"] for row in placed] == [6000] * 3


def test_vectors_close_together_end_the_rounds(spark, small_plans):
    """A dense leaf is not cut for ever; it is compared in blocks, every pair once."""
    chance = np.random.default_rng(42)
    close = chance.standard_normal(12) + 1e-4 * chance.standard_normal((300, 12))
    rows = [(i, v) for i, v in enumerate(close.tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = embedding_dedup.near_duplicates(frame, trees=3).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(299, 0)}


@pytest.mark.parametrize("element", ["double", "float"])
def test_recall_after_rounds(spark, small_plans, element):
    chosen = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v])
              for i, (_, v) in enumerate(_vectors()[:1800])]
    frame = spark.createDataFrame(chosen, f"vec_id long, embedding array<{element}>").repartition(4)
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(frame).collect()}
    degrees = _brute_links(chosen).sum(axis=1)
    assert len(got) == len(chosen)
    assert all(got[i] <= d for i, d in enumerate(degrees))
    assert sum(got.values()) >= 0.9 * degrees.sum()


def test_many_copies_of_one_vector_are_one_node(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(500, [1.0, 2.0, 3.01]), (501, [-1.0, 0.0, 0.5])]
    rows += [(502, [-1.0, -0.0, 0.5]), (503, [2.0, 4.0]), (503, [2.0, 4.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = embedding_dedup.near_duplicates(frame)
    counts = {(r["vec_id"], r["n_links"], r["component_id"]) for r in got.collect()}
    assert counts == (
        {(i, 500, 0) for i in range(501)} | {(501, 1, 501), (502, 1, 501), (503, 1, 503)}
    )
