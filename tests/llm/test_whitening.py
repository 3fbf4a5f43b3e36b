"""Embedding whitening against plain whole-number sums, and its odd cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trialweave.llm import whitening
from trialweave.llm.queries import QUERIES

from . import brute
from .test_operators import crowded

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA).repartition(3)


def drawn(n, dims, seed=1, size=1.0):
    chance = random.Random(seed)
    return [[float(np.float32(chance.gauss(0, size) + (d == 0) * 5)) for d in range(dims)] for _ in range(n)]


def by_row(frame):
    out = {}
    for row in frame.collect():
        out.setdefault(row["vec_id"], {})[row["component"]] = row
    return out


@pytest.mark.parametrize("size", [1.0, 1e6])
def test_whitening_equals_plain_sums(spark, monkeypatch, size):
    monkeypatch.setattr(whitening, "SLICE_ENTRIES", 50)
    values = drawn(60, 6, size=size)
    n, deviations, whitened, shares = brute.whitened(values, 4)
    rows = by_row(whitening.whiten(crowded(vectors_of(spark, enumerate(values))), components=4))
    assert sorted(rows) == list(range(60))
    for i, components in rows.items():
        assert sorted(components) == [1, 2, 3, 4]
        for k, row in components.items():
            assert (row["n"], int(row["deviation"])) == (n, deviations[i])
            assert abs(abs(row["whitened"]) - abs(whitened[i][k - 1])) < 1e-8
            assert abs(row["explained"] - shares[k - 1]) < 1e-12
    errors = {row["identity_error"] for components in rows.values() for row in components.values()}
    assert len(errors) == 1 and errors.pop() < 1e-9
    # The sign of a component is the same for all rows.
    for k in range(4):
        signs = {np.sign(rows[i][k + 1]["whitened"] * whitened[i][k]) for i in range(60) if abs(whitened[i][k]) > 1e-6}
        assert len(signs) == 1


def test_polarisation_gives_the_covariance_exactly():
    x = np.random.default_rng(5).integers(-1000, 1000, (40, 7))
    sums = [int(s) for s in x.sum(axis=0)]
    found = whitening.polarised(whitening.pair_squares(x).astype(object), sums, len(x))
    centred = len(x) * x.astype(object) - np.array(sums, object)
    assert ((centred.T @ centred) == found * len(x)).all()


def test_vectors_that_do_not_count(spark):
    values = drawn(20, 3)
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0, None, 2.0], [nan, 1.0, 1.0], [1.0, -inf, 1.0], [1.0, 2.0], [1e30, 0.0, 0.0]]
    rows = list(enumerate(values)) + [(100 + i, v) for i, v in enumerate(odd)] + [(None, values[0]), (3, values[3])]
    kept = values + [values[0], values[3]]
    n, deviations, _, _ = brute.whitened(kept, 3)
    out = whitening.whiten(vectors_of(spark, rows)).collect()
    assert n == 22 and len(out) == 22 * 3 and {row["n"] for row in out} == {22}
    assert sorted(int(r["deviation"]) for r in out if r["component"] == 1) == sorted(deviations)
    assert sum(r["vec_id"] is None for r in out) == 3 and sum(r["vec_id"] == 3 for r in out) == 6


def test_without_variance_there_are_no_components(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(i, [0.5, 0.5]) for i in range(5)]):
        out = whitening.whiten(vectors_of(spark, rows))
        assert out.collect() == []
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    line = whitening.whiten(vectors_of(spark, [(i, [float(i), 1.0]) for i in range(9)])).collect()
    assert {row["component"] for row in line} == {1} and len(line) == 9


def test_one_vector_in_a_third_of_all_rows(spark):
    values = drawn(40, 4) + [[0.25, 0.5, 0.75, 1.0]] * 25
    rows = by_row(whitening.whiten(vectors_of(spark, enumerate(values))))
    _, deviations, whitened, _ = brute.whitened(values, 4)
    assert [int(rows[i][1]["deviation"]) for i in range(65)] == deviations
    assert np.allclose([abs(rows[i][1]["whitened"]) for i in range(65)], abs(whitened[:, 0]))


def test_the_query_gives_the_columns_of_its_contract(spark):
    out = QUERIES["op11_whitening"](spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    assert out.agg(F.max("component")).first()[0] == 32
    assert out.agg(F.max("identity_error")).first()[0] < 1e-4
