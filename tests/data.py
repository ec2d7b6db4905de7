"""Fixtures shared by the tests."""

import numpy as np
from pyspark.sql import functions as F

from nearfield.sources.table import VectorTable, vector_table


def rows(spark, vectors, ids=None, parts=1):
    """``(id, vec)`` from a list of vectors."""
    ids = list(range(len(vectors))) if ids is None else ids
    data = [(i, [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(data, "id long, vec array<float>").repartition(parts)


def points(spark, vectors, ids=None, metric="l2", parts=1):
    dim = len(vectors[0]) if len(vectors) else 3
    return vector_table(rows(spark, vectors, ids, parts), dim=dim, metric=metric)


def queries(spark, vectors, ids=None):
    return rows(spark, vectors, ids).withColumnRenamed("id", "qid")


def blobs(n, dim, groups, seed=7, spread=0.1):
    """Gaussian groups around random centres."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return (centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dim))).astype("f4")


def brute_force(q, x, k, metric="l2", ids=None):
    """``{query position: [(id, distance)]}`` by scoring every pair in float64."""
    q, x = np.asarray(q, "f4").astype(float), np.asarray(x, "f4").astype(float)
    ids = np.arange(len(x)) if ids is None else np.asarray(ids)
    out = {}
    for i, v in enumerate(q):
        cost = ((x - v) ** 2).sum(1) if metric == "l2" else -(x @ v)
        order = np.lexsort((ids, cost))[:k]
        out[i] = [(int(ids[j]), float(cost[j] if metric == "l2" else -cost[j])) for j in order]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r.qid, []).append((r.id, r.distance))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        np.testing.assert_allclose([d for _, d in got[q]], [d for _, d in want[q]], atol=1e-6)


def vec_of(df, key):
    """``{key: vector}``"""
    return {r[key]: list(r.vec) for r in df.select(key, "vec").collect()}


def recall(spark, approx, exact):
    from nearfield.operators.evaluate import mean_recall

    return mean_recall(approx, exact).first()[0]


__all__ = ["F", "VectorTable"]
