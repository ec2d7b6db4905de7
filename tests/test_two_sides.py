"""Joins of two large sides: regions in two phases, or a grid of tiles."""

import numpy as np
import pytest

import data
from nearfield.operators import knn
from nearfield.plans import regions, sizing


@pytest.fixture
def small_limits(spark):
    """Nothing fits the broadcast limit; 50 vectors of 12 elements make a tile."""
    spark.conf.set(sizing.BROADCAST_BYTES, "4000")
    spark.conf.set(sizing.TILE_BYTES, str(50 * 4 * 12))
    yield
    spark.conf.unset(sizing.BROADCAST_BYTES)
    spark.conf.unset(sizing.TILE_BYTES)


def join(spark, q, x, k=5, metric="l2", parts=4):
    table = data.points(spark, x, metric=metric, parts=parts)
    queries = data.queries(spark, q)
    return regions.RegionJoin(queries, table.df, len(x), k, metric, x.shape[1])


def isotropic(n, seed):
    return np.random.default_rng(seed).normal(size=(n, 12)).astype("f4")


@pytest.mark.parametrize("metric", ["l2", "inner_product"])
@pytest.mark.parametrize("kind", ["clusters", "isotropic", "few rows at home"])
def test_results_equal_brute_force(spark, small_limits, metric, kind):
    if kind == "clusters":
        x, q, k = data.blobs(800, 12, 40, spread=0.01), data.blobs(150, 12, 40, seed=5), 7
    elif kind == "isotropic":
        x, q, k = isotropic(700, 1), isotropic(160, 2), 7
    else:
        x, q, k = isotropic(500, 3), isotropic(90, 4), 60
    found = knn.knn_join(data.queries(spark, q), data.points(spark, x, metric=metric, parts=4), k)
    data.same(data.collected(found), data.brute_force(q, x, k, metric))


def test_queries_in_clusters_visit_few_regions(spark, small_limits):
    x = data.blobs(2000, 12, 40, spread=0.01)
    plan = join(spark, data.blobs(200, 12, 40, spread=0.01), x)
    visits, first = plan.visits(plan.queries.drop("at"))
    rows = visits.collect()
    visited = sum(len(r.cells) for r in rows) / (len(rows) * (plan.counts > 0).sum())
    assert visited < 0.2
    assert regions.share(sum(r.pairs for r in rows), len(rows), len(x)) < 0.2
    assert first.filter("rank = 5").count() == 200


def test_isotropic_vectors_meet_in_a_grid(spark, small_limits, monkeypatch):
    shapes = []
    grid = regions.grid_topk
    monkeypatch.setattr(regions, "grid_topk", lambda *a: shapes.append(a[2:4]) or grid(*a))
    x, q = isotropic(600, 1), isotropic(150, 2)
    data.same(data.collected(join(spark, q, x).result()), data.brute_force(q, x, 5))
    assert shapes == [(150, 600)]
    x = data.blobs(600, 12, 40, spread=0.01)
    assert len(data.collected(join(spark, x[:150], x).result())) == 150 and len(shapes) == 1


def test_pivots_and_routes_are_computed_once(spark, small_limits, monkeypatch):
    cut, plans = sizing.cut_lineage, []

    def cut_lineage(df):
        plans.append(df._jdf.queryExecution().toString())
        return cut(df)

    monkeypatch.setattr(sizing, "cut_lineage", cut_lineage)
    x = data.blobs(600, 12, 40, spread=0.01)
    found = join(spark, x[:150], x).result()
    plans.append(found._jdf.queryExecution().toString())
    for name in ("place(", "locate(", "route("):
        optimized = [p.split("== Optimized Logical Plan ==")[1].split("== Physical")[0] for p in plans]
        assert [f"MapInArrow {name}" in p for p in optimized].count(True) == 1


@pytest.mark.parametrize(("n_q", "n_x"), [(400, 60), (60, 400), (1, 300), (300, 1)])
@pytest.mark.parametrize("metric", ["l2", "inner_product"])
def test_grid_holds_either_side(spark, small_limits, metric, n_q, n_x):
    x, q = isotropic(n_x, 6), isotropic(n_q, 7)
    queries = data.queries(spark, q).selectExpr("qid", "vec", "CAST('inf' AS DOUBLE) AS bound")
    rows = data.points(spark, x, parts=3).df
    found = regions.grid_topk(queries, rows, n_q, n_x, 4, metric, 12)
    data.same(data.collected(found), data.brute_force(q, x, 4, metric))


def test_one_hot_region(spark, small_limits):
    x = np.concatenate([data.blobs(400, 12, 30, spread=0.01), np.tile(isotropic(1, 9), (300, 1))])
    q = np.concatenate([x[:80], x[400:500]])
    data.same(data.collected(join(spark, q, x, 3).result()), data.brute_force(q, x, 3))


def test_many_pairs_meet_in_regions_though_rows_fit_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(knn, "FEW_ROWS", 100)
    monkeypatch.setattr(knn, "BROADCAST_PAIRS", 10_000)
    scanned = []
    monkeypatch.setattr(knn.scan, "over_queries", lambda *args: scanned.append(args))
    monkeypatch.setattr(knn.scan, "over_corpus", lambda *args: scanned.append(args))
    monkeypatch.setattr(sizing, "fits", lambda spark, rows, dim, k=0: not k)
    x, q = data.blobs(400, 12, 20, spread=0.01), data.blobs(120, 12, 20, seed=5)
    found = knn.knn_join(data.queries(spark, q), data.points(spark, x), 5)
    assert not scanned
    data.same(data.collected(found), data.brute_force(q, x, 5))
