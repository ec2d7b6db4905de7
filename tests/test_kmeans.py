import numpy as np
import pytest

import data
from nearfield.operators import kmeans
from nearfield.plans import sizing


def two_groups(spark):
    return data.points(spark, [(1, 0, 0, 0)] * 50 + [(0, 0, 0, 1)] * 50, parts=3)


def matrix(model):
    rows = model.centroids().orderBy("cluster").collect()
    assert [r.cluster for r in rows] == list(range(model.k))
    return np.array([r.vec for r in rows])


def test_two_groups(spark):
    table = two_groups(spark)
    model = kmeans.kmeans_train(table, 2)
    assert sorted(map(tuple, matrix(model))) == [(0, 0, 0, 1), (1, 0, 0, 0)]
    got = {r.id: (r.cluster, r.distance) for r in kmeans.assign(model, table.df).collect()}
    assert len(got) == 100
    assert len({got[i] for i in range(50)}) == len({got[i] for i in range(50, 100)}) == 1
    assert got[0][0] != got[99][0] and got[0][1] == 0


def test_label_is_the_nearest_centroid(spark):
    x = data.blobs(300, 6, 5, spread=0.7)
    table = data.points(spark, x, parts=4)
    model = kmeans.kmeans_train(table, 7, iterations=5)
    d = ((x[:, None].astype(float) - matrix(model)[None]) ** 2).sum(-1)
    got = {r.id: (r.cluster, r.distance) for r in kmeans.assign(model, table.df).collect()}
    assert [got[i][0] for i in range(300)] == d.argmin(1).tolist()
    np.testing.assert_allclose([got[i][1] for i in range(300)], d.min(1), atol=1e-9)


def test_inertia_never_rises_and_training_repeats(spark):
    table = data.points(spark, data.blobs(400, 8, 10, spread=0.5), parts=4)
    model = kmeans.kmeans_train(table, 9, seed=3)
    assert all(a >= b - 1e-9 for a, b in zip(model.inertia, model.inertia[1:]))
    np.testing.assert_allclose(matrix(model), matrix(kmeans.kmeans_train(table, 9, seed=3)))


def test_always_k_centroids(spark):
    table = data.points(spark, [(0, 1)] * 6 + [(5, 5)] * 6)
    assert matrix(kmeans.kmeans_train(table, 5)).shape == (5, 2)


def test_errors_leave_the_model_untrained(spark):
    for k, dim in ((0, 4), (-1, 4), (2, 0), (2, -3)):
        with pytest.raises(ValueError, match="must be positive"):
            kmeans.kmeans_model(dim, k)
    model = kmeans.kmeans_model(4, 10)
    with pytest.raises(ValueError, match="10 clusters on 5 rows"):
        kmeans.kmeans_train(data.points(spark, np.eye(4).repeat(2, 0)[:5]), model.k)
    with pytest.raises(ValueError, match="empty"):
        kmeans.kmeans_train(data.points(spark, np.eye(4)[:0].reshape(0, 4)), 2)
    assert not model.trained
    with pytest.raises(RuntimeError, match="not trained"):
        model.centroids()
    with pytest.raises(RuntimeError, match="not trained"):
        kmeans.assign(model, data.rows(spark, np.eye(4)))


@pytest.mark.parametrize("merged", [False, True])
def test_sums_merged_by_spark_or_driver_agree(spark, merged):
    x = data.blobs(200, 4, 3)
    table = data.points(spark, x, parts=5)
    start = x[:3].astype(float)
    if merged:
        spark.conf.set(sizing.BROADCAST_BYTES, str(3 * 4 * 8 * 20))
    try:
        sums, counts, cost = kmeans._sums(table.df, start, 4)
    finally:
        spark.conf.unset(sizing.BROADCAST_BYTES)
    d = ((x[:, None].astype(float) - start[None]) ** 2).sum(-1)
    label = d.argmin(1)
    np.testing.assert_allclose(sums, [x[label == c].astype(float).sum(0) for c in range(3)])
    assert counts.tolist() == np.bincount(label, minlength=3).tolist()
    assert abs(cost - d.min(1).sum()) < 1e-9


@pytest.mark.parametrize("given", [True, False])
def test_models_beyond_the_broadcast_limit(spark, given):
    x = data.blobs(300, 6, 12, spread=0.3)
    table = data.points(spark, x, parts=4)
    init = data.rows(spark, x[:12]).withColumnRenamed("id", "cluster") if given else None
    small = kmeans.kmeans_train(table, 12, iterations=3, init=init, seed=5)
    spark.conf.set(sizing.BROADCAST_BYTES, "300")
    try:
        large = kmeans.kmeans_train(table, 12, iterations=3, init=init, seed=5)
        got = {r.id: r.cluster for r in kmeans.assign(large, table.df).collect()}
        near = kmeans.with_cluster(table.df, large.table)
        assert {r.id: r.cluster for r in near.collect()} == got
    finally:
        spark.conf.unset(sizing.BROADCAST_BYTES)
    np.testing.assert_allclose(large.inertia, small.inertia, rtol=1e-4)
    want, centroids = matrix(small), matrix(large)
    order = [int(((want - c) ** 2).sum(1).argmin()) for c in centroids]
    np.testing.assert_allclose(centroids, want[order], atol=1e-3)
    assert sorted(order) == list(range(12)) and len(got) == 300


def test_near_centroid_filter_keeps_payload(spark):
    table = two_groups(spark)
    model = kmeans.from_centroids(spark, np.array([[1.0, 0, 0, 0], [0, 0, 0, 3]]))
    df = table.df.selectExpr("*", "id * 2 AS twice")
    near = kmeans.near_centroid_filter(model, df, 1.0)
    assert sorted(r.twice for r in near.collect()) == [2 * i for i in range(50)]


def test_empty_clusters_beyond_the_broadcast_limit(spark):
    x = np.repeat([[0.0] * 4, [1.0] * 4, [8.0] * 4], [10, 20, 5], 0)
    points = data.points(spark, x)
    start = data.rows(spark, x[[0, 1, 12, 13, 2, 3]], list(range(6))).withColumnRenamed("id", "cluster")
    near = kmeans.kmeans_train(points, 6, 6, start)
    few = start.limit(3)
    spark.conf.set(sizing.BROADCAST_BYTES, "50")
    try:
        far = kmeans.kmeans_train(points, 6, 6, start)
        with pytest.raises(ValueError, match="exactly 6"):
            kmeans.kmeans_train(points, 6, 6, few)
        got = {r.cluster: r.vec for r in far.centroids().collect()}
        same = data.rows(spark, np.array([[0.0] * 4, [8.0] * 4]), [5, 5])
        found = kmeans.with_cluster(same, far.table).collect()
    finally:
        spark.conf.unset(sizing.BROADCAST_BYTES)
    want = {r.cluster: r.vec for r in near.centroids().collect()}
    assert len(far.inertia) == len(near.inertia)
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-5, atol=1e-6)
    # rows that share an id have their own clusters
    assert len(found) == 2 and len({r.cluster for r in found}) == 2
