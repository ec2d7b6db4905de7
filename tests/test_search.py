import numpy as np
import pytest

from pyspark.sql import functions as F

import data
from nearfield.operators import knn, shape
from nearfield.plans import sizing
from nearfield.plans.pairs import PairScorer
from nearfield.sources.table import VectorTable

BASIS4 = np.eye(4)


def test_unit_vectors_are_their_own_neighbours(spark):
    table = data.points(spark, BASIS4)
    found = data.collected(knn.knn_join(data.queries(spark, BASIS4[:1]), table, 2))
    assert found[0][0] == (0, 0.0)
    assert found[0][1] == (1, 2.0)  # squared, and the smaller of three equal ids


def test_batch_of_queries(spark):
    table = data.points(spark, np.eye(3))
    found = data.collected(knn.knn_join(data.queries(spark, np.eye(3)[[0, 2]]), table, 1))
    assert [found[q][0][0] for q in (0, 1)] == [0, 2]


def test_inner_product_is_descending(spark):
    table = data.points(spark, [(1, 0, 0), (0, 1, 0), (0.9, 0.1, 0)], metric="inner_product")
    found = data.collected(knn.knn_join(data.queries(spark, [(1, 0, 0)]), table, 3))
    assert [i for i, _ in found[0]] == [0, 2, 1]
    np.testing.assert_allclose([d for _, d in found[0]], [1, 0.9, 0], atol=1e-6)


@pytest.mark.parametrize("metric", ["l2", "inner_product"])
@pytest.mark.parametrize("offset", [0.0, 1000.0])
@pytest.mark.parametrize("plan", ["corpus", "queries", "regions"])
def test_every_plan_equals_brute_force(spark, metric, offset, plan):
    x = data.blobs(900, 12, 9) + np.float32(offset)
    x[300:600] = x[5]  # a third of the rows are copies
    q = data.blobs(200, 12, 9, seed=8) + np.float32(offset)
    table = data.points(spark, x, metric=metric, parts=5)
    try:
        if plan != "corpus":
            limit = 20_000 if plan == "queries" else 4_000
            spark.conf.set(sizing.BROADCAST_BYTES, str(limit))
            spark.conf.set(sizing.TILE_BYTES, str(50 * 4 * 12))
        got = data.collected(knn.knn_join(data.queries(spark, q), table, 7))
    finally:
        spark.conf.unset(sizing.BROADCAST_BYTES)
        spark.conf.unset(sizing.TILE_BYTES)
    data.same(got, data.brute_force(q, x, 7, metric))


def test_huge_values_do_not_overflow(spark):
    x = np.array([[1e19, 0], [2e19, 0], [-1e19, 1]], "f4")
    got = data.collected(knn.knn_join(data.queries(spark, x[:1]), data.points(spark, x), 3))
    assert [i for i, _ in got[0]] == [0, 1, 2]


def test_custom_and_extreme_ids(spark):
    ids = [0, -1, 2**63 - 1, -(2**63), 42, 7]
    table = data.points(spark, np.eye(6), ids)
    got = data.collected(knn.knn_join(data.queries(spark, np.eye(6)), table, 1))
    assert [got[q][0][0] for q in range(6)] == ids


def test_fewer_rows_than_k_are_padded(spark):
    table = data.points(spark, [(1, 0, 0), (0, 1, 0)])
    q = data.queries(spark, [(1, 0, 0)])
    got = data.collected(shape.pad_results(knn.knn_join(q, table, 5), q, 5))
    assert [i for i, _ in got[0]] == [0, 1, -1, -1, -1]
    assert got[0][4][1] is None


def test_empty_table_and_empty_queries(spark):
    q = data.queries(spark, [(1, 0, 0)])
    empty = VectorTable(data.rows(spark, []), 3)
    got = data.collected(shape.pad_results(knn.knn_join(q, empty, 3), q, 3))
    assert [i for i, _ in got[0]] == [-1, -1, -1]
    table = data.points(spark, np.eye(3))
    assert knn.knn_join(q.filter("qid < 0"), table, 2).count() == 0


def test_k_and_metric_are_checked(spark):
    table = data.points(spark, np.eye(3))
    q = data.queries(spark, np.eye(3))
    for k in (0, -2):
        with pytest.raises(ValueError, match="k must be positive"):
            knn.knn_join(q, table, k)
    with pytest.raises(ValueError, match="'l2' or 'inner_product'"):
        knn.knn_join(q, table, 1, metric="cosine")


def test_cosine_leaves_out_zero_vectors(spark):
    x = [(2, 0), (0, 0), (3, 3), (0, 5)]
    got = data.collected(
        knn.cosine_knn(data.queries(spark, [(7, 0), (0, 0)]), data.points(spark, x), 3)
    )
    assert set(got) == {0}
    assert [i for i, _ in got[0]] == [0, 2, 3]
    np.testing.assert_allclose([d for _, d in got[0]], [1, 0.5**0.5, 0], atol=1e-6)


def test_self_search_without_self(spark):
    x = np.array([(0, 0), (0, 0), (0, 0), (1, 0)])
    got = data.collected(knn.self_knn(data.points(spark, x), 2, exclude_self=True))
    assert [i for i, _ in got[2]] == [0, 1]
    assert [i for i, _ in got[0]] == [1, 2]


def test_merge_of_shards(spark):
    x = data.blobs(60, 4, 3)
    q = data.queries(spark, x[:5])
    parts = [
        knn.knn_join(q, data.points(spark, x[s : s + 20], list(range(s, s + 20))), 4)
        for s in (0, 20, 40)
    ]
    data.same(data.collected(shape.knn_merge(parts, 4, "l2")), data.brute_force(x[:5], x, 4))


def test_wide_form_and_threshold(spark):
    table = data.points(spark, BASIS4)
    found = knn.knn_join(data.queries(spark, BASIS4[:1]), table, 3)
    wide = shape.to_wide(found).first()
    assert wide.labels == [0, 1, 2] and wide.distances == [0.0, 2.0, 2.0]
    assert shape.within(found, 2.0).count() == 1


def test_payload_comes_back(spark):
    df = data.rows(spark, np.eye(3)).selectExpr("id", "vec", "concat('row', id) AS name")
    table = VectorTable(df, 3)
    got = shape.semantic_search(data.queries(spark, [(0, 2, 0)]), table, 1).first()
    assert (got.name, got.score) == ("row1", 1.0)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_small_corpus_needs_no_shuffle(spark):
    table = data.points(spark, np.eye(3))
    found = knn.knn_join(data.queries(spark, np.eye(3)), table, 2)
    plan = plan_of(found).split("== Physical Plan ==")[1]
    assert "MapInArrow" in plan and "Window" not in plan


def test_small_queries_scan_the_corpus_in_place(spark):
    x = data.blobs(400, 8, 4)
    table = data.points(spark, x)
    spark.conf.set(sizing.BROADCAST_BYTES, "4000")
    try:
        found = knn.knn_join(data.queries(spark, x[:3]), table, 2)
        plan = plan_of(found).split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset(sizing.BROADCAST_BYTES)
    assert "WindowGroupLimit" in plan and "Join" not in plan
    assert plan.count("Exchange hashpartitioning(qid") == 1


def test_padded_results_are_reranked_alike_on_both_plans(spark):
    x = data.blobs(20, 4, 2)
    table, q = data.points(spark, x), data.queries(spark, x[:2])
    found = shape.pad_results(knn.knn_join(q, data.points(spark, x[:3]), 3), q, 6)
    want = None
    for limit in (None, "100"):
        if limit:
            spark.conf.set(sizing.BROADCAST_BYTES, limit)
        try:
            got = sorted((r.qid, r.id, round(r.distance, 9)) for r in PairScorer(q, table)(found).collect())
        finally:
            spark.conf.unset(sizing.BROADCAST_BYTES)
        assert len(got) == 6 and all(i in (0, 1, 2) for _, i, _ in got)
        want = want or got
        assert got == want


@pytest.mark.parametrize("limit", [None, "100"])
def test_bad_queries_fail_on_every_plan(spark, limit):
    table = data.points(spark, data.blobs(30, 3, 2))
    if limit:
        spark.conf.set(sizing.BROADCAST_BYTES, limit)
    try:
        for bad in ([float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], None, [None, 1.0, 2.0]):
            q = spark.createDataFrame([(0, [1.0, 2.0, 3.0]), (7, bad)], "qid long, vec array<float>")
            with pytest.raises(Exception, match="vector 7 rejected"):
                knn.knn_join(q, table, 2).collect()
    finally:
        spark.conf.unset(sizing.BROADCAST_BYTES)
    q = spark.createDataFrame([(3.5, [1.0, 2.0, 3.0])], "qid double, vec array<float>")
    with pytest.raises(Exception, match="3.5 rejected: non_integer_id"):
        knn.as_queries(q).collect()


@pytest.mark.parametrize("limit", [None, "900", "100"])
def test_queries_that_share_an_id(spark, limit):
    from nearfield.operators import ivf

    x = data.blobs(60, 4, 3)
    table = data.points(spark, x)
    index = ivf.ivf_build(table, nlist=3)
    q = data.queries(spark, x[:3]).withColumn("qid", F.when(F.col("qid") < 2, 7).otherwise(F.col("qid")).cast("long"))
    alone = [data.brute_force(x[i : i + 1], x, 2)[0] for i in range(3)]
    want = sorted([(7, *p) for i in (0, 1) for p in alone[i]] + [(2, *p) for p in alone[2]])
    if limit:
        spark.conf.set(sizing.BROADCAST_BYTES, limit)
    try:
        for found in (knn.knn_join(q, table, 2), ivf.ivf_search(index, q, 2, nprobe=3)):
            got = sorted((r.qid, r.id, r.distance) for r in found.collect())
            assert [g[:2] for g in got] == [w[:2] for w in want]
            np.testing.assert_allclose([g[2] for g in got], [w[2] for w in want], atol=1e-5)
    finally:
        spark.conf.unset(sizing.BROADCAST_BYTES)


def test_padding_broadcasts_no_result(spark, tmp_path):
    # by the queries' size on disk Spark takes the result for a small one, whatever comes of it
    data.queries(spark, BASIS4[:2]).write.parquet(str(tmp_path / "queries"))
    table, q = data.points(spark, BASIS4), spark.read.parquet(str(tmp_path / "queries"))
    padded = shape.pad_results(knn.knn_join(q, table, 3), q, 6)
    plan = padded._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert padded.count() == 12
