import base64
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

import data
from nearfield.functions import expr
from nearfield.operators import knn, lookup
from nearfield.plans import sizing
from nearfield.sources import packed, store, table


def test_bad_dimension_and_metric():
    for dim in (0, -4):
        with pytest.raises(ValueError, match="dim must be positive"):
            table.vector_table(None, dim=dim)
    with pytest.raises(ValueError, match="invalid metric 'cosine'"):
        table.vector_table(None, dim=3, metric="cosine")


@pytest.mark.parametrize("bad", [[1.0, 2.0], [1.0, None, 2.0], [1.0, float("nan"), 0.0], None])
def test_bad_rows_fail_the_job_that_reads_them(spark, bad):
    df = spark.createDataFrame([(5, bad)], "id long, vec array<float>")
    with pytest.raises(Exception, match="vector 5 rejected"):
        table.vector_table(df, dim=3).df.collect()


def test_bad_rows_can_be_split_off(spark):
    inf = float("inf")
    rows = [
        (1, [1.0, 2.0]),
        (None, [1.0, 2.0]),
        (2, None),
        (3, [1.0]),
        (4, [1.0, None]),
        (5, [float("nan"), 0.0]),
        (6, [inf, 0.0]),
        (7, [0.0, -inf]),
    ]
    df = spark.createDataFrame(rows, "id long, vec array<float>")
    good, rejects = table.validate_vectors(df, 2)
    assert [r.id for r in good.collect()] == [1]
    counts = {r.reason: r.rows for r in table.reject_counts(rejects).collect()}
    assert counts == {
        "null_id": 1,
        "null_vector": 1,
        "wrong_dim": 1,
        "null_element": 1,
        "non_finite": 3,
    }


def test_sequential_ids_follow_the_order(spark):
    n = 500
    df = spark.range(n).select(
        (F.lit(n) - F.col("id")).alias("k"), F.array(F.col("id").cast("float")).alias("vec")
    )
    start = table.append_sequential(data.points(spark, [[-1.0]] * 3), df.repartition(7), "k")
    got = data.vec_of(start.df.filter("id >= 3"), "id")
    assert got == {3 + i: [float(n - 1 - i)] for i in range(n)}
    assert start.count() == n + 3


def test_sequential_ids_with_one_frequent_order_value(spark):
    df = spark.range(2000).select(F.lit(1).alias("k"), F.array(F.col("id") * 1.0).alias("vec"))
    # small partitions stay apart, to see how the rows are spread
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got, added = table.number_rows(df.repartition(6), "k")
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert added == 2000
    assert got.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (0, 1999, 2000)
    assert len(sizes) == 8 and max(sizes) < 700


def test_reset_restarts_ids(spark):
    t = store.truncate(data.points(spark, np.eye(3)))
    rows = data.rows(spark, np.eye(3), [7, 8, 9]).withColumnRenamed("id", "place")
    t = table.append_sequential(t, rows, "place")
    assert sorted(r.id for r in t.df.collect()) == [0, 1, 2]


def test_profile_counts_duplicates(spark):
    got = table.profile(data.points(spark, np.eye(4), [1, 1, 2, 3])).first()
    assert got.asDict() == {"ntotal": 4, "min_dim": 4, "max_dim": 4, "duplicate_ids": 1}


def test_packed_and_plain_rows_agree(spark):
    grid = [[10.0 * i + j for j in range(1, 5)] for i in range(10)]
    blob = struct.pack("<40f", *sum(grid, []))
    ids = struct.pack("<10q", *range(100, 110))
    df = spark.createDataFrame([(1, blob, ids)], "blob_id int, data binary, ids binary")
    got = data.vec_of(packed.unpack_vectors(df, 4, ids="ids"), "id")
    assert got == {100 + i: v for i, v in enumerate(grid)}
    text = df.select("blob_id", F.base64("data").alias("data"))
    plain = packed.unpack_vectors(packed.from_base64(text, "data"), 4)
    assert data.vec_of(plain, "pos") == dict(enumerate(grid))
    assert base64.b64encode(blob).decode() == text.first().data.replace("\r\n", "")


def test_packed_ids_are_exact(spark):
    ids = [0, -1, 2**63 - 1, -(2**63), 42, 7]
    df = spark.createDataFrame([(1, struct.pack("<6q", *ids))], "blob_id int, ids binary")
    got = packed.unpack_ids(df).orderBy("pos").collect()
    assert [r.id for r in got] == ids


def test_packed_sizes_are_checked(spark):
    df = spark.createDataFrame(
        [(1, bytes(13), bytes(8)), (2, bytes(16), bytes(3)), (3, bytes(32), bytes(8)), (4, bytes(16), bytes(8))],
        "blob_id int, data binary, ids binary",
    )
    with pytest.raises(Exception, match="13 bytes, expected a multiple of 16"):
        packed.unpack_vectors(df.filter("blob_id = 1"), 4).collect()
    with pytest.raises(Exception, match="3 bytes, expected a multiple of 8"):
        packed.unpack_ids(df.filter("blob_id = 2")).collect()
    with pytest.raises(Exception, match="binary size mismatch"):
        packed.unpack_vectors(df.filter("blob_id = 3"), 4, ids="ids").collect()
    good, rejects = packed.split_packed(df, 4, ids="ids")
    assert [r.blob_id for r in good.collect()] == [4]
    assert rejects.count() == 3


def test_unpaired_ids_come_back(spark):
    vecs = spark.createDataFrame([(1, 0, [1.0]), (1, 1, [2.0])], "blob_id int, pos int, vec array<float>")
    ids = spark.createDataFrame([(1, 0, 9)], "blob_id int, pos int, id long")
    pairs, rejects = packed.zip_ids(vecs, ids)
    assert [(r.id, r.vec) for r in pairs.collect()] == [(9, [1.0])]
    assert [r.reason for r in rejects.collect()] == ["no_id"]


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_export_round_trip(spark, chunk):
    x = data.blobs(50, 5, 3)
    out = packed.export_packed(data.rows(spark, x, parts=4), 5, chunk).orderBy("first_id").collect()
    ids = np.concatenate([np.frombuffer(r.ids, "<i8") for r in out])
    mat = np.concatenate([np.frombuffer(r.data, "<f4").reshape(-1, 5) for r in out])
    assert ids.tolist() == list(range(50)) and (mat == x).all()
    assert max(r.n for r in out) <= chunk


def test_save_load_and_snapshot(spark, tmp_path):
    t = data.points(spark, np.eye(4), metric="inner_product")
    store.save(t, f"{tmp_path}/t", sort_by_id=True)
    back = store.load(spark, f"{tmp_path}/t")
    assert (back.dim, back.metric, back.rows) == (4, "inner_product", 4)
    q = data.queries(spark, np.eye(4))
    data.same(data.collected(knn.knn_join(q, back, 2)), data.collected(knn.knn_join(q, t, 2)))
    copy = store.snapshot(back, f"{tmp_path}/copy")
    grown = table.append_with_ids(back, data.rows(spark, np.eye(4), [10, 11, 12, 13]))
    assert (grown.df.count(), copy.df.count(), back.df.count()) == (8, 4, 4)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        store.save(t, f"{tmp_path}/t")
    with pytest.raises(FileNotFoundError):
        store.load(spark, f"{tmp_path}/missing")


def test_reconstruct_keeps_order_and_duplicates(spark):
    t = data.points(spark, [(1, 2, 3, 4), (5, 6, 7, 8), (9, 10, 11, 12)])
    keys = spark.createDataFrame([(0, 2), (1, 0), (2, 2)], "pos int, id long")
    got = lookup.in_order(lookup.reconstruct(t, keys)).collect()
    assert [list(r.vec) for r in got] == [[9, 10, 11, 12], [1, 2, 3, 4], [9, 10, 11, 12]]
    assert lookup.reconstruct(t, keys.filter("pos < 0")).count() == 0


def test_reconstruct_errors(spark):
    t = data.points(spark, np.eye(3), [1, 2, 2])
    missing = spark.createDataFrame([(0, 7)], "pos int, id long")
    with pytest.raises(Exception, match="id 7 not found"):
        lookup.reconstruct(t, missing).collect()
    assert lookup.reconstruct(t, missing, on_missing="null").first().vec is None
    with pytest.raises(Exception, match="stored more than once"):
        lookup.reconstruct(t, spark.createDataFrame([(0, 2)], "pos int, id long")).collect()


def test_reconstruct_without_broadcast_and_a_hot_key(spark):
    t = data.points(spark, np.eye(5))
    keys = spark.createDataFrame([(i, 3 if i % 3 else i % 5) for i in range(60)], "pos int, id long")
    spark.conf.set(sizing.BROADCAST_BYTES, "100")
    try:
        got = lookup.reconstruct(t, keys).collect()
    finally:
        spark.conf.unset(sizing.BROADCAST_BYTES)
    assert len(got) == 60 and all(r.vec[r.id] == 1.0 for r in got)


def test_range_reaches_the_scan(spark, tmp_path):
    store.save(data.points(spark, data.blobs(40, 3, 2)), f"{tmp_path}/t", sort_by_id=True)
    got = lookup.reconstruct_range(store.load(spark, f"{tmp_path}/t"), 10, 5)
    assert sorted(r.id for r in got.collect()) == [10, 11, 12, 13, 14]
    assert "GreaterThanOrEqual(id,10)" in got._jdf.queryExecution().toString()


def test_residual_of_a_stored_row_is_zero(spark):
    t = data.points(spark, [(1, 2, 3)])
    xs = spark.createDataFrame([(0, 0, [1.0, 2.0, 3.0]), (1, 0, [2.0, 2.0, 2.0])], "pos int, id long, vec array<float>")
    got = {r.pos: list(r.residual) for r in lookup.residuals(t, xs).collect()}
    assert got == {0: [0, 0, 0], 1: [1, 0, -1]}


def test_expressions_and_sql_functions(spark):
    df = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "a array<float>, b array<float>")
    got = df.select(
        expr.l2_squared("a", "b"), expr.inner_product("a", "b"), expr.vector_subtract("b", "a"), expr.unit("b")
    ).first()
    assert got[:3] == (25.0, 16.0, [3.0, 4.0])
    np.testing.assert_allclose(got[3], np.array([4, 6]) / 52**0.5, atol=1e-7)
    expr.register_sql_functions(spark)
    df.createOrReplaceTempView("pairs")
    assert spark.sql("SELECT l2_squared(a, b), inner_product(a, b) FROM pairs").first() == (25.0, 16.0)


def test_zero_vectors_are_reported(spark):
    good, rejects = knn.l2_normalize(data.rows(spark, [(3, 4), (0, 0)]))
    np.testing.assert_allclose(good.first().vec, [0.6, 0.8], atol=1e-7)
    assert [(r.id, r.reason) for r in rejects.collect()] == [(1, "zero_norm")]


def test_ids_must_be_whole_and_elements_fit(spark):
    rows = [(1.0, [1.0]), (3.5, [1.0]), (3.2, [1.0]), (2.0, [1e39]), (float("nan"), [1.0]), (None, [1.0])]
    df = spark.createDataFrame(rows, "id double, vec array<double>")
    good, bad = table.validate_vectors(df, 1)
    assert [r.id for r in good.collect()] == [1.0]
    assert sorted(r.reason for r in bad.collect()) == ["non_finite"] + 3 * ["non_integer_id"] + ["null_id"]
    with pytest.raises(Exception, match="3.5 rejected: non_integer_id"):
        table.vector_table(df.filter("id = 3.5"), dim=1).df.collect()
    with pytest.raises(Exception, match="non_finite"):
        table.vector_table(df.filter("id = 2"), dim=1).df.collect()


def test_exact_copies_are_numbered_in_many_partitions(spark):
    df = spark.createDataFrame([(1.0,)] * 5000, "x double").repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        numbered, n = table.number_rows(df, "x")
        parts = numbered.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert n == 5000 and sorted(r.id for r in numbered.collect()) == list(range(5000))
    assert parts > 2
