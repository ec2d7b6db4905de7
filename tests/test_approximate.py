import numpy as np
import pytest
from pyspark.sql import functions as F

import data
from nearfield.functions.kernels import Half, Product
from nearfield.operators import graph, ivf, kmeans, knn, quant
from nearfield.operators.lookup import reconstruct, residuals
from nearfield.plans import sizing
from nearfield.sources import store


@pytest.fixture(scope="module")
def corpus(spark):
    x = data.blobs(2000, 16, 40, spread=0.25)
    held_out = data.blobs(2100, 16, 40, spread=0.25)[2000:]
    table = data.points(spark, x, parts=4)
    table = type(table)(table.df.persist(), table.dim, table.metric, 2000)
    queries = data.queries(spark, held_out).persist()
    exact = knn.knn_join(queries, table, 10).persist()
    return table, queries, exact, x, held_out


@pytest.fixture(scope="module")
def index(spark, corpus):
    return ivf.ivf_build(corpus[0], nlist=16, iterations=8)


def test_untrained_index_refuses(spark):
    index = ivf.ivf_index(8, 4)
    table = data.points(spark, np.eye(8))
    with pytest.raises(RuntimeError, match="train"):
        ivf.ivf_add(index, table)
    with pytest.raises(RuntimeError, match="train"):
        ivf.ivf_search(index, data.queries(spark, np.eye(8)), 2)
    empty = data.points(spark, np.eye(8)).df.filter("id < 0")
    assert not ivf.ivf_train(index, type(table)(empty, 8)).trained
    assert index.rows is None


def test_default_list_count():
    assert ivf.default_nlist(10_000) == 400


def test_every_row_lies_in_one_list(corpus, index):
    assert index.rows.count() == 2000
    assert ivf.list_sizes(index).agg(F.sum("rows")).first()[0] == 2000


def test_recall_rises_with_probes_to_exact(spark, corpus, index):
    table, queries, exact, x, held_out = corpus
    seen = [
        data.recall(spark, ivf.ivf_search(index, queries, 10, n), exact) for n in (1, 2, 4, 16)
    ]
    assert seen == sorted(seen) and seen[0] > 0.6 and seen[2] > 0.9
    data.same(
        data.collected(ivf.ivf_search(index, queries, 10, 16)), data.brute_force(held_out, x, 10)
    )


def test_shuffled_search_equals_scan(spark, corpus, index):
    _, queries, _, x, _ = corpus
    copies = data.rows(spark, np.repeat(x[:1], 900, 0), list(range(5000, 5900)))
    skewed = ivf.ivf_add(index, type(corpus[0])(copies, 16))  # one list holds a third
    want = data.collected(ivf.ivf_search(skewed, queries, 10, 3))
    spark.conf.set(sizing.BROADCAST_BYTES, "3000")
    spark.conf.set(sizing.TILE_BYTES, str(64 * 4 * 16))
    try:
        got = data.collected(ivf.ivf_search(skewed, queries, 10, 3))
    finally:
        spark.conf.unset(sizing.BROADCAST_BYTES)
        spark.conf.unset(sizing.TILE_BYTES)
    data.same(got, want)


def test_stored_lists_are_pruned_and_grow(spark, corpus, index, tmp_path):
    _, queries, _, _, held_out = corpus
    stored = store.snapshot(index, f"{tmp_path}/index")
    data.same(
        data.collected(ivf.ivf_search(stored, queries, 5, 2)),
        data.collected(ivf.ivf_search(index, queries, 5, 2)),
    )
    one = ivf.only_lists(stored, [3])
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and one.inputFiles()
    grown = ivf.ivf_add(stored, data.points(spark, held_out, list(range(9000, 9100))))
    found = ivf.ivf_search(grown, queries, 1, 1)
    assert all(i == 9000 + q for q, ((i, _),) in data.collected(found).items())
    with pytest.raises(FileNotFoundError):
        store.load(spark, f"{tmp_path}/none")


def test_long_lists_are_written_by_many_tasks(spark, tmp_path):
    x = np.zeros((6000, 4), "f4")
    model = kmeans.from_centroids(spark, np.array([[0.0] * 4, [9.0] * 4]))
    index = ivf.ivf_build(data.points(spark, x, parts=6), model=model)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = store.snapshot(index, f"{tmp_path}/index")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(stored.rows.inputFiles()) == 8


def test_kmeans_model_as_quantizer(spark, corpus):
    table, queries, exact, _, _ = corpus
    model = kmeans.kmeans_train(table, 8, iterations=3)
    index = ivf.with_quantizer(ivf.ivf_index(16, 1), model)
    assert ivf.ivf_add(index, table).nlist == 8
    with pytest.raises(ValueError, match="expected 5"):
        ivf.with_quantizer(ivf.ivf_index(5, 1), model)


def test_large_quantizer_uses_joins(spark, corpus, index):
    table, queries, _, _, _ = corpus
    want = {r.id: r.list_id for r in index.rows.collect()}
    probes = {(r.qid, r.list_id) for r in ivf.ivf_probes(index, queries, 3).collect()}
    spark.conf.set(sizing.BROADCAST_BYTES, "500")
    try:
        got = {r.id: r.list_id for r in ivf.to_lists(index, table.df).collect()}
        far = {(r.qid, r.list_id) for r in ivf.ivf_probes(index, queries, 3).collect()}
    finally:
        spark.conf.unset(sizing.BROADCAST_BYTES)
    assert got == want and far == probes


def test_half_precision(spark, corpus, index):
    table, queries, exact, x, _ = corpus
    half = quant.ivf_half(index)
    assert "vec" not in half.rows.columns
    back = data.vec_of(quant.decoded(half), "id")
    np.testing.assert_allclose([back[i] for i in range(2000)], x, rtol=2**-11, atol=2**-25)
    assert data.recall(spark, ivf.ivf_search(half, queries, 10, 16), exact) > 0.95
    with pytest.raises(ValueError, match="already compressed"):
        quant.ivf_half(half)


def test_half_precision_range(spark):
    table = data.points(spark, [(65504.0, 1.0), (70000.0, 1.0)])
    good, rejects = quant.half_rejects(table)
    assert [r.id for r in good.df.collect()] == [0]
    assert [r.reason for r in rejects.collect()] == ["half_overflow"]
    with pytest.raises(Exception, match="float16 range"):
        table.df.select(quant.half_encode("vec", 2)).collect()


@pytest.fixture(scope="module")
def product(corpus, index):
    book = quant.pq_train(corpus[0], m=8, nbits=6, index=index, iterations=6)
    return quant.ivf_pq(index, book), book


def test_product_codes(spark, corpus, index, product):
    table, queries, exact, x, _ = corpus
    coded, book = product
    assert book.books.shape == (8, 64, 2)
    assert book.table(spark).count() == 8 * 64
    np.testing.assert_array_equal(quant.codebook(book.table(spark)).books, book.books)
    assert coded.rows.select(F.max(F.octet_length("codes"))).first()[0] == 8
    rough = ivf.ivf_search(coded, queries, 40, 8)
    alone = data.recall(spark, ivf.ivf_search(coded, queries, 10, 8), exact)
    better = data.recall(spark, quant.rerank(rough, queries, table, 10), exact)
    assert 0.5 < alone <= better and better > 0.9


def test_product_distance_is_that_of_the_decoded_row(corpus, product):
    _, queries, _, _, held_out = corpus
    coded, _ = product
    rebuilt = data.vec_of(quant.decoded(coded), "id")
    x = np.array([rebuilt[i] for i in range(2000)])
    data.same(
        data.collected(ivf.ivf_search(coded, queries, 5, 16)), data.brute_force(held_out, x, 5)
    )


def test_quantization_error(corpus, product):
    table, _, _, x, _ = corpus
    errors = quant.quantization_error(product[0], table)
    mean = errors.agg(F.avg("error")).first()[0]
    assert 0 < mean < 0.3 * x.var(0).sum()
    keys = table.df.select(F.col("id").alias("pos"), "id")
    assert reconstruct(quant.decoded_table(product[0]), keys).count() == 2000
    xs = table.df.select(F.col("id").alias("pos"), "id", "vec")
    left = residuals(quant.decoded_table(product[0]), xs)
    got = {r.id: r.residual for r in left.collect()}
    assert got == {r.id: r.residual for r in errors.collect()}


@pytest.mark.parametrize("kind", ["half", "product"])
def test_compressed_lists_store_and_grow(spark, corpus, index, product, tmp_path, kind):
    _, queries, _, _, held_out = corpus
    compressed = product[0] if kind == "product" else quant.ivf_half(index)
    stored = store.snapshot(compressed, f"{tmp_path}/index")
    assert isinstance(stored.decode, Product if kind == "product" else Half)
    data.same(
        data.collected(ivf.ivf_search(stored, queries, 5, 4)),
        data.collected(ivf.ivf_search(compressed, queries, 5, 4)),
    )
    grown = ivf.ivf_add(stored, data.points(spark, held_out, list(range(9000, 9100))))
    assert grown.rows.count() == 2100 and "vec" not in grown.rows.columns
    ids = {i for found in data.collected(ivf.ivf_search(grown, queries, 1, 4)).values() for i, _ in found}
    assert any(i >= 9000 for i in ids)
    emptied = ivf.ivf_add(store.truncate(grown), data.points(spark, held_out))
    assert emptied.rows.count() == 100


def test_product_with_a_large_quantizer(spark, corpus, index, product, tmp_path):
    _, queries, _, _, _ = corpus
    coded, book = product
    want = data.collected(ivf.ivf_search(coded, queries, 5, 4))
    spark.conf.set(sizing.BROADCAST_BYTES, "700")
    try:
        far = quant.ivf_pq(index, book)
        got = data.collected(ivf.ivf_search(far, queries, 5, 4))
        stored = store.snapshot(far, f"{tmp_path}/index")
        again = data.collected(ivf.ivf_search(stored, queries, 5, 4))
    finally:
        spark.conf.unset(sizing.BROADCAST_BYTES)
    data.same(got, want)
    data.same(again, want)


def test_product_arguments(spark):
    table = data.points(spark, np.eye(6))
    with pytest.raises(ValueError, match="not divisible"):
        quant.pq_train(table, 4)
    with pytest.raises(ValueError, match="256 codes on 6 rows"):
        quant.pq_train(table, 2)
    with pytest.raises(ValueError, match="nbits"):
        quant.pq_train(table, 2, nbits=9)


def test_graph_finds_stored_rows_first(spark):
    x = np.random.default_rng(1).random((100, 8))
    built = graph.graph_build(data.points(spark, x), 8)
    got = data.collected(graph.graph_search(built, data.queries(spark, x[:1]), 5))
    assert len(got[0]) == 5 and got[0][0] == (0, 0.0)


def test_graph_recall_on_held_out_queries(spark, corpus):
    table, queries, exact, _, _ = corpus
    built = graph.graph_build(table, 12)
    per_row = built.edges.groupBy("src").count().agg(F.min("count"), F.max("count")).first()
    assert per_row[0] >= 12 and per_row[1] <= 24
    assert data.recall(spark, graph.graph_search(built, queries, 10), exact) > 0.9


def test_graph_methods(spark, corpus):
    table, queries, exact, _, _ = corpus
    true = knn.self_knn(table, 8, exclude_self=True)
    with pytest.raises(ValueError, match="descent or exact"):
        graph.graph_build(table, 8, "magic")
    full = graph.graph_build(table, 8, "exact").edges.selectExpr("src AS qid", "dst AS id")
    assert data.recall(spark, full, true) == 1
    built = graph.graph_build(table, 8, nprobe=3)
    near = built.edges.selectExpr("src AS qid", "dst AS id")
    assert data.recall(spark, near, true) > 0.9
    assert data.recall(spark, graph.graph_search(built, queries, 10), exact) > 0.85


def test_search_of_all_lists_sends_no_query_to_each(spark, monkeypatch):
    x = data.blobs(300, 8, 6)
    index = ivf.ivf_build(data.points(spark, x), nlist=6, iterations=2)
    monkeypatch.setattr(ivf.sizing, "small_matrix", lambda *args, **kw: None)
    monkeypatch.setattr(ivf, "ivf_probes", None)
    found = ivf.ivf_search(index, data.queries(spark, x[:40]), 5, nprobe=6)
    data.same(data.collected(found), data.brute_force(x[:40], x, 5))
