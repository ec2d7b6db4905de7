"""Product-quantized rows: costs from tables, rows without centroids."""

import numpy as np
import pytest

import data
from nearfield.functions import kernels
from nearfield.functions.kernels import Product, TopK
from nearfield.operators import ivf, quant
from nearfield.plans import sizing
from nearfield.sources import store


class Shared:
    def __init__(self, value):
        self.value = value


@pytest.fixture
def coded():
    rng = np.random.default_rng(4)
    product = Product(Shared(rng.normal(size=(4, 32, 3))), None)
    codes = rng.integers(0, 32, (3000, 4)).astype("u1")
    codes[500:1500] = codes[7]  # a third are copies
    return product, codes, rng.normal(size=12).astype("f4"), rng.normal(size=(20, 12)).astype("f4")


@pytest.mark.parametrize("metric", ["l2", "inner_product"])
def test_table_sums_equal_decoded_distances(coded, metric):
    product, codes, base, q = coded
    table, rest = product.tables(q, base, metric)
    x = product.vectors(codes, base).astype(float)
    want = ((q[:, None].astype(float) - x) ** 2).sum(2) if metric == "l2" else -(q.astype(float) @ x.T)
    got = sum(table[:, s][:, codes[:, s]] for s in range(4)) + rest[:, None]
    np.testing.assert_allclose(got, want, atol=1e-5)


@pytest.mark.parametrize("metric", ["l2", "inner_product"])
@pytest.mark.parametrize("rows", [17, 1 << 14])
def test_both_ways_of_scoring_agree(monkeypatch, coded, metric, rows):
    product, codes, base, q = coded
    monkeypatch.setattr(kernels, "TABLE_ROWS", rows)
    found = []
    for limit in (0, 100):
        monkeypatch.setattr(kernels, "TABLE_QUERIES", limit)
        best = TopK(np.arange(20), q, 6, metric)
        for s in range(0, 3000, 700):
            product.push(best, np.arange(3000)[s : s + 700], codes[s : s + 700], base, np.arange(3, 15))
        found.append((best.ids, best.cost))
    assert (found[0][0] == found[1][0]).all() and (found[0][1] == found[1][1]).all()
    assert (found[0][0][:3] == kernels.NO_ID).all()


@pytest.mark.parametrize("metric", ["l2", "inner_product"])
@pytest.mark.parametrize("n_queries", [2, 60])
def test_rows_hold_codes_only_at_every_size(spark, tmp_path, metric, n_queries):
    x = data.blobs(600, 8, 12, spread=0.4)
    table = data.points(spark, x, metric=metric, parts=3)
    plain = ivf.ivf_build(table, nlist=10)
    book = quant.pq_train(table, 4, 4, plain)
    q = data.queries(spark, x[:n_queries] + np.float32(0.01))
    want = None
    for limit in (None, "900", "100"):
        if limit:
            spark.conf.set(sizing.BROADCAST_BYTES, limit)
        try:
            index = quant.ivf_pq(plain, book)
            assert sorted(index.rows.columns) == ["codes", "id", "list_id"]
            path = f"{tmp_path}/{limit}"
            store.save(index, path)
            for held in (index, store.load(spark, path)):
                got = data.collected(ivf.ivf_search(held, q, 5, nprobe=4))
                want = want or got
                data.same(got, want)
            rebuilt = data.vec_of(quant.decoded(index), "id")
        finally:
            spark.conf.unset(sizing.BROADCAST_BYTES)
    decoded = np.array([rebuilt[i] for i in range(600)])
    lists = {r.id: r.list_id for r in plain.rows.collect()}
    probes = {}
    for r in ivf.ivf_probes(plain, q, 4).collect():
        probes.setdefault(r.qid, set()).add(r.list_id)
    for i, near in want.items():
        ids = [j for j in range(600) if lists[j] in probes[i]]
        exact = data.brute_force(x[i : i + 1] + np.float32(0.01), decoded[ids], 5, metric, ids)[0]
        np.testing.assert_allclose([d for _, d in near], [d for _, d in exact], atol=1e-5)
