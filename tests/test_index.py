import numpy as np
import pytest

import data
from nearfield import load_index, new_index

KINDS = {
    "flat": {},
    "ivf": {"nlist": 4},
    "ivf_half": {"nlist": 4},
    "ivf_pq": {"nlist": 4, "m": 4, "nbits": 5},
    "graph": {"degree": 8},
}


@pytest.mark.parametrize("kind", KINDS)
def test_life_of_an_index(spark, tmp_path, kind):
    x = data.blobs(200, 8, 4)
    index = new_index(spark, 8, kind, **KINDS[kind])
    assert index.ntotal() == 0
    rows = data.rows(spark, x)
    q = data.queries(spark, x[:3])
    if kind.startswith("ivf"):
        assert not index.trained
        for attempt in (lambda: index.add_with_ids(rows), lambda: index.search(q, 2)):
            with pytest.raises(RuntimeError, match="train"):
                attempt()
        assert not index.train(rows.filter("id < 0")).trained
        index = index.train(rows)
    assert index.trained
    empty = data.collected(index.search(q, 2))
    assert [i for i, _ in empty[0]] == [-1, -1]
    index = index.add(rows.withColumnRenamed("id", "place"), "place")
    assert index.ntotal() == 200
    found = data.collected(index.search(q, 3, nprobe=4))
    assert all(len(found[i]) == 3 for i in range(3))
    if kind in ("flat", "ivf", "graph"):
        assert [found[i][0][0] for i in range(3)] == [0, 1, 2]
    keys = spark.createDataFrame([(0, 5)], "pos int, id long")
    np.testing.assert_allclose(index.reconstruct(keys).first().vec, x[5], atol=0.5)
    xs = spark.createDataFrame([(0, 5, x[5].tolist())], "pos int, id long, vec array<float>")
    np.testing.assert_allclose(index.residuals(xs).first().residual, np.zeros(8), atol=0.5)
    copy = index.clone(f"{tmp_path}/{kind}")
    assert (copy.kind, copy.params) == (kind, index.params)
    assert data.collected(copy.search(q, 3, nprobe=4)) == found
    if kind.startswith("ivf"):
        with pytest.raises(RuntimeError, match="reset it before"):
            copy.train(rows)
        assert data.collected(copy.search(q, 3, nprobe=4)) == found
    more = copy.add_with_ids(data.rows(spark, x[:1], [-7]))
    assert (more.ntotal(), copy.ntotal(), index.ntotal()) == (201, 200, 200)
    emptied = more.reset()
    assert emptied.trained and emptied.ntotal() == 0
    again = emptied.add(rows.withColumnRenamed("id", "place"), "place")
    assert data.collected(again.search(q, 3, nprobe=4)) == found
    assert load_index(spark, f"{tmp_path}/{kind}").ntotal() == 200
    # trained but empty: compression and training survive
    bare = emptied.clone(f"{tmp_path}/{kind}-bare")
    assert bare.trained and bare.ntotal() == 0
    refilled = bare.add(rows.withColumnRenamed("id", "place"), "place")
    assert data.collected(refilled.search(q, 3, nprobe=4)) == found
    if kind.startswith("ivf"):
        assert bare.train(rows).trained
    # untrained
    fresh = new_index(spark, 8, kind, **KINDS[kind]).clone(f"{tmp_path}/{kind}-fresh")
    assert fresh.trained == (not kind.startswith("ivf")) and fresh.ntotal() == 0


def test_kind_is_checked(spark):
    with pytest.raises(ValueError, match="expected one of flat"):
        new_index(spark, 4, "tree")


def test_queries_are_checked(spark):
    index = new_index(spark, 3).add_with_ids(data.rows(spark, np.eye(3)))
    with pytest.raises(Exception, match="vector 0 rejected: wrong_dim"):
        index.search(data.queries(spark, [(1, 2)]), 1).collect()
