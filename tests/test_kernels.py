import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from data import brute_force
from nearfield.functions import kernels
from nearfield.functions.kernels import TopK, binary_matrix, blobs, matrix, vectors, without_copies
from nearfield.plans import sizing


@settings(max_examples=60, deadline=None)
@given(
    seed=st.integers(0, 10**6),
    rows=st.integers(1, 700),
    dim=st.integers(1, 20),
    k=st.integers(1, 12),
    levels=st.sampled_from([2, 5, 1000]),
    offset=st.sampled_from([0.0, 50.0, 1e6]),
    metric=st.sampled_from(["l2", "inner_product"]),
    blocks=st.integers(1, 4),
)
def test_top_k_equals_brute_force(seed, rows, dim, k, levels, offset, metric, blocks):
    """Few levels give many copies and equal distances; offsets cost float32 precision."""
    rng = np.random.default_rng(seed)
    x = (rng.integers(0, levels, (rows, dim)) / 4 + offset).astype("f4")
    q = (rng.integers(0, levels, (9, dim)) / 4 + offset).astype("f4")
    ids = rng.permutation(rows) - rows // 2
    best = TopK(np.arange(9), q, k, metric)
    for part in np.array_split(np.arange(rows), blocks):
        best.push(ids[part], x[part])
    got = best.batch().to_pydict()
    want = brute_force(q, x, k, metric, ids)
    flat = [(qi, rank + 1, *pair) for qi in want for rank, pair in enumerate(want[qi])]
    assert list(zip(got["qid"], got["rank"], got["id"])) == [row[:3] for row in flat]
    np.testing.assert_allclose(got["distance"], [row[3] for row in flat], rtol=1e-12, atol=1e-9)


def test_bound_leaves_out_nothing_that_counts():
    x = np.arange(50, dtype="f4")[:, None]
    free, bound = TopK(np.arange(2), x[:2], 3, "l2"), TopK(np.arange(2), x[:2], 3, "l2", [4.0, 1.0])
    free.push(np.arange(50), x)
    bound.push(np.arange(50), x)
    assert free.batch().equals(bound.batch())


def test_copies_beyond_k_are_left_out():
    rows = np.zeros((40, 33), "f4")
    rows[30:, 1] = np.arange(10)
    rows[30, 1] = 7.5
    ids = np.arange(40)[::-1].copy()
    kept = without_copies(ids, rows, 3)
    assert len(kept) == 13 and set(ids[kept][ids[kept] >= 10]) == {10, 11, 12}
    assert without_copies(ids, rows, 30) is None


def test_arrow_round_trips():
    x = np.random.default_rng(0).random((7, 3), "f4")
    assert (matrix(vectors(x).slice(2, 4), 3) == x[2:6]).all()
    assert (binary_matrix(blobs(x).slice(1, 5), 3, "<f4") == x[1:6]).all()
    with pytest.raises(ValueError, match="non-null with 3 elements"):
        matrix(pa.array([[1.0, 2.0], [1.0, 2.0, 3.0, 4.0]], pa.list_(pa.float32())), 3)
    with pytest.raises(ValueError, match="null element"):
        matrix(pa.array([[1.0, None, 2.0]], pa.list_(pa.float32())), 3)
    with pytest.raises(ValueError, match="12 bytes"):
        binary_matrix(pa.array([b"abc"]), 3, "<f4")


def peak(work) -> int:
    tracemalloc.start()
    work()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_putting_rows_together_takes_little_more_than_they_do():
    rng = np.random.default_rng(4)
    books, base = rng.normal(size=(16, 32, 4)), rng.normal(size=64)
    codes = rng.integers(0, 32, (40_000, 16)).astype("u1")
    decode = kernels.Product(SimpleNamespace(value=books), None)
    got = decode.vectors(codes, base)
    assert (got == (books[np.arange(16), codes].reshape(-1, 64) + base).astype("f4")).all()
    assert (decode.vectors(codes, np.tile(base, (len(codes), 1))) == got).all()
    assert peak(lambda: decode.vectors(codes, base)) < 2 * got.nbytes


def test_tiles_leave_room_for_results(spark):
    assert sizing.tile_rows(spark, 64, 50) * (4 * 64 + 16 * 50) <= 32 << 20


def test_copies_are_told_in_little_memory():
    x = np.repeat(np.random.default_rng(5).normal(size=(700, 64)).astype("f4"), 60, 0)
    ids = np.arange(len(x))
    kept = kernels.without_copies(ids, x, 10)
    assert (kept == ids[ids % 60 < 10]).all()
    assert peak(lambda: kernels.without_copies(ids, x, 10)) < x.nbytes
