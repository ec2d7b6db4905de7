"""Lookup of a few ids in stored tables."""

from dataclasses import replace

import pytest

import data
from nearfield.operators import lookup
from nearfield.sources import store
from nearfield.sources.table import append_with_ids


@pytest.fixture
def saved(spark, tmp_path):
    """4,000 rows by id in many files."""
    x = data.blobs(4000, 3, 5)
    table = data.points(spark, x, parts=3)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.save(table, f"{tmp_path}/t", sort_by_id=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return x, store.load(spark, f"{tmp_path}/t")


def keys(spark, ids):
    return spark.createDataFrame(list(enumerate(ids)), "pos long, id long")


def looked_up(found):
    return {r.pos: None if r.vec is None else list(r.vec) for r in found.collect()}


def test_only_files_that_may_hold_the_ids_are_read(spark, saved):
    x, table = saved
    assert len(table.df.inputFiles()) == 64
    ids = [3999, 5, 5, 17, 2000]
    held = table.holding([5, 17, 2000, 3999])
    assert len(held.inputFiles()) == 3
    got = looked_up(lookup.reconstruct(table, keys(spark, ids)))
    assert got == {p: x[i].tolist() for p, i in enumerate(ids)}
    assert len(table.holding(list(range(0, 4000, 40))).inputFiles()) <= 64
    assert table.holding([]).count() == table.holding([4001, -1]).count() == 0


def test_missing_and_null_keys(spark, saved):
    x, table = saved
    got = looked_up(lookup.reconstruct(table, keys(spark, [7, -3, None, 9999]), "null"))
    assert got == {0: x[7].tolist(), 1: None, 2: None, 3: None}
    with pytest.raises(Exception, match="id 9999 not found"):
        lookup.reconstruct(table, keys(spark, [7, 9999])).collect()


def test_many_keys_take_the_other_way(spark, saved, monkeypatch):
    x, table = saved
    monkeypatch.setattr(lookup, "FEW", 3)
    ids = [9, 8, 7, 3000]
    got = looked_up(lookup.reconstruct(table, keys(spark, ids)))
    assert got == {p: x[i].tolist() for p, i in enumerate(ids)}


def test_ranges_serve_no_other_rows_than_their_own(spark, saved):
    _, table = saved
    more = append_with_ids(table, data.rows(spark, [[1.0, 2.0, 3.0]], [70_000]))
    assert looked_up(lookup.reconstruct(more, keys(spark, [70_000]))) == {0: [1.0, 2.0, 3.0]}
    less = replace(table, df=table.df.filter("id > 10"))
    assert looked_up(lookup.reconstruct(less, keys(spark, [4]), "null")) == {0: None}
