"""Shuffled top-k plan for two large sides that meet on a cell number.

A cell is an inverted list or a region of the corpus. Cells with many rows or
many visiting queries are cut into a grid of tiles of bounded size, so a cell
holding a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.functions.kernels import Product, TopK, int64, matrix
from nearfield.plans import scan, sizing

TILE = ["cell", "q_part", "x_part"]


def tile_topk(
    probes: DataFrame,
    rows: DataFrame,
    k: int,
    metric: str,
    decode,
    dim: int,
    cells: int,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Top-k of ``probes(qid, vec, cell[, bound][, base])`` among ``rows(cell, id, ...)``.

    ``bound`` is a cost that the k-th best row of a query does not exceed, ``base`` the centroid
    of the cell for product-quantized rows whose centroids are not broadcast.

    ``cells`` bounds the number of distinct cells and with it the size of the
    table of splits that both sides look up. ``sizes(cell, n)`` are the rows
    per cell where they are known already.
    """
    spark = rows.sparkSession
    bounds = [c for c in probes.columns if c in ("bound", "base")]
    limit = sizing.tile_rows(spark, dim)
    if sizes is None:
        sizes = rows.groupBy("cell").agg(F.count("*").alias("n"))
    visits = probes.groupBy("cell").agg(F.count("*").alias("n"))
    splits = _parts(visits, sizing.tile_rows(spark, dim, k), "q_parts").join(_parts(sizes, limit, "x_parts"), "cell")
    if cells * 16 <= sizing.broadcast_bytes(spark):
        splits = F.broadcast(splits)
    left = (
        probes.join(splits, "cell")
        .withColumn("q_part", _part("qid", "q_parts"))
        .withColumn("x_part", F.explode(F.sequence(F.lit(0), F.col("x_parts") - 1)))
        .select(*TILE, "qid", "vec", *bounds)
    )
    right = (
        rows.join(splits, "cell")
        .withColumn("x_part", _part("id", "x_parts"))
        .withColumn("q_part", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)))
        .select(*TILE, "id", F.col("cell").alias("list_id"), *decode.columns)
    )

    def search(queries: pa.Table, corpus: pa.Table) -> pa.Table:
        bound = queries.column("bound").to_numpy() if "bound" in bounds else np.inf
        q = matrix(queries.column("vec"), dim)
        best = TopK(int64(queries.column("qid")), q, k, metric, bound)
        ids = int64(corpus.column("id"))
        if corpus.num_rows and queries.num_rows and isinstance(decode, Product):
            # all rows of a cell lie in one list
            if "base" in bounds:
                base = matrix(queries.column("base").slice(0, 1), dim)[0]
            else:
                base = decode.coarse.value[corpus.column("list_id")[0].as_py()]
            decode.push(best, ids, decode.codes(corpus), base)
        elif corpus.num_rows:
            best.push(ids, decode(corpus))
        return pa.Table.from_batches([best.batch()])

    partial = (
        left.groupBy(*TILE).cogroup(right.groupBy(*TILE)).applyInArrow(search, scan.RESULT)
    )
    return scan.rank_merge(partial, k, metric)


def _parts(sizes: DataFrame, limit: int, name: str) -> DataFrame:
    return sizes.select("cell", F.ceil(F.col("n") / limit).cast("int").alias(name))


def _part(key: str, parts: str) -> Column:
    return F.pmod(F.xxhash64(key), F.col(parts)).cast("int")
