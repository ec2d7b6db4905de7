"""Exact top-k plan for two large sides, in two phases.

Rows belong to the region of their nearest pivot, itself a row. Each query first meets the rows of its
home region alone. Its k-th best distance there then bounds, by the triangle inequality, the regions that
may hold anything better, and only these meet it in the second phase. Where the visits that are left
would still score a large share of all pairs, as on vectors without clusters, sides meet in a grid of
tiles instead, whose tasks hold one side's tile and let the other side's rows stream by.

Rows, queries and visits are computed once each and written to the shared folder; only counts return
to the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.functions.kernels import Flat, TopK, int64, matrix, sq_norms
from nearfield.plans import scan, sizing, tiles

MAX_PIVOTS = 1024
BLOCK = 4096
#: Share of all pairs beyond which a grid serves better than visits to regions.
GRID_SHARE = 0.4


class RegionJoin:
    """The k best of ``rows(id, vec)`` for each of ``queries(qid, vec)``."""

    def __init__(self, queries: DataFrame, corpus: DataFrame, n: int, k: int, metric: str, dim: int):
        self.spark, self.n, self.k, self.metric, self.dim = corpus.sparkSession, n, k, metric, dim
        corpus = corpus.select("id", F.col("vec").cast("array<float>").alias("vec"))
        most = max(1, sizing.broadcast_bytes(self.spark) // (8 * dim))
        wanted = max(1, min(math.isqrt(n) + 1, MAX_PIVOTS, most))
        picked = corpus.orderBy(F.xxhash64("id"), "id").limit(wanted).toArrow()
        pivots = matrix(picked.column("vec"), dim).astype(np.float64)
        self.pivots = self.spark.sparkContext.broadcast(pivots)
        self.placed = sizing.cut_lineage(self._placed(corpus))
        self.counts, self.reach = self._regions(len(pivots))
        self.regions = self.spark.sparkContext.broadcast((self.counts, self.reach))
        at_home = self._at_home(queries).withColumn("at", F.monotonically_increasing_id())
        self.queries = sizing.cut_lineage(at_home)

    def result(self) -> DataFrame:
        """``(qid, rank, id, distance)``; queries that share an id are answered on their own."""
        if self.queries.groupBy("qid").count().filter(F.col("count") > 1).isEmpty():
            return self._found(self.queries.drop("at"))
        named = self.queries.select("at", F.col("qid").alias("name"))
        found = self._found(self.queries.withColumn("qid", F.col("at")).drop("at"))
        found = found.join(named, F.col("qid") == F.col("at")).withColumn("qid", F.col("name"))
        return found.select("qid", "rank", "id", "distance")

    def _found(self, queries: DataFrame) -> DataFrame:
        visits, first = self.visits(queries)
        done = visits.agg(F.count("*").alias("queries"), F.sum("pairs").alias("pairs")).first()
        if share(done.pairs, done.queries, self.n) > GRID_SHARE:
            sides = visits.select("qid", "vec", "bound"), self.placed.select("id", "vec")
            return grid_topk(*sides, done.queries, self.n, self.k, self.metric, self.dim)
        onward = visits.select("qid", "vec", "bound", F.explode("cells").alias("cell"))
        more = self._meet(onward)
        return scan.rank_merge(first.unionByName(more), self.k, self.metric)

    def visits(self, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``(qid, vec, bound, cells, pairs)`` of the second phase, and what the first one found."""
        first = sizing.cut_lineage(self._meet(queries.withColumnRenamed("home", "cell")))
        known = first.filter(F.col("rank") == self.k).select("qid", F.col("distance").alias("kth"))
        return sizing.cut_lineage(self._routed(queries.join(known, "qid", "left"))), first

    def _meet(self, probes: DataFrame) -> DataFrame:
        sizes = [(c, int(n)) for c, n in enumerate(self.counts) if n]
        sizes = self.spark.createDataFrame(sizes, "cell int, n long")
        probes, rows = probes.select("qid", "vec", "cell", "bound"), self.placed.select("cell", "id", "vec")
        cells = len(self.counts)
        return tiles.tile_topk(probes, rows, self.k, self.metric, Flat(self.dim), self.dim, cells, sizes)

    def _placed(self, corpus: DataFrame) -> DataFrame:
        """``(cell, radius, id, vec)``; no row lies farther from its pivot than ``radius``."""
        dim, pivots = self.dim, self.pivots

        def place(batches):
            for batch in batches:
                x = matrix(batch.column("vec"), dim)
                cell, radius = np.empty(len(x), np.int32), np.empty(len(x))
                for s in range(0, len(x), BLOCK):
                    _, d2, error = pivot_distances(x[s : s + BLOCK], pivots.value)
                    cell[s : s + BLOCK] = d2.argmin(axis=1)
                    radius[s : s + BLOCK] = np.sqrt((d2 + error).min(axis=1))
                columns = [pa.array(cell), pa.array(radius), batch.column("id"), batch.column("vec")]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "radius", "id", "vec"])

        return corpus.mapInArrow(place, "cell int, radius double, id long, vec array<float>")

    def _regions(self, cells: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each region, and how far from the pivot they reach."""
        counts, reach = np.zeros(cells, np.int64), np.zeros(cells)
        summary = self.placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("radius").alias("reach"))
        for row in summary.collect():
            counts[row.cell], reach[row.cell] = row.n, row.reach
        return counts, reach

    def _at_home(self, queries: DataFrame) -> DataFrame:
        """``(qid, vec, bound, home)``: pivots, being rows, give a first bound on the k-th best cost."""
        dim, k, metric, pivots, regions = self.dim, self.k, self.metric, self.pivots, self.regions

        def locate(batches):
            for batch in batches:
                for s in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(s, BLOCK)
                    q = matrix(part.column("vec"), dim)
                    dots, d2, error = pivot_distances(q, pivots.value)
                    worst = np.sqrt(d2 + error) if metric == "l2" else error - dots
                    near = np.where(regions.value[0] > 0, worst, np.inf)
                    bound = np.full(len(q), np.inf)
                    if worst.shape[1] >= k:
                        bound = np.partition(worst, k - 1, axis=1)[:, k - 1]
                    columns = [
                        part.column("qid"),
                        part.column("vec"),
                        pa.array(as_cost(bound, metric)),
                        pa.array(near.argmin(axis=1).astype(np.int32)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["qid", "vec", "bound", "home"])

        return queries.select("qid", "vec").mapInArrow(locate, "qid long, vec array<float>, bound double, home int")

    def _routed(self, queries: DataFrame) -> DataFrame:
        dim, metric, pivots, regions = self.dim, self.metric, self.pivots, self.regions
        names = ["qid", "vec", "bound", "cells", "pairs"]

        def route(batches):
            for batch in batches:
                for s in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(s, BLOCK)
                    counts, reach = regions.value
                    q = matrix(part.column("vec"), dim)
                    kth = part.column("kth").to_numpy(zero_copy_only=False).astype(float)
                    bound = np.fmin(part.column("bound").to_numpy(), kth if metric == "l2" else -kth)
                    keep = may_hold(q, pivots.value, reach, bound, metric) & (counts > 0)
                    keep[np.arange(len(q)), part.column("home").to_numpy()] = False
                    ends = np.concatenate([[0], keep.sum(axis=1).cumsum()]).astype(np.int32)
                    cells = pa.ListArray.from_arrays(ends, np.nonzero(keep)[1].astype(np.int32))
                    columns = [part.column("qid"), part.column("vec"), pa.array(bound), cells, pa.array(keep @ counts)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        schema = "qid long, vec array<float>, bound double, cells array<int>, pairs long"
        return queries.select("qid", "vec", "bound", "home", "kth").mapInArrow(route, schema)


def share(pairs: int | None, queries: int, rows: int) -> float:
    """Share of all pairs of a query and a row that are to be scored."""
    return (pairs or 0) / max(1, queries * rows)


def as_cost(bound: np.ndarray, metric: str) -> np.ndarray:
    """A bound on distances as one on costs, with room for rounding."""
    bound = bound + 1e-9 * np.abs(bound)
    return bound**2 if metric == "l2" else bound


def pivot_distances(x: np.ndarray, pivots: np.ndarray):
    """Dot products, squared distances and a bound on their rounding error."""
    x = x.astype(np.float64)
    dots = x @ pivots.T
    xx, pp = sq_norms(x)[:, None], sq_norms(pivots)[None, :]
    error = 8 * (x.shape[1] + 8) * np.finfo(np.float64).eps * (xx + pp)
    return dots, np.maximum(xx + pp - 2 * dots, 0), error


def may_hold(q, pivots, reach, bound, metric: str) -> np.ndarray:
    """Which regions may hold a row whose cost is within a query's bound.

    No row of a region lies farther from its pivot than ``reach``, so none costs less than the pivot
    does less that much.
    """
    dots, d2, error = pivot_distances(q, pivots)
    if metric == "l2":
        best = np.sqrt(np.maximum(d2 - error, 0)) - reach
        bound = np.sqrt(bound)
    else:
        best = -dots - error - np.sqrt(sq_norms(q.astype(np.float64)))[:, None] * reach
    return best <= (bound + 1e-9 * np.abs(bound))[:, None]


def grid_topk(queries: DataFrame, rows: DataFrame, nq: int, n: int, k: int, metric: str, dim: int) -> DataFrame:
    """Top-k of ``queries(qid, vec, bound)`` among ``rows(id, vec)``, all pairs.

    One side is held in tiles of bounded size, the other is dealt into as many slices as keep all cores
    busy; a task lets a slice stream past a tile. So a row of the streamed side travels once per tile,
    one of the held side once per slice. The side is held that makes fewer bytes travel.
    """
    spark = rows.sparkSession
    limit, cores = sizing.tile_rows(spark, dim), spark.sparkContext.defaultParallelism

    def shape(held: int) -> tuple[int, int]:
        parts = math.ceil(held / limit)
        return parts, max(1, math.ceil(cores / parts))

    (q_tiles, x_slices), (x_tiles, q_slices) = shape(max(nq, 1)), shape(max(n, 1))
    wide, result = 4 * dim + 16, 24 * k
    holding_queries = n * wide * q_tiles + nq * (wide + result) * x_slices
    holding_rows = nq * (wide + result) * x_tiles + n * wide * q_slices
    left = queries.select(F.col("qid").alias("key"), "vec", "bound")
    right = rows.select(F.col("id").alias("key"), "vec", F.lit(None).cast("double").alias("bound"))
    if hold_queries := holding_queries <= holding_rows:
        held, streamed, tiles_, slices = left, right, q_tiles, x_slices
    else:
        held, streamed, tiles_, slices = right, left, x_tiles, q_slices

    def dealt(df: DataFrame, side: int, own: str, parts: int, other: str, copies: int) -> DataFrame:
        return df.select(
            F.pmod(F.xxhash64("key", F.lit(side)), F.lit(parts)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other),
            F.lit(side).alias("side"),
            "key",
            "vec",
            "bound",
        )

    both = dealt(held, 0, "tile", tiles_, "slice", slices).unionByName(
        dealt(streamed, 1, "slice", slices, "tile", tiles_)
    )
    cell = (F.col("tile") * slices + F.col("slice")).alias("cell")
    both = both.select(cell, "side", "key", "vec", "bound")
    both = both.repartition(tiles_ * slices, "cell").sortWithinPartitions("cell", "side")

    def meet(batches):
        cell, kept, best = None, [], None
        for batch in batches:
            marks = batch.column("cell").to_numpy().astype(np.int64) * 2 + batch.column("side").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if marks[a] >> 1 != cell:
                    if best is not None:
                        yield best.batch()
                    cell, kept, best = marks[a] >> 1, [], None
                part = batch.slice(a, b - a)
                keys, x = int64(part.column("key")), matrix(part.column("vec"), dim)
                bound = part.column("bound").to_numpy(zero_copy_only=False)
                if not marks[a] & 1:
                    kept.append((keys, x, bound))
                elif kept:
                    if len(kept) > 1:
                        kept = [tuple(np.concatenate(c) for c in zip(*kept))]
                    if not hold_queries:
                        found = TopK(keys, x, k, metric, bound)
                        found.push(*kept[0][:2])
                        yield found.batch()
                        continue
                    if best is None:
                        best = TopK(kept[0][0], kept[0][1], k, metric, kept[0][2])
                    best.push(keys, x)
        if best is not None:
            yield best.batch()

    return scan.rank_merge(both.mapInArrow(meet, scan.RESULT), k, metric)
