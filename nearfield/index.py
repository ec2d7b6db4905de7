"""One handle over every kind of table: create, train, add, search, look up, store."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from nearfield.operators import graph, ivf, knn, lookup, quant, shape
from nearfield.sources import store
from nearfield.sources.table import (
    VectorTable,
    append_sequential,
    append_with_ids,
    check_metric,
    check_positive,
    number_rows,
    vector_table,
)

KINDS = ("flat", "ivf", "ivf_half", "ivf_pq", "graph")


@dataclass(frozen=True)
class VectorIndex:
    """An index of one kind. Every change gives a new index over the old one.

    ``flat`` is exact. ``ivf``, ``ivf_half`` and ``ivf_pq`` search inverted
    lists of plain, half-precision and product-quantized rows and need
    training. ``graph`` searches a neighbour graph, built when rows are added.
    """

    spark: SparkSession
    dim: int
    kind: str
    metric: str
    params: dict
    table: VectorTable | None = None
    lists: ivf.IvfIndex | None = None
    graph: graph.GraphIndex | None = None

    @property
    def trained(self) -> bool:
        return self.lists is None or self.lists.trained

    def ntotal(self) -> int:
        """Rows in the index."""
        if self.lists is None:
            return self.table.df.count()
        return 0 if self.lists.rows is None else self.lists.rows.count()

    def train(self, sample: DataFrame, seed: int = 1) -> "VectorIndex":
        """Train on ``sample(id, vec)``; kinds without training ignore it.

        An index that holds rows refuses, as they lie in the lists of the model it has.
        """
        if self.lists is None:
            return self
        if self.lists.rows is not None and not self.lists.rows.isEmpty():
            raise RuntimeError("index holds rows: reset it before training it again")
        points = vector_table(sample, dim=self.dim, metric=self.metric)
        fresh = ivf.ivf_index(self.dim, self.params["nlist"], self.metric)
        lists = ivf.ivf_train(fresh, points, seed=seed)
        if not lists.trained:
            return self
        if self.kind == "ivf_half":
            lists = quant.ivf_half(lists)
        elif self.kind == "ivf_pq":
            book = quant.pq_train(points, self.params["m"], self.params["nbits"], lists, seed=seed)
            lists = quant.ivf_pq(lists, book)
        return replace(self, lists=lists)

    def add(self, df: DataFrame, order_by: str | list[str]) -> "VectorIndex":
        """Add ``df(vec, ...)`` under ids ``ntotal, ntotal + 1, ...`` in the given order."""
        self._require_trained()
        if self.lists is None:
            return self._with_table(append_sequential(self.table, df, order_by))
        start = self.ntotal()
        numbered, _ = number_rows(df.drop("id"), order_by, start)
        return self.add_with_ids(numbered)

    def add_with_ids(self, df: DataFrame) -> "VectorIndex":
        """Add ``df(id, vec, ...)`` under its own ids."""
        self._require_trained()
        if self.lists is None:
            return self._with_table(append_with_ids(self.table, df))
        points = vector_table(df, dim=self.dim, metric=self.metric)
        return replace(self, lists=ivf.ivf_add(self.lists, points))

    def search(
        self, queries: DataFrame, k: int, nprobe: int = 1, beam: int = 32, pad: bool = True
    ) -> DataFrame:
        """``(qid, rank, id, distance)`` for ``queries(qid, vec)``; exactly k rows each if padded."""
        check_positive("k", k)
        self._require_trained()
        queries = vector_table(queries, "qid", "vec", self.dim).df.withColumnRenamed("id", "qid")
        if self.lists is not None:
            if self.lists.rows is None:
                found = knn.knn_join(queries, self._empty(), k)
            else:
                found = ivf.ivf_search(self.lists, queries, k, nprobe)
        elif self.graph is not None:
            found = graph.graph_search(self.graph, queries, k, beam)
        else:
            found = knn.knn_join(queries, self.table, k)
        return shape.pad_results(found, queries, k) if pad else found

    def reconstruct(self, keys: DataFrame, on_missing: str = "error") -> DataFrame:
        """``(pos, id, vec)`` for ``keys(pos, id)``; decoded where rows are compressed."""
        return lookup.reconstruct(self._vectors(), keys, on_missing)

    def residuals(self, xs: DataFrame) -> DataFrame:
        """``(pos, id, residual)`` for ``xs(pos, id, vec)``."""
        return lookup.residuals(self._vectors(), xs)

    def reset(self) -> "VectorIndex":
        """No rows, same training; sequential ids restart at 0."""
        if self.lists is not None:
            return replace(self, lists=store.truncate(self.lists))
        return replace(self, table=store.truncate(self.table), graph=None)

    def save(self, path: str) -> None:
        """Write rows, training, graph, kind and parameters."""
        if self.lists is None:
            store.save(self.table, f"{path}/table")
        elif self.lists.trained:
            store.save(self.lists, f"{path}/lists")
        if self.graph is not None:
            store.save(self.graph.pivots, f"{path}/pivots")
            self.graph.edges.write.parquet(f"{path}/edges")
        state = {
            "dim": self.dim,
            "metric": self.metric,
            "params": self.params,
            "trained": self.trained,
            "graph": self.graph is not None,
        }
        store.commit(self.spark, path, kind=self.kind, **state)

    def clone(self, path: str) -> "VectorIndex":
        """Independent copy stored under the path."""
        self.save(path)
        return load_index(self.spark, path)

    def _require_trained(self) -> None:
        if not self.trained:
            raise RuntimeError("index is not trained: train it before add or search")

    def _empty(self) -> VectorTable:
        df = self.spark.createDataFrame([], "id long, vec array<float>")
        return VectorTable(df, self.dim, self.metric, 0)

    def _vectors(self) -> VectorTable:
        if self.lists is None:
            return self.table
        return self._empty() if self.lists.rows is None else quant.decoded_table(self.lists)

    def _with_table(self, table: VectorTable) -> "VectorIndex":
        out = replace(self, table=table)
        if self.kind != "graph":
            return out
        degree = self.params["degree"]
        if self.graph is None:
            return replace(out, graph=graph.graph_build(table, degree))
        # rows are only ever added
        added = table.df.join(self.table.df.select("id"), "id", "left_anti")
        return replace(out, graph=graph.graph_add(self.graph, table, added, degree))


def new_index(
    spark: SparkSession,
    dim: int,
    kind: str = "flat",
    metric: str = "l2",
    nlist: int = 1,
    m: int = 1,
    nbits: int = 8,
    degree: int = 16,
) -> VectorIndex:
    """Empty index. ``nlist`` is typically four times the root of the row count,
    ``m`` a quarter of the dimension."""
    check_positive("dim", dim)
    check_metric(metric)
    if kind not in KINDS:
        raise ValueError(f"invalid kind {kind!r}, expected one of {', '.join(KINDS)}")
    params = {"nlist": nlist, "m": m, "nbits": nbits, "degree": degree}
    index = VectorIndex(spark, dim, kind, metric, params)
    if kind.startswith("ivf"):
        return replace(index, lists=ivf.ivf_index(dim, nlist, metric))
    return replace(index, table=index._empty())


def load_index(spark: SparkSession, path: str) -> VectorIndex:
    """What :meth:`VectorIndex.save` wrote, of the same kind, training and parameters."""
    meta = store.read_meta(spark, path)
    index = VectorIndex(spark, meta["dim"], meta["kind"], meta["metric"], meta["params"])
    if meta["kind"].startswith("ivf"):
        if meta["trained"]:
            return replace(index, lists=store.load(spark, f"{path}/lists"))
        return replace(index, lists=ivf.ivf_index(index.dim, index.params["nlist"], index.metric))
    table = store.load(spark, f"{path}/table")
    if not meta["graph"]:
        return replace(index, table=table)
    edges = spark.read.parquet(f"{path}/edges")
    pivots = store.load(spark, f"{path}/pivots")
    return replace(index, table=table, graph=graph.GraphIndex(table, edges, pivots))
