"""Inverted-list tables: rows grouped by nearest centroid, searched list by list."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.functions import kernels
from nearfield.functions.kernels import Flat, Product, TopK, matrix
from nearfield.operators.kmeans import KMeansModel, kmeans_train, with_cluster
from nearfield.operators.knn import knn_join, numbered, own_ids
from nearfield.plans import scan, sizing, tiles
from nearfield.sources.table import (
    VectorTable,
    append_with_ids,
    check_metric,
    check_positive,
    vector_table,
)

MAX_PROBED_LISTS = 4096


@dataclass(frozen=True)
class IvfIndex:
    """Rows ``(list_id, id, <vector columns>, payload...)`` under trained centroids.

    ``encode`` compresses rows ``(list_id, id, vec, ...)`` as they are added, and
    ``decode`` turns a batch of stored rows back into vectors. ``bucket_lists``
    is the number of neighbouring lists that share a stored partition.
    """

    dim: int
    nlist: int
    metric: str = "l2"
    model: KMeansModel | None = None
    rows: DataFrame | None = None
    encode: Callable[[DataFrame], DataFrame] | None = None
    decode: Callable | None = None
    bucket_lists: int | None = None

    @property
    def trained(self) -> bool:
        return self.model is not None

    def require(self) -> "IvfIndex":
        if not self.trained:
            raise RuntimeError("index is not trained: train it before add or search")
        return self

    def require_rows(self) -> DataFrame:
        self.require()
        if self.rows is None:
            raise RuntimeError("index holds no vectors")
        return self.rows


def ivf_index(dim: int, nlist: int, metric: str = "l2") -> IvfIndex:
    """Untrained index."""
    return IvfIndex(check_positive("dim", dim), check_positive("nlist", nlist), check_metric(metric))


def default_nlist(rows: int) -> int:
    return max(1, round(4 * math.sqrt(rows)))


def ivf_train(
    index: IvfIndex,
    sample: VectorTable,
    iterations: int = 25,
    init: DataFrame | None = None,
    seed: int = 1,
) -> IvfIndex:
    """Index with centroids trained on the sample; training on no rows changes nothing.

    At least ``40 * nlist`` sample rows give well-placed centroids.
    """
    if sample.count() == 0:
        return index
    model = kmeans_train(sample, index.nlist, iterations, init, seed)
    return with_quantizer(index, model)


def with_quantizer(index: IvfIndex, model: KMeansModel) -> IvfIndex:
    """Index that uses the centroids of an already trained k-means model."""
    if model.require().dim != index.dim:
        raise ValueError(f"model has dim {model.dim}, expected {index.dim}")
    return replace(index, nlist=model.k, model=model)


def ivf_add(index: IvfIndex, table: VectorTable) -> IvfIndex:
    """Index with the rows of ``table`` added to the lists of their nearest centroids."""
    index.require()
    if table.dim != index.dim:
        raise ValueError(f"table has dim {table.dim}, expected {index.dim}")
    listed = to_lists(index, table.df)
    if index.encode is not None:
        listed = index.encode(listed)
    if index.bucket_lists:
        listed = with_bucket(listed, index.bucket_lists)
    rows = listed if index.rows is None else index.rows.unionByName(listed, True)
    return replace(index, rows=rows, decode=index.decode or Flat(index.dim))


def with_bucket(rows: DataFrame, bucket_lists: int) -> DataFrame:
    """Rows with the number of the stored partition their list belongs to."""
    return rows.withColumn("bucket", F.floor(F.col("list_id") / bucket_lists).cast("int"))


def to_lists(index: IvfIndex, df: DataFrame) -> DataFrame:
    """Rows with their ``list_id``; map-only while the centroids can be broadcast."""
    return with_cluster(df, index.require().model.table, "list_id", index.metric).drop("distance")


def ivf_probes(index: IvfIndex, queries: DataFrame, nprobe: int) -> DataFrame:
    """``(qid, vec, list_id)`` for the nprobe nearest lists of each query.

    Map-only while the centroids can be broadcast.
    """
    check_positive("nprobe", nprobe)
    table, dim, metric = index.require().model.table, index.dim, index.metric
    queries = queries.select("qid", "vec")
    local = sizing.small_matrix(table.df, "id", dim, table.rows)
    if local is None:
        found = knn_join(queries, table, nprobe, metric)
        found = found.select("qid", F.col("id").cast("int").alias("list_id"))
        return queries.join(found, "qid")
    shared = table.df.sparkSession.sparkContext.broadcast(local)
    k = min(nprobe, len(local[0]))

    @F.arrow_udf("array<int>")
    def nearest_lists(vec: pa.Array) -> pa.Array:
        x = matrix(vec, dim)
        best = TopK(np.arange(len(x)), x, k, metric)
        best.push(*shared.value)
        ends = np.arange(0, (len(x) + 1) * k, k, dtype=np.int32)
        return pa.ListArray.from_arrays(ends, best.ids.ravel().astype(np.int32))

    return queries.select("qid", "vec", F.explode(nearest_lists("vec")).alias("list_id"))


def ivf_search(index: IvfIndex, queries: DataFrame, k: int, nprobe: int = 1) -> DataFrame:
    """Top-k among the rows of the ``nprobe`` nearest lists of each query.

    With few queries only the probed lists are scanned, in place. With many,
    both sides are shuffled on the list and long lists are cut into tiles; if
    they probe all lists, the exact join serves.
    Queries that share an id are each answered on their own.
    """
    check_positive("k", k)
    rows = index.require_rows()
    spark, dim = rows.sparkSession, index.dim
    nprobe = min(check_positive("nprobe", nprobe), index.nlist)
    small = sizing.small_matrix(queries, "qid", dim, k=k)
    # beside the probes, centroids of the probed lists may have to be sent along
    wide = dim if _own_base(index) else 2
    if small is not None and sizing.fits(spark, len(small[0]) * nprobe, wide):
        small, back = numbered(spark, small)
        vectors = pa.table({"qid": pa.array(small[0]), "vec": kernels.vectors(small[1])})
        few = spark.createDataFrame(vectors, "qid long, vec array<float>")
        return back(_scan_lists(index, small, ivf_probes(index, few, nprobe), k))
    if nprobe == index.nlist and isinstance(index.decode, Flat):
        # every row is met, so none has to be dealt by its list, nor a query to all lists
        return knn_join(queries, VectorTable(rows.select("id", "vec"), dim, index.metric), k)
    queries, back = own_ids(queries)
    visits = ivf_probes(index, queries, nprobe).withColumnRenamed("list_id", "cell")
    if _own_base(index):
        centroids = index.model.table.df.select(
            F.col("id").cast("int").alias("cell"), F.col("vec").cast("array<float>").alias("base")
        )
        visits = visits.join(centroids, "cell")
    cells = rows.select(F.col("list_id").alias("cell"), "id", *index.decode.columns)
    return back(tiles.tile_topk(visits, cells, k, index.metric, index.decode, dim, index.nlist))


def _own_base(index: IvfIndex) -> bool:
    """Whether searches have to bring the centroids of the lists along."""
    return isinstance(index.decode, Product) and index.decode.coarse is None


def _scan_lists(index: IvfIndex, queries, probes: DataFrame, k: int) -> DataFrame:
    qids, mat = queries
    order = np.argsort(qids, kind="stable")
    qids, mat = qids[order], mat[order]
    pairs = probes.select("qid", "list_id").toArrow()
    lists = pairs.column("list_id").to_numpy()
    position = np.searchsorted(qids, pairs.column("qid").to_numpy())
    by_list = np.lexsort((position, lists))
    probed = np.unique(lists)
    rows = only_lists(index, probed.tolist())
    bases = None
    if _own_base(index):
        # no more than there are probes, which fit the broadcast limit
        wanted = rows.sparkSession.createDataFrame([(i,) for i in probed.tolist()], "id long")
        found = index.model.table.df.join(F.broadcast(wanted), "id", "left_semi").select("id", "vec").toArrow()
        bases = dict(zip(found.column("id").to_pylist(), matrix(found.column("vec"), index.dim)))
    pairs = position[by_list], lists[by_list]
    return scan.over_lists(rows, (qids, mat), pairs, k, index.metric, index.decode, bases)


def only_lists(index: IvfIndex, lists: list[int]) -> DataFrame:
    """Rows of the given lists. On a stored index other partitions are not read."""
    rows = index.require_rows()
    if index.bucket_lists:
        buckets = sorted({i // index.bucket_lists for i in lists})
        rows = rows.filter(F.col("bucket").isin(buckets))
    if len(lists) > MAX_PROBED_LISTS:
        wanted = rows.sparkSession.createDataFrame([(i,) for i in lists], "list_id int")
        return rows.join(F.broadcast(wanted), "list_id", "left_semi")
    return rows.filter(F.col("list_id").isin(lists))


def list_sizes(index: IvfIndex) -> DataFrame:
    return index.require_rows().groupBy("list_id").agg(F.count("*").alias("rows"))


def ivf_build(
    table: VectorTable,
    nlist: int | None = None,
    model: KMeansModel | None = None,
    iterations: int = 25,
    seed: int = 1,
) -> IvfIndex:
    """Train (unless a model is given) and add in one call."""
    if model is None:
        nlist = nlist or default_nlist(table.count())
        index = ivf_train(ivf_index(table.dim, nlist, table.metric), table, iterations, None, seed)
    else:
        index = with_quantizer(ivf_index(table.dim, model.k, table.metric), model)
    return ivf_add(index, table)
