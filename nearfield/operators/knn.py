"""Exact top-k similarity join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearfield.functions import expr
from nearfield.functions.kernels import Flat, matrix, sq_norms, vectors
from nearfield.plans import regions, scan, sizing
from nearfield.sources.table import VectorTable, check_metric, check_positive, checked, whole_id

#: Rows that are broadcast however many queries there are, and pairs beyond which more rows are not.
FEW_ROWS = 1 << 15
BROADCAST_PAIRS = 1 << 36


def as_queries(df: DataFrame, id: str = "qid", vec: str = "vec") -> DataFrame:
    """Query rows ``(qid, vec)`` from any id and vector column; an id that is no integer fails."""
    return df.select(
        whole_id(df, id).alias("qid"), F.col(vec).cast("array<float>").alias("vec")
    )


def knn_join(
    queries: DataFrame,
    table: VectorTable,
    k: int,
    metric: str | None = None,
    query_rows: int | None = None,
) -> DataFrame:
    """The k nearest rows of ``table`` for each of ``queries(qid, vec)``.

    Result rows are ``(qid, rank, id, distance)``: squared L2 ascending, or
    inner product descending, equal values by smaller id.

    A side within the broadcast limit is broadcast: a small table makes the
    join map-only, small queries make it one scan with a merge of short lists.
    Two large sides meet in regions of the table, or all in a grid of tiles, as
    do a broadcast table's rows with so many queries that scoring all pairs would
    take longest.
    A query of another size, or with a missing, NaN or infinite element, fails
    the job, as a bad row of the table does. Queries that share an id are each
    answered on their own.
    """
    check_positive("k", k)
    metric = check_metric(metric or table.metric)
    dim = table.dim
    queries = checked(queries.select("qid", "vec"), dim, "qid")
    spark, rows = queries.sparkSession, table.count()
    if rows > FEW_ROWS and query_rows is None:
        query_rows = queries.count()
    if rows <= FEW_ROWS or rows * query_rows <= BROADCAST_PAIRS:
        corpus = sizing.small_matrix(table.df, "id", dim, rows)
        if corpus is not None:
            return scan.over_queries(queries, corpus, k, metric, dim)
    small = sizing.small_matrix(queries, "qid", dim, query_rows, k)
    if small is not None:
        small, back = numbered(spark, small)
        return back(scan.over_corpus(table.df, small, k, metric, Flat(dim)))
    return regions.RegionJoin(queries, table.df, rows, k, metric, dim).result()


def numbered(spark: SparkSession, queries):
    """Collected ``(qids, vectors)`` with an id of its own for each, and how results get theirs back."""
    qids, mat = queries
    if len(np.unique(qids)) == len(qids):
        return queries, lambda found: found
    rows = pa.table({"_at": pa.array(np.arange(len(qids))), "_qid": pa.array(qids)})
    names = spark.createDataFrame(rows, "_at long, _qid long")
    return (np.arange(len(qids)), mat), lambda found: _renamed(found, F.broadcast(names))


def own_ids(queries: DataFrame):
    """The same for a table of queries; one whose ids are all different stays as it is."""
    if queries.groupBy("qid").count().filter(F.col("count") > 1).isEmpty():
        return queries, lambda found: found
    keyed = sizing.cut_lineage(queries.withColumn("_at", F.monotonically_increasing_id()))
    names = keyed.select("_at", F.col("qid").alias("_qid"))
    return keyed.select(F.col("_at").alias("qid"), "vec"), lambda found: _renamed(found, names)


def _renamed(found: DataFrame, names: DataFrame) -> DataFrame:
    named = found.join(names, F.col("qid") == F.col("_at")).withColumn("qid", F.col("_qid"))
    return named.select(*found.columns)


def self_knn(table: VectorTable, k: int, metric: str | None = None, exclude_self: bool = False):
    """The table searched with its own rows; rank 1 is usually the row itself."""
    queries = as_queries(table.df, "id")
    if not exclude_self:
        return knn_join(queries, table, k, metric, table.rows)
    found = knn_join(queries, table, k + 1, metric, table.rows)
    return without_self(found, k)


def without_self(found: DataFrame, k: int) -> DataFrame:
    """Drops a query's own id from ranked results and closes the gap, keeping k."""
    own = F.max(F.when(F.col("qid") == F.col("id"), F.col("rank"))).over(
        Window.partitionBy("qid")
    )
    return (
        found.withColumn("_own", own)
        .filter(F.col("qid") != F.col("id"))
        .withColumn(
            "rank", F.col("rank") - F.when(F.col("rank") > F.col("_own"), 1).otherwise(0)
        )
        .filter(F.col("rank") <= k)
        .drop("_own")
    )


def cosine_knn(
    queries: DataFrame, table: VectorTable, k: int, query_rows: int | None = None
) -> DataFrame:
    """Top-k by cosine similarity. Zero vectors on either side have no direction
    and take no part; see ``l2_normalize`` to report them."""
    unit_queries, _ = l2_normalize(queries)
    unit_rows, _ = l2_normalize(table.df)
    unit_table = VectorTable(unit_rows, table.dim, "inner_product", table.count())
    return knn_join(unit_queries, unit_table, k, query_rows=query_rows)


def l2_normalize(df: DataFrame, vec: str = "vec") -> tuple[DataFrame, DataFrame]:
    """Unit-length rows, and the zero vectors that have no direction."""

    @F.arrow_udf("array<float>")
    def scale(v: pa.Array) -> pa.Array:
        x = matrix(v, len(v[0])) if len(v) else np.empty((0, 1), np.float32)
        x = x.astype(np.float64)
        length = np.sqrt(sq_norms(x))
        unit = vectors(x / np.where(length > 0, length, 1)[:, None])
        return pc.if_else(pa.array(length > 0), unit, pa.scalar(None, unit.type))

    # not deterministic: the filter must not run the function a second time
    scaled = df.withColumn("_unit", scale.asNondeterministic()(vec))
    good = scaled.filter(F.col("_unit").isNotNull()).withColumn(vec, F.col("_unit"))
    rejects = df.filter(expr.l2_norm(vec) == 0).withColumn("reason", F.lit("zero_norm"))
    return good.drop("_unit"), rejects


