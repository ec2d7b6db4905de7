"""Map-side top-k plans: one side is broadcast, the other is scanned in place."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearfield.functions.kernels import Product, TopK, int64, matrix
from nearfield.plans import sizing

RESULT = "qid long, rank int, id long, distance double"


def rank_merge(partial: DataFrame, k: int, metric: str, *extra: str) -> DataFrame:
    """Global top-k from partial top-k lists; equal distances go to the smaller id."""
    order = F.col("distance") if metric == "l2" else F.col("distance").desc()
    w = Window.partitionBy("qid").orderBy(order, "id")
    return (
        partial.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("qid", "rank", "id", "distance", *extra)
    )


def over_queries(queries: DataFrame, corpus, k: int, metric: str, dim: int) -> DataFrame:
    """The corpus is broadcast: every query batch finishes its ranks, no shuffle."""
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast(corpus)

    def search(batches):
        ids, rows = shared.value
        for batch in batches:
            best = TopK(int64(batch.column("qid")), matrix(batch.column("vec"), dim), k, metric)
            best.push(ids, rows)
            yield best.batch()

    return queries.select("qid", "vec").mapInArrow(search, RESULT)


def over_corpus(rows: DataFrame, queries, k: int, metric: str, decode) -> DataFrame:
    """The queries are broadcast: each task streams its rows past a running top-k.

    ``coalesce`` joins input splits without a shuffle, which bounds the number
    of partial lists to merge however many splits the corpus has.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(queries)

    def search(batches):
        best = TopK(*shared.value, k, metric)
        for batch in batches:
            best.push(int64(batch.column("id")), decode(batch))
        yield best.batch()

    partial = (
        rows.select("id", *decode.columns)
        .coalesce(sizing.merge_width(spark))
        .mapInArrow(search, RESULT)
    )
    return rank_merge(partial, k, metric)


def over_lists(rows: DataFrame, queries, probes, k: int, metric: str, decode, bases=None) -> DataFrame:
    """As ``over_corpus``, but a query only meets rows of the lists it probes.

    ``probes`` is ``(query position, list_id)`` as two arrays sorted by list.
    Only probed lists are read: on a stored table the filter prunes partitions.
    ``bases`` are centroids by list for product-quantized rows, if these are not broadcast.
    """
    spark = rows.sparkSession
    wanted, starts = np.unique(probes[1], return_index=True)
    groups = dict(zip(wanted.tolist(), np.split(probes[0], starts[1:])))
    shared = spark.sparkContext.broadcast((queries, groups, bases))
    product = isinstance(decode, Product)

    def search(batches):
        queries, groups, bases = shared.value
        best = TopK(*queries, k, metric)
        for batch in batches:
            lists = batch.column("list_id").to_numpy()
            ids, x = int64(batch.column("id")), decode.codes(batch) if product else decode(batch)
            order = np.argsort(lists, kind="stable")
            present, first = np.unique(lists[order], return_index=True)
            for list_id, pos in zip(present.tolist(), np.split(order, first[1:])):
                if product:
                    base = (decode.coarse.value if bases is None else bases)[list_id]
                    decode.push(best, ids[pos], x[pos], base, groups[list_id])
                else:
                    best.push(ids[pos], x[pos], groups[list_id])
        yield best.batch()

    partial = (
        rows.select("list_id", "id", *decode.columns)
        .coalesce(sizing.merge_width(spark))
        .mapInArrow(search, RESULT)
    )
    return rank_merge(partial, k, metric)
