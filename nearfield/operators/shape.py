"""Shaping of ranked search results ``(qid, rank, id, distance)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.operators.knn import cosine_knn
from nearfield.plans import sizing
from nearfield.plans.scan import rank_merge
from nearfield.sources.table import VectorTable, check_positive

# 4-byte words of a result row in memory, id aside
RESULT_WORDS = 8


def pad_results(found: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Exactly k rows per query; a missing rank has id -1 and no distance."""
    check_positive("k", k)
    slots = queries.select("qid", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"))
    # Spark takes a search's result for no larger than its queries and would broadcast it
    return slots.join(found.hint("merge"), ["qid", "rank"], "left").select(
        "qid", "rank", F.coalesce("id", F.lit(-1).cast("long")).alias("id"), "distance"
    )


def to_wide(found: DataFrame) -> DataFrame:
    """One row per query with ``labels`` and ``distances`` arrays in rank order."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "id", "distance")))
    return found.groupBy("qid").agg(ranked.alias("r")).select(
        "qid", F.col("r.id").alias("labels"), F.col("r.distance").alias("distances")
    )


def knn_merge(results: list[DataFrame], k: int, metric: str) -> DataFrame:
    """Global top-k from the top-k of each shard."""
    return rank_merge(reduce(DataFrame.unionByName, results), k, metric)


def within(found: DataFrame, threshold: float, column: str = "distance") -> DataFrame:
    """Rows whose distance lies below the threshold."""
    return found.filter(F.col(column) < threshold)


def semantic_search(queries: DataFrame, table: VectorTable, k: int) -> DataFrame:
    """Cosine top-k with the payload columns of the rows found.

    The k rows per query are broadcast to the table while they are few, so the
    payload is picked up where it lies.
    """
    spark, rows = table.df.sparkSession, queries.count()
    found = cosine_knn(queries, table, k, rows).withColumnRenamed("distance", "score")
    if sizing.fits(spark, rows * k, RESULT_WORDS):
        found = F.broadcast(found)
    return found.join(table.df.drop("vec"), "id")
