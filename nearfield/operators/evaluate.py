"""Quality of approximate results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recall_at_k(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Per query, the share of its true neighbours that were found."""
    hits = approx.select("qid", "id", F.lit(1).alias("hit")).distinct()
    return (
        exact.select("qid", "id")
        .join(hits, ["qid", "id"], "left")
        .groupBy("qid")
        .agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
    )


def mean_recall(approx: DataFrame, exact: DataFrame) -> DataFrame:
    return recall_at_k(approx, exact).agg(F.avg("recall").alias("recall"))
