"""Retrieval by id: reconstruct, id ranges, residuals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.functions.expr import vector_subtract
from nearfield.plans import sizing
from nearfield.sources.table import VectorTable

KEY_BYTES = 32
#: Keys that are looked up one by one.
FEW = 1000


def reconstruct(table: VectorTable, keys: DataFrame, on_missing: str = "error") -> DataFrame:
    """Vectors for ``keys(pos, id)`` as ``(pos, id, vec)``; duplicate keys are kept.

    An unknown id fails the job, or gives a NULL vector with
    ``on_missing='null'``. An id stored twice has no single vector and fails.
    """
    if on_missing not in ("error", "null"):
        raise ValueError("on_missing must be 'error' or 'null'")
    spark = table.df.sparkSession
    few = keys.select("id").limit(FEW + 1).toArrow().column("id").to_pylist()
    if len(few) <= FEW:
        # the ids reach the Parquet scan, and no more than the files that may hold them are read
        rows = table.holding(sorted({i for i in few if i is not None})).select("id", "vec")
    else:
        wanted = keys.select("id").distinct()
        # many keys: broadcast them if they fit and the table is scanned where it lies
        if keys.count() * KEY_BYTES <= sizing.broadcast_bytes(spark):
            wanted = F.broadcast(wanted)
        rows = table.df.select("id", "vec").join(wanted, "id")
    twice = F.raise_error(
        F.concat(F.lit("id "), F.col("id"), F.lit(" is stored more than once"))
    )
    found = (
        rows.groupBy("id")
        .agg(F.count("*").alias("n"), F.first("vec").alias("vec"))
        .select("id", F.when(F.col("n") == 1, F.col("vec")).otherwise(twice).alias("vec"))
    )
    out = keys.select("pos", "id").join(found, "id", "left")
    vec: Column = F.col("vec")
    if on_missing == "error":
        vec = F.coalesce(
            vec, F.raise_error(F.concat(F.lit("id "), F.col("id"), F.lit(" not found")))
        )
    return out.select("pos", "id", vec.alias("vec"))


def in_order(df: DataFrame) -> DataFrame:
    """Looked-up rows in request order."""
    return df.orderBy("pos")


def reconstruct_range(table: VectorTable, start: int, rows: int) -> DataFrame:
    """Vectors of ``rows`` consecutive ids; the range reaches the Parquet scan."""
    if rows < 0:
        raise ValueError("rows must not be negative")
    return table.df.filter(F.col("id").between(start, start + rows - 1)).select("id", "vec")


def residuals(table: VectorTable, xs: DataFrame) -> DataFrame:
    """``(pos, id, residual)`` with ``vec`` of ``xs(pos, id, vec)`` minus the stored vector.

    ``pos`` identifies a row of ``xs``.
    """
    stored = reconstruct(table, xs.select("pos", "id")).withColumnRenamed("vec", "stored")
    return xs.join(stored, ["pos", "id"]).select(
        "pos", "id", vector_subtract("vec", "stored").alias("residual")
    )
