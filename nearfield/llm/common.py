"""Helpers that several of the text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.plans import sizing

#: What separates words; everything else belongs to one.
GAP = r"[\x20\x09-\x0D]"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query of this subpackage, with its SQL twin if there is one."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """Words of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{GAP}+", -1), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def unused(df: DataFrame, *names: str) -> list[str]:
    """Those names, lengthened until no column of the table has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def filtered(df: DataFrame, condition: Column) -> DataFrame:
    """The rows that pass, with the table's columns computed once, before the filter.

    Spark moves a filter below deterministic columns by writing their expressions into it, so that
    costly ones would run twice and inside lambdas once per element. The partition's number, which
    Spark doesn't move, holds the filter in place.
    """
    (part,) = unused(df, "part")
    return df.withColumn(part, F.spark_partition_id()).filter(condition & (F.col(part) >= 0)).drop(part)


def new_path(spark: SparkSession) -> str:
    """Unused path in the folder that all executors share."""
    return f"{sizing.shared_folder(spark)}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read from there."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that one holds about ``most`` bytes of text or a single row."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        at = np.cumsum(size, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts of a batch; null reads as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]
