"""Saved tables: Parquet folders with a metadata row written last as commit marker."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nearfield.functions.kernels import Flat, Product
from nearfield.operators.ivf import IvfIndex, with_bucket
from nearfield.operators.kmeans import KMeansModel
from nearfield.operators.quant import Codebook, codebook, ivf_half, product_rows
from nearfield.sources.table import SortedFiles, VectorTable

MAX_BUCKETS = 2000


def save(table: VectorTable | IvfIndex | KMeansModel, path: str, sort_by_id: bool = False):
    """Write a table, index or model; the path must not hold one already.

    ``sort_by_id`` range-partitions a plain table by id, so that id ranges skip
    files. Lists are written in buckets of neighbouring lists, sorted by list;
    the range partitioning on ``(list_id, id)`` splits a long list over tasks.
    """
    if isinstance(table, KMeansModel):
        _save_model(table, path)
    elif isinstance(table, IvfIndex):
        _save_lists(table, path)
    else:
        df = table.df
        if sort_by_id:
            df = df.repartitionByRange("id").sortWithinPartitions("id")
        rows = _write(df, f"{path}/vectors")
        if sort_by_id:
            _write_ranges(table.df.sparkSession, path)
        commit(table.df.sparkSession, path, kind="flat", rows=rows, sorted=sort_by_id, **_shape(table))


def load(spark: SparkSession, path: str) -> VectorTable | IvfIndex | KMeansModel:
    """What :func:`save` wrote, ready for the same searches."""
    meta = read_meta(spark, path)
    kind = meta["kind"]
    if kind == "flat":
        df, files = spark.read.parquet(f"{path}/vectors"), None
        if meta.get("sorted"):
            files = SortedFiles(df, spark.read.schema("file string, lo long, hi long").parquet(f"{path}/ranges"), f"{path}/vectors")
        return VectorTable(df, meta["dim"], meta["metric"], meta["rows"], files)
    if kind == "kmeans":
        return _load_model(spark, path, meta)
    return _load_lists(spark, path, meta)


def read_meta(spark: SparkSession, path: str) -> dict:
    """The metadata row that marks a complete save."""
    try:
        return json.loads(spark.read.text(f"{path}/meta").first()[0])
    except (AnalysisException, TypeError) as error:
        raise FileNotFoundError(f"no saved table at {path}") from error


def snapshot(table, path: str):
    """Independent stored copy of a table or index."""
    spark = _session(table)
    save(table, path)
    return load(spark, path)


def truncate(table: VectorTable | IvfIndex):
    """Same dimension, metric, trained model and compression without vectors; ids restart at 0."""
    if isinstance(table, IvfIndex):
        return replace(table, rows=None, bucket_lists=None)
    return replace(table, df=table.df.filter(F.lit(False)), rows=0)


def _session(table) -> SparkSession:
    if isinstance(table, IvfIndex):
        return table.require().model.table.df.sparkSession
    return (table.table if isinstance(table, KMeansModel) else table).df.sparkSession


def _shape(table) -> dict:
    return {"dim": table.dim, "metric": table.metric}


def _write(df: DataFrame, path: str, by: str | None = None) -> int:
    """Rows written; counted by the write itself."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    (writer.partitionBy(by) if by else writer).parquet(path)
    return seen.get["rows"]


def _write_ranges(spark: SparkSession, path: str) -> None:
    """Which ids each file holds."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    rows = spark.read.parquet(f"{path}/vectors").select(name.alias("file"), "id")
    rows = rows.groupBy("file").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    rows.coalesce(1).write.parquet(f"{path}/ranges")


def commit(spark: SparkSession, path: str, **meta) -> None:
    row = spark.createDataFrame([(json.dumps(meta),)], "value string")
    row.coalesce(1).write.text(f"{path}/meta")


def _save_model(model: KMeansModel, path: str) -> None:
    df = model.require().table.df
    _write(df.select("id", "vec"), f"{path}/centroids")
    commit(
        df.sparkSession, path, kind="kmeans", k=model.k, dim=model.dim, inertia=model.inertia
    )


def _load_model(spark: SparkSession, path: str, meta: dict) -> KMeansModel:
    k, dim = meta["k"], meta["dim"]
    table = VectorTable(spark.read.parquet(f"{path}/centroids"), dim, "l2", k)
    return KMeansModel(k, dim, table, tuple(meta["inertia"]))


def _save_lists(index: IvfIndex, path: str) -> None:
    spark = _session(index)
    _save_model(index.require().model, f"{path}/model")
    meta = {"nlist": index.nlist, "bucket_lists": None, "storage": None, "rows": 0}
    if index.rows is not None:
        per_bucket = -(-index.nlist // MAX_BUCKETS)
        rows = index.rows.drop("bucket")
        rows = rows.repartitionByRange("list_id", "id").sortWithinPartitions("list_id", "id")
        meta["rows"] = _write(with_bucket(rows, per_bucket), f"{path}/lists", "bucket")
        meta["bucket_lists"] = per_bucket
    if index.decode is not None:  # compression is kept without rows too
        meta["storage"] = type(index.decode).__name__.lower()
        if isinstance(index.decode, Product):
            book = Codebook(index.decode.books.value)
            _write(book.table(spark), f"{path}/codebook")
    commit(spark, path, kind="ivf", **meta, **_shape(index))


def _load_lists(spark: SparkSession, path: str, meta: dict) -> IvfIndex:
    model_meta = json.loads(spark.read.text(f"{path}/model/meta").first()[0])
    index = IvfIndex(
        meta["dim"], meta["nlist"], meta["metric"], _load_model(spark, f"{path}/model", model_meta)
    )
    if meta["storage"] is None:
        return index
    rows = None
    if meta["bucket_lists"] is not None:
        rows = spark.read.parquet(f"{path}/lists")
        index = replace(index, rows=rows, bucket_lists=meta["bucket_lists"])
    if meta["storage"] == "product":
        return product_rows(index, codebook(spark.read.parquet(f"{path}/codebook")))
    if meta["storage"] == "half":
        return replace(ivf_half(replace(index, rows=None)), rows=rows)
    return replace(index, decode=Flat(index.dim))
