"""Compressed rows: half precision and product quantization."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.functions.expr import l2_squared, vector_subtract
from nearfield.functions.kernels import (
    Flat,
    Half,
    Product,
    binary_matrix,
    blobs,
    matrix,
    vectors,
)
from nearfield.operators.ivf import IvfIndex, to_lists
from nearfield.operators.kmeans import add_sums, few_sums, merge_sums, nearest, next_centroids
from nearfield.plans import sizing
from nearfield.plans.pairs import PairScorer
from nearfield.plans.scan import rank_merge
from nearfield.sources.table import VectorTable, check_positive

# largest finite IEEE 754 half-precision value
HALF_MAX = 65504.0


def half_rejects(table: VectorTable) -> tuple[VectorTable, DataFrame]:
    """Rows float16 can hold, and those with an element beyond its range."""
    too_big = F.exists("vec", lambda x: F.abs(x) > HALF_MAX)
    good = replace(table, df=table.df.filter(~too_big), rows=None)
    return good, table.df.filter(too_big).withColumn("reason", F.lit("half_overflow"))


def half_encode(vec: str = "vec", dim: int = 0) -> Column:
    """Vector column as float16 blobs of ``2 * dim`` bytes."""

    @F.arrow_udf("binary")
    def encode(v: pa.Array) -> pa.Array:
        x = matrix(v, dim)
        if np.abs(x).max(initial=0) > HALF_MAX:
            raise ValueError("vector element exceeds the float16 range")
        return blobs(x.astype("<f2"))

    return encode(vec)


def half_decode(half: str = "half", dim: int = 0) -> Column:
    @F.arrow_udf("array<float>")
    def decode(b: pa.Array) -> pa.Array:
        return vectors(binary_matrix(b, dim, "<f2").astype(np.float32))

    return decode(half)


def ivf_half(index: IvfIndex) -> IvfIndex:
    """Inverted lists with float16 rows, half the size of float32 ones.

    Rows already in the index are converted; later ones as they are added.
    """
    _require_plain(index)
    dim = index.dim

    def encode(listed: DataFrame) -> DataFrame:
        return listed.withColumn("half", half_encode("vec", dim)).drop("vec")

    rows = None if index.rows is None else encode(index.rows)
    return replace(index, rows=rows, encode=encode, decode=Half(dim))


def _require_plain(index: IvfIndex) -> None:
    index.require()
    if not isinstance(index.decode, Flat | None):
        raise ValueError("rows are already compressed")


@dataclass(frozen=True)
class Codebook:
    """``(m, codes, dim / m)`` sub-centroids, one codebook per sub-vector.

    Its size, ``codes * dim`` numbers with at most 256 codes, does not grow
    with the data.
    """

    books: np.ndarray

    @property
    def m(self) -> int:
        return self.books.shape[0]

    @property
    def dim(self) -> int:
        return self.books.shape[0] * self.books.shape[2]

    def table(self, spark: SparkSession) -> DataFrame:
        """``(sub, code, vec)`` rows."""
        m, codes, width = self.books.shape
        rows = pa.table(
            {
                "sub": pa.array(np.repeat(np.arange(m), codes).astype(np.int32)),
                "code": pa.array(np.tile(np.arange(codes), m).astype(np.int32)),
                "vec": pa.array(
                    list(self.books.reshape(m * codes, width)), pa.list_(pa.float64())
                ),
            }
        )
        return spark.createDataFrame(rows, "sub int, code int, vec array<double>")


def codebook(df: DataFrame) -> Codebook:
    """Codebook from ``(sub, code, vec)`` rows, as many codes in every sub-space."""
    n, m = df.agg(F.count("*"), F.count_distinct("sub")).first()
    if m == 0 or n % m or n // m > 256:
        raise ValueError("a codebook holds 1 to 256 codes, the same number per sub-space")
    rows = df.orderBy("sub", "code").select("sub", "code", "vec").limit(n).collect()
    return Codebook(np.array([r.vec for r in rows], float).reshape(m, len(rows) // m, -1))


def pq_train(
    sample: VectorTable,
    m: int,
    nbits: int = 8,
    index: IvfIndex | None = None,
    iterations: int = 25,
    init: Codebook | None = None,
    seed: int = 1,
) -> Codebook:
    """k-means with ``2 ** nbits`` centroids in each of m sub-spaces.

    All sub-spaces advance in the same job. With an ``index`` the residuals to
    its coarse centroids are quantized instead of the vectors themselves.
    """
    dim = sample.dim
    check_positive("m", m)
    if dim % m:
        raise ValueError(f"dim {dim} is not divisible into {m} sub-vectors")
    if not 1 <= nbits <= 8:
        raise ValueError("nbits must be between 1 and 8")
    codes, width = 2**nbits, dim // m
    rows = sample.df if index is None else residual_rows(index, sample)
    df = rows.select("id", "vec").persist()
    try:
        if init is None:
            picked = df.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(codes)
            start = matrix(picked.select("vec").toArrow().column("vec"), dim)
            if len(start) < codes:
                raise ValueError(f"cannot train {codes} codes on {len(start)} rows")
            books = start.astype(float).reshape(codes, m, width).transpose(1, 0, 2)
        else:
            books = init.books
        for _ in range(iterations):
            moved = _advance(df, books)
            if np.array_equal(moved, books):
                break
            books = moved
        return Codebook(np.ascontiguousarray(books))
    finally:
        df.unpersist()


def residual_rows(index: IvfIndex, table: VectorTable) -> DataFrame:
    """Rows of the table with ``vec`` replaced by the residual to their list's centroid."""
    listed = table.df if "list_id" in table.df.columns else to_lists(index, table.df)
    return _minus_coarse(index, listed)


def _minus_coarse(index: IvfIndex, listed: DataFrame) -> DataFrame:
    """Rows ``(list_id, vec, ...)`` with the centroid of their list taken off."""
    coarse, dim = _coarse(index), index.dim
    if coarse is None:
        joined = _join_coarse(index, listed)
        return joined.withColumn("vec", vector_subtract("vec", "coarse")).drop("coarse")

    @F.arrow_udf("array<float>")
    def shift(vec: pa.Array, list_id: pa.Array) -> pa.Array:
        return vectors(matrix(vec, dim) - coarse.value[list_id.to_numpy()])

    return listed.withColumn("vec", shift("vec", "list_id"))


def _coarse(index: IvfIndex):
    """Broadcast of the coarse centroids in list order, None beyond the limit."""
    table = index.require().model.table
    local = sizing.small_matrix(table.df, "id", index.dim, table.rows)
    if local is None:
        return None
    ids, mat = local
    return table.df.sparkSession.sparkContext.broadcast(mat[np.argsort(ids)])


def _join_coarse(index: IvfIndex, rows: DataFrame) -> DataFrame:
    centroids = index.model.table.df.select(
        F.col("id").cast("int").alias("list_id"), F.col("vec").cast("array<float>").alias("coarse")
    )
    return rows.join(centroids, "list_id")


def _advance(df: DataFrame, books: np.ndarray) -> np.ndarray:
    """One Lloyd round in every sub-space."""
    m, codes, width = books.shape
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(books)

    def add(batches):
        books = shared.value
        sums, counts = np.zeros(books.shape), np.zeros((m, codes), np.int64)
        for batch in batches:
            x = matrix(batch.column("vec"), m * width).reshape(-1, m, width)
            for sub in range(m):
                code, _ = nearest(x[:, sub], books[sub])
                np.add.at(sums[sub], code, x[:, sub])
                counts[sub] += np.bincount(code, minlength=codes)
        sub, code = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(sub * codes + code),
                pa.array(list(sums[sub, code]), pa.list_(pa.float64())),
                pa.array(counts[sub, code]),
            ],
            names=["cluster", "total", "n"],
        )

    partial = (
        df.select("vec")
        .coalesce(sizing.merge_width(spark))
        .mapInArrow(add, "cluster long, total array<double>, n long")
    )
    if not few_sums(spark, books.size):
        partial = merge_sums(partial)
    sums, counts = add_sums(partial.toArrow(), (m * codes, width))
    shared.destroy()
    return np.stack(
        [
            next_centroids(books[s], sums[s * codes :][:codes], counts[s * codes :][:codes])
            for s in range(m)
        ]
    )


def pq_encode(df: DataFrame, book: Codebook, vec: str = "vec") -> Column:
    """Code column: m one-byte codes per vector, as a blob of m bytes."""
    shared, dim = df.sparkSession.sparkContext.broadcast(book.books), book.dim

    @F.arrow_udf("binary")
    def encode(v: pa.Array) -> pa.Array:
        books = shared.value
        m, _, width = books.shape
        x = matrix(v, dim).reshape(-1, m, width)
        return blobs(
            np.stack([nearest(x[:, s], books[s])[0] for s in range(m)], axis=1).astype("u1")
        )

    return encode(vec)


def ivf_pq(index: IvfIndex, book: Codebook) -> IvfIndex:
    """Inverted lists whose rows hold codes of the residual to their centroid.

    The distance of a query to a row is its distance to the decoded vector,
    found as a sum of table entries where few queries probe a list.
    """
    _require_plain(index)
    if book.dim != index.dim:
        raise ValueError(f"codebook has dim {book.dim}, expected {index.dim}")
    plain = index.rows
    index = product_rows(replace(index, rows=None), book)
    return index if plain is None else replace(index, rows=index.encode(plain))


def product_rows(index: IvfIndex, book: Codebook) -> IvfIndex:
    """Index whose rows are codes; rows it holds already must be codes.

    Rows hold no centroid, also beyond the broadcast limit.
    """
    spark, coarse = index.require().model.table.df.sparkSession, _coarse(index)
    books = spark.sparkContext.broadcast(book.books)

    def encode(listed: DataFrame) -> DataFrame:
        shifted = _minus_coarse(index, listed)
        return shifted.withColumn("codes", pq_encode(listed, book)).drop("vec")

    return replace(index, encode=encode, decode=Product(books, coarse))


def decoded(index: IvfIndex) -> DataFrame:
    """``(id, vec)`` as rebuilt from the compressed rows."""
    rows, decode = index.require_rows(), index.decode
    if isinstance(decode, Flat):
        return rows.select("id", "vec")

    columns = list(decode.columns)
    if isinstance(decode, Product) and decode.coarse is None:
        rows, columns = _join_coarse(index, rows), [*columns, "coarse"]

    def rebuild(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), vectors(decode(batch))], names=["id", "vec"]
            )

    return rows.select("list_id", "id", *columns).mapInArrow(
        rebuild, "id long, vec array<float>"
    )


def decoded_table(index: IvfIndex) -> VectorTable:
    """Decoded rows as a table, for lookup by id and residuals."""
    return VectorTable(decoded(index), index.dim, index.metric)


def quantization_error(index: IvfIndex, table: VectorTable) -> DataFrame:
    """``(id, residual, error)``: true minus decoded vector, and its squared length."""
    rebuilt = decoded(index).withColumnRenamed("vec", "stored")
    return table.df.join(rebuilt, "id").select(
        "id",
        vector_subtract("vec", "stored").alias("residual"),
        l2_squared("vec", "stored").alias("error"),
    )


def rerank(found: DataFrame, queries: DataFrame, table: VectorTable, k: int) -> DataFrame:
    """Exact top-k among the rows of an approximate result."""
    return rank_merge(PairScorer(queries, table)(found), k, table.metric)
