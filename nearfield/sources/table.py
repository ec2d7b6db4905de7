"""Typed vector tables: creation, appends, validation, profile."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.plans.sizing import cut_lineage

METRICS = ("l2", "inner_product")


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"invalid metric {metric!r}, expected 'l2' or 'inner_product'")
    return metric


def check_positive(name: str, value: int) -> int:
    if value <= 0:
        raise ValueError(f"{name} must be positive")
    return value


@dataclass(frozen=True)
class SortedFiles:
    """Files of a table stored by id: ``ranges(file, lo, hi)`` under a folder."""

    df: DataFrame
    ranges: DataFrame
    folder: str

    def holding(self, ids: list[int]) -> DataFrame:
        """Rows of the files that may hold some of the ids; at most as many files as ids, but for split ids."""
        wanted = F.array(*(F.lit(i) for i in ids)) if ids else F.array().cast("array<long>")
        hit = F.exists(wanted, lambda i: i.between(F.col("lo"), F.col("hi")))
        names = [f"{self.folder}/{r.file}" for r in self.ranges.filter(hit).select("file").collect()]
        if not names:
            return self.df.filter(F.lit(False))
        return self.df.sparkSession.read.schema(self.df.schema).parquet(*names)


@dataclass(frozen=True)
class VectorTable:
    """Rows ``(id, vec, payload...)`` of one dimension under one metric.

    Tables never change; an append gives a new table over the old one. ``rows``
    is the row count where it is known, which spares later size checks a job;
    ``files`` tells which files hold an id, as long as they are all of the table.
    """

    df: DataFrame
    dim: int
    metric: str = "l2"
    rows: int | None = None
    files: SortedFiles | None = None

    def holding(self, ids: list[int]) -> DataFrame:
        """The rows with these ids; no other files of a table stored by id are opened."""
        stored = self.files is not None and self.files.df is self.df
        rows = self.files.holding(ids) if stored else self.df
        return rows.filter(F.col("id").isin(ids))

    def count(self) -> int:
        return self.df.count() if self.rows is None else self.rows


def vector_table(
    df: DataFrame,
    id: str = "id",
    vec: str = "vec",
    dim: int = 0,
    metric: str = "l2",
    payload: tuple[str, ...] = (),
) -> VectorTable:
    """Vector table over any DataFrame; elements become float32, ids 64-bit.

    A row that breaks the contract fails the job that reads it with the reason
    and its id. Split such rows off beforehand with :func:`validate_vectors`.
    """
    check_positive("dim", dim)
    check_metric(metric)
    typed = df.select(
        whole_id(df, id).alias("id"), F.col(vec).cast("array<float>").alias("vec"), *payload
    )
    return VectorTable(checked(typed, dim), dim, metric)


def whole_id(df: DataFrame, id: str) -> Column:
    """The id as a 64-bit integer; a value that is none fails the job that reads it."""
    if _whole(df, id):
        return F.col(id).cast("long")
    return F.expr(
        f"CASE WHEN {_fractional(id)} THEN raise_error(concat('vector ', string(`{id}`), "
        f"' rejected: non_integer_id')) ELSE CAST(`{id}` AS BIGINT) END"
    )


def _fractional(id: str) -> str:
    whole = f"try_cast(`{id}` AS BIGINT)"
    return f"(`{id}` IS NOT NULL AND ({whole} IS NULL OR {whole} != `{id}`))"


def checked(df: DataFrame, dim: int, id: str = "id") -> DataFrame:
    """The same rows of ``(id, vec, ...)``; a bad one fails the job that reads it.

    What consumers see is one short condition per row; the reason is worked out for a bad row only.
    """
    whole = _whole(df, id)
    reason = _reason(dim, id, "vec", whole)
    good = F.expr(
        f"CASE WHEN {_good(dim, id, 'vec', whole)} THEN vec ELSE raise_error(concat('vector ', "
        f"coalesce(string({id}), 'without id'), ' rejected: ', {reason}, "
        f"coalesce(concat(', size ', string(size(vec))), ''), ', expected {dim} finite elements')) END"
    )
    return df.withColumn("vec", good)


def _whole(df: DataFrame, id: str) -> bool:
    """Whether the type of the ids allows whole numbers only."""
    return df.schema[id].dataType.typeName() in ("byte", "short", "integer", "long")


def _good(dim: int, id: str, vec: str, whole: bool) -> str:
    """SQL text, true for a good row and false or null for any other."""
    ids = f"`{id}` IS NOT NULL" + ("" if whole else f" AND NOT {_fractional(id)}")
    return (
        f"{ids} AND size(`{vec}`) = {dim} AND array_contains(`{vec}`, float('NaN')) IS NOT NULL "
        f"AND float(array_max(`{vec}`)) < float('infinity') AND float(array_min(`{vec}`)) > float('-infinity')"
    )


def _reason(dim: int, id: str, vec: str, whole: bool = False) -> str:
    """SQL text; array functions run as compiled loops, unlike lambdas.

    ``array_contains`` is NULL when the value is missing and an element is null;
    ``array_max`` takes NaN for the largest value. Ranges are those of float32,
    to which elements are narrowed.
    """
    fractional = "" if whole else f"WHEN {_fractional(id)} THEN 'non_integer_id' "
    return (
        f"CASE WHEN `{id}` IS NULL THEN 'null_id' {fractional}"
        f"WHEN `{vec}` IS NULL THEN 'null_vector' "
        f"WHEN size(`{vec}`) != {dim} THEN 'wrong_dim' "
        f"WHEN array_contains(`{vec}`, float('NaN')) IS NULL THEN 'null_element' "
        f"WHEN float(array_max(`{vec}`)) >= float('infinity') THEN 'non_finite' "
        f"WHEN float(array_min(`{vec}`)) = float('-infinity') THEN 'non_finite' END"
    )


def reject_reason(dim: int, id: str = "id", vec: str = "vec") -> Column:
    """Name of the first broken rule, NULL for a good row; arrays of float or double."""
    return F.expr(_reason(dim, id, vec))


def validate_vectors(
    df: DataFrame, dim: int, id: str = "id", vec: str = "vec"
) -> tuple[DataFrame, DataFrame]:
    """``(good rows, rejected rows with a reason)``."""
    check_positive("dim", dim)
    marked = df.withColumn("reason", reject_reason(dim, id, vec))
    good = marked.filter(F.col("reason").isNull()).drop("reason")
    return good, marked.filter(F.col("reason").isNotNull())


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reason").agg(F.count("*").alias("rows"))


def append_with_ids(table: VectorTable, df: DataFrame, id: str = "id", vec: str = "vec"):
    """Table with more rows under caller ids; payload columns missing in ``df`` are NULL."""
    payload = tuple(c for c in table.df.columns if c not in ("id", "vec") and c in df.columns)
    more = vector_table(df, id, vec, table.dim, table.metric, payload)
    return replace(
        table, df=table.df.unionByName(more.df, allowMissingColumns=True), rows=None
    )


def append_sequential(
    table: VectorTable, df: DataFrame, order_by: str | list[str], vec: str = "vec"
) -> VectorTable:
    """Append rows under ids ``ntotal, ntotal + 1, ...`` in the given order."""
    start = table.count()
    numbered, added = number_rows(df, order_by, start)
    out = append_with_ids(table, numbered, "id", vec)
    return replace(out, rows=start + added)


def number_rows(
    df: DataFrame, order_by: str | list[str], start: int = 0, id: str = "id"
) -> tuple[DataFrame, int]:
    """Dense ids in sort order, and the number of rows.

    A range-partitioned sort is checkpointed with each row's partition and
    place in it; adding the sizes of the partitions before gives the id. Only
    one count per partition reaches the driver. Rows with equal order are
    sorted by a hash of the row, so one frequent value fills many partitions.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    order.append(F.xxhash64(*df.columns))
    # exact copies take any order among themselves, so their place in the input spreads them
    placed = df.withColumn("_copy", F.monotonically_increasing_id()).orderBy(*order, "_copy")
    placed = cut_lineage(
        placed.drop("_copy").withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    offsets, total = [], start
    for number, size in sizes:
        # place = (part << 33) + index, so one shift per partition suffices
        offsets.append((number, total - (number << 33)))
        total += size
    spark = df.sparkSession
    shift = spark.createDataFrame(offsets or [(0, 0)], "_part long, _shift long")
    out = placed.join(F.broadcast(shift), part == F.col("_part")).withColumn(
        id, F.col("_place") + F.col("_shift")
    )
    return out.drop("_place", "_part", "_shift"), total - start


def profile(table: VectorTable) -> DataFrame:
    """One row: row count, smallest and largest vector size, ids used twice or more."""
    ids = table.df.groupBy("id").agg(
        F.count("*").alias("n"),
        F.min(F.size("vec")).alias("lo"),
        F.max(F.size("vec")).alias("hi"),
    )
    return ids.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("ntotal"),
        F.min("lo").alias("min_dim"),
        F.max("hi").alias("max_dim"),
        F.count_if(F.col("n") > 1).alias("duplicate_ids"),
    )
