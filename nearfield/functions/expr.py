"""Vector expressions over ``array<float>`` columns, evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def l2_squared(a, b) -> Column:
    """Sum of squared differences in double precision; no square root."""

    def square(x, y):
        d = x.cast("double") - y.cast("double")
        return d * d

    return F.aggregate(F.zip_with(_col(a), _col(b), square), F.lit(0.0), lambda s, x: s + x)


def inner_product(a, b) -> Column:
    terms = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)


def l2_norm(v) -> Column:
    return F.sqrt(inner_product(v, v))


def unit(v) -> Column:
    """v / |v|, NULL for a zero vector."""
    v = _col(v)

    def scale(total):
        shorter = F.transform(v, lambda x: (x.cast("double") / F.sqrt(total)).cast("float"))
        return F.when(total > 0, shorter)

    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"), scale)


def vector_subtract(a, b) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: (x - y).cast("float"))


def register_sql_functions(spark: SparkSession) -> None:
    """``l2_squared`` and ``inner_product`` as SQL functions that Catalyst inlines."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION l2_squared(a ARRAY<FLOAT>, b ARRAY<FLOAT>) "
        "RETURNS DOUBLE RETURN aggregate(zip_with(a, b, (x, y) -> "
        "(double(x) - double(y)) * (double(x) - double(y))), 0D, (s, x) -> s + x)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION inner_product(a ARRAY<FLOAT>, b ARRAY<FLOAT>) "
        "RETURNS DOUBLE RETURN aggregate(zip_with(a, b, (x, y) -> "
        "double(x) * double(y)), 0D, (s, x) -> s + x)"
    )
