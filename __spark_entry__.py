"""Queries over the given tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.functions import expr
from nearfield.index import new_index
from nearfield.operators import evaluate, graph, ivf, kmeans, knn, lookup, quant, shape
from nearfield.plans import sizing
from nearfield.sources import packed, store, table
from nearfield.streaming import jobs

DIM = 64
SUBS = 16
Query = Callable[[SparkSession, str], DataFrame]

# --------------------------------------------------------------------- inputs


# the columns that queries use, so that reading needs no pass over file footers
SCHEMAS = {
    "embeddings": "vec_id long, embedding array<float>, label int",
    "customer": "c_custkey long, c_nationkey int, c_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_totalprice double",
    "lineitem": "l_orderkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double",
    "supplier": "s_suppkey long, s_nationkey int, s_acctbal double",
    "part": "p_partkey long",
    "nation": "n_nationkey int, n_regionkey int",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _embeddings(spark, sf_dir, metric="l2") -> table.VectorTable:
    df = _read(spark, sf_dir, "embeddings")
    return table.vector_table(df, "vec_id", "embedding", DIM, metric, ("label",))


def _stretched(spark, sf_dir, metric="l2") -> table.VectorTable:
    """Embeddings scaled by label and moved, so that the metrics rank differently."""
    df = _read(spark, sf_dir, "embeddings").withColumn(
        "vec",
        F.expr("transform(embedding, x -> float(double(x) * (1 + label * 0.125D) + 0.25D))"),
    )
    return table.vector_table(df, "vec_id", "vec", DIM, metric, ("label",))


STRETCHED = """stretched AS (
  SELECT vec_id AS id, label, list_transform(embedding, lambda x:
    CAST(CAST(x AS DOUBLE) * (1 + label * CAST(0.125 AS DOUBLE)) + CAST(0.25 AS DOUBLE) AS FLOAT)) AS vec
  FROM embeddings)"""


def _customers(spark, sf_dir, metric="l2") -> table.VectorTable:
    """Customers as points: balance, number of orders, largest and smallest order."""
    orders = _read(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"),
        F.max("o_totalprice").alias("hi"),
        F.min("o_totalprice").alias("lo"),
    )
    df = (
        _read(spark, sf_dir, "customer")
        .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.array(
                F.col("c_acctbal") / 1000,
                F.coalesce("n", F.lit(0)).cast("double"),
                F.coalesce("hi", F.lit(0.0)) / 100000,
                F.coalesce("lo", F.lit(0.0)) / 100000,
            ).alias("vec"),
        )
    )
    return table.vector_table(df, dim=4, metric=metric)


CUSTOMERS = """customers AS (
  SELECT c_custkey AS id, [CAST(c_acctbal / 1000 AS FLOAT), CAST(coalesce(n, 0) AS FLOAT),
    CAST(coalesce(hi, 0) / 100000 AS FLOAT), CAST(coalesce(lo, 0) / 100000 AS FLOAT)] AS vec
  FROM customer LEFT JOIN (
    SELECT o_custkey, count(*) AS n, max(o_totalprice) AS hi, min(o_totalprice) AS lo
    FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey)"""


def _lines(spark, sf_dir) -> table.VectorTable:
    """Order lines as points: largest quantity, price, discount and tax per line number."""
    names = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    df = (
        _read(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"))
        .agg(*(F.max(c).alias(c) for c in names))
        .select(
            "id",
            F.array(
                F.col("l_quantity"),
                F.col("l_extendedprice") / 1000,
                F.col("l_discount") * 100,
                F.col("l_tax") * 100,
            ).alias("vec"),
            F.floor(F.col("l_quantity") / 10).cast("int").alias("band"),
        )
    )
    # read several times by every query on it, so aggregated once
    points = table.vector_table(sizing.cut_lineage(df), dim=4, payload=("band",))
    return replace(points, rows=points.df.count())


LINES = """lines AS (
  SELECT id, CAST(floor(q / 10) AS INTEGER) AS band, [CAST(q AS FLOAT), CAST(p / 1000 AS FLOAT),
    CAST(d * 100 AS FLOAT), CAST(t * 100 AS FLOAT)] AS vec
  FROM (SELECT l_orderkey * 8 + l_linenumber AS id, max(l_quantity) AS q, max(l_extendedprice) AS p,
    max(l_discount) AS d, max(l_tax) AS t FROM lineitem GROUP BY 1))"""


def _means(points: table.VectorTable, by: str) -> DataFrame:
    """``(cluster, vec)``: the mean vector per value of a small-valued column."""
    return (
        points.df.select(F.col(by).alias("cluster"), F.posexplode("vec").alias("pos", "x"))
        .groupBy("cluster", "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy("cluster")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v"))
        .select("cluster", F.col("v.x").alias("vec"))
    )


def _means_sql(name: str, source: str, by: str) -> str:
    return f"""{name} AS (
  SELECT cluster, list(x ORDER BY pos) AS vec FROM (
    SELECT cluster, pos, avg(x) AS x FROM (
      SELECT {by} AS cluster, unnest(range(len(vec))) AS pos, unnest(CAST(vec AS DOUBLE[])) AS x
      FROM {source}) GROUP BY cluster, pos) GROUP BY cluster)"""


def _label_model(spark, sf_dir, points=None) -> kmeans.KMeansModel:
    """Model with the mean vector of each label as its centroids, no further training."""
    points = points or _stretched(spark, sf_dir)
    means = _means(points, "label").select(F.col("cluster").cast("long").alias("id"), "vec")
    means = sizing.cut_lineage(means)
    k = means.count()
    return kmeans.KMeansModel(k, DIM, table.VectorTable(means, DIM, "l2", k))


# ------------------------------------------------------------- result shaping


def _elements(df: DataFrame, *keys: str, vec: str = "vec") -> DataFrame:
    """One row per vector element, rounded for comparison."""
    return df.select(*keys, F.posexplode(vec).alias("pos", "x")).select(
        *keys, "pos", F.round(F.col("x").cast("double"), 6).alias("x")
    )


def _elements_sql(source: str, *keys: str, vec: str = "vec") -> str:
    names = ", ".join(keys)
    return f"""SELECT {names}, CAST(pos AS INTEGER) AS pos, round(x, 6) + 0.0 AS x FROM (
  SELECT {names}, unnest(range(len({vec}))) AS pos, unnest(CAST({vec} AS DOUBLE[])) AS x
  FROM {source})"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    columns = columns or ("distance",)
    return df.withColumns({c: F.round(c, 6) for c in columns})


RESULT = "qid, rank, id, round(distance, 6) + 0.0 AS distance"


def _cost_sql(metric: str, a: str, b: str) -> str:
    a, b = f"CAST({a} AS DOUBLE[])", f"CAST({b} AS DOUBLE[])"
    return f"pow(list_distance({a}, {b}), 2)" if metric == "l2" else f"list_inner_product({a}, {b})"


def _ranked_sql(name: str, pairs: str, k: int, metric: str = "l2") -> str:
    """Top-k per query of a relation ``(qid, id, distance)``."""
    order = "distance" if metric == "l2" else "distance DESC"
    return f"""{name} AS (
  SELECT * FROM (SELECT qid, id, distance, CAST(row_number() OVER (
    PARTITION BY qid ORDER BY {order}, id) AS INTEGER) AS rank FROM ({pairs})) WHERE rank <= {k})"""


def _knn_sql(name: str, queries: str, corpus: str, k: int, metric: str = "l2", where="") -> str:
    pairs = f"""SELECT q.id AS qid, x.id AS id, {_cost_sql(metric, "q.vec", "x.vec")} AS distance
    FROM {queries} q, {corpus} x {where}"""
    return _ranked_sql(name, pairs, k, metric)


def _assign_sql(name: str, rows: str, centroids: str) -> str:
    return f"""{name} AS (
  SELECT id, m.cluster AS cluster, m.distance AS distance FROM (
    SELECT r.id, min({{'distance': {_cost_sql("l2", "r.vec", "c.vec")},
      'cluster': c.cluster}}) AS m
    FROM {rows} r, {centroids} c GROUP BY r.id))"""


def _lloyd_sql(rows: str, start: str, rounds: int) -> str:
    """CTEs c0 .. c<rounds>: centroids after each round of k-means."""
    parts = [f"c0 AS (SELECT * FROM {start})"]
    for i in range(rounds):
        parts.append(_assign_sql(f"a{i}", rows, f"c{i}"))
        parts.append(f"m{i} AS (SELECT a.cluster, r.vec FROM a{i} a JOIN {rows} r USING (id))")
        parts.append(_means_sql(f"c{i + 1}", f"m{i}", "cluster"))
    return ",\n".join(parts)


QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


# ------------------------------------------- sources, sinks, table maintenance


@_query(_elements_sql("(SELECT vec_id AS id, embedding AS vec FROM embeddings)", "id"))
def vector_table(spark, sf_dir):
    return _elements(_embeddings(spark, sf_dir).df, "id")


@_query("""SELECT CAST(s_suppkey AS BIGINT) AS id, CAST(s_acctbal AS FLOAT) AS balance,
  CAST(s_nationkey AS FLOAT) AS nation, 'supplier' AS kind FROM supplier UNION ALL
SELECT (SELECT max(s_suppkey) + 1 FROM supplier) + row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1,
  CAST(c_acctbal AS FLOAT), CAST(c_nationkey AS FLOAT), 'customer' FROM customer""")
def append_sequential(spark, sf_dir):
    supplier = _read(spark, sf_dir, "supplier").withColumn(
        "vec", F.array("s_acctbal", F.col("s_nationkey").cast("double"))
    )
    start = table.vector_table(
        supplier.withColumn("kind", F.lit("supplier")), "s_suppkey", "vec", 2, payload=("kind",)
    )
    taken = supplier.agg(F.max("s_suppkey") + 1).first()[0]
    customer = _read(spark, sf_dir, "customer").select(
        F.array("c_acctbal", F.col("c_nationkey").cast("double")).alias("vec"),
        F.lit("customer").alias("kind"),
        "c_acctbal",
        "c_custkey",
    )
    start = table.VectorTable(start.df, 2, "l2", taken)
    both = table.append_sequential(start, customer, ["c_acctbal", "c_custkey"])
    vec = F.col("vec")
    return both.df.select("id", vec[0].alias("balance"), vec[1].alias("nation"), "kind")


@_query("""SELECT c_custkey AS id, CAST(c_acctbal AS FLOAT) AS balance FROM customer
UNION ALL SELECT -s_suppkey, CAST(s_acctbal AS FLOAT) FROM supplier""")
def append_with_ids(spark, sf_dir):
    customer = _read(spark, sf_dir, "customer").withColumn("vec", F.array("c_acctbal"))
    supplier = _read(spark, sf_dir, "supplier").select(
        (-F.col("s_suppkey")).alias("id"), F.array("s_acctbal").alias("vec")
    )
    both = table.append_with_ids(
        table.vector_table(customer, "c_custkey", "vec", 1), supplier
    )
    return both.df.select("id", F.col("vec")[0].alias("balance"))


@_query(_elements_sql("(SELECT vec_id AS id, embedding AS vec FROM embeddings)", "id"))
def packed_base64_round_trip(spark, sf_dir):
    blobs = packed.export_packed(_embeddings(spark, sf_dir).df, DIM, 100)
    text = blobs.select(
        F.col("first_id").alias("blob_id"),
        F.base64("ids").alias("ids"),
        F.base64("data").alias("data"),
    )
    rows = packed.unpack_vectors(packed.from_base64(text, "ids", "data"), DIM, ids="ids")
    return _elements(rows, "id")


@_query("SELECT vec_id AS id, label FROM embeddings")
def packed_ids_by_position(spark, sf_dir):
    points = _embeddings(spark, sf_dir)
    blobs = packed.export_packed(points.df, DIM, 64).withColumnRenamed("first_id", "blob_id")
    pairs, _ = packed.zip_ids(packed.unpack_vectors(blobs, DIM), packed.unpack_ids(blobs))
    return pairs.join(points.df.select("id", "label"), "id").select("id", "label")


@_query(f"""WITH {STRETCHED}, {_knn_sql("found", "stretched", "stretched", 5)}
SELECT qid, rank, id FROM found""")
def packed_results_round_trip(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    found = shape.pad_results(knn.self_knn(points, 5), knn.as_queries(points.df, "id"), 5)
    blobs = packed.export_results(found, 5, 100)
    qids = packed.unpack_ids(blobs, "qids", "first_qid").withColumnRenamed("id", "qid")
    labels = packed.unpack_ids(blobs, "labels", "first_qid").select(
        "blob_id",
        F.floor(F.col("pos") / 5).cast("int").alias("pos"),
        (F.pmod("pos", F.lit(5)) + 1).alias("rank"),
        "id",
    )
    return labels.join(qids, ["blob_id", "pos"]).select("qid", "rank", "id")


@_query("""SELECT CASE label WHEN 0 THEN 'null_vector' WHEN 1 THEN 'wrong_dim' WHEN 2 THEN 'null_element'
  WHEN 3 THEN 'non_finite' WHEN 4 THEN 'non_finite' WHEN 5 THEN 'null_id' WHEN 6 THEN 'non_integer_id'
  WHEN 7 THEN 'non_finite' ELSE 'good' END AS reason,
  count(*) AS rows FROM embeddings GROUP BY 1""")
def validate_vectors(spark, sf_dir):
    v, label = F.col("embedding").cast("array<double>"), F.col("label")
    head = F.slice(v, 1, DIM - 1)

    def last(x):
        return F.concat(head, F.array(F.lit(x).cast("double")))

    spoiled = _read(spark, sf_dir, "embeddings").select(
        F.when(label == 6, F.col("vec_id") + F.lit(0.5)).when(label != 5, F.col("vec_id")).alias("id"),
        F.when(label == 1, head)
        .when(label == 2, last(None))
        .when(label == 3, last(float("nan")))
        .when(label == 4, last(float("inf")))
        .when(label == 7, last(1e39))
        .when(label != 0, v)
        .alias("vec"),
    )
    good, rejects = table.validate_vectors(spoiled, DIM)
    return table.reject_counts(good.withColumn("reason", F.lit("good")).unionByName(rejects))


@_query(f"""WITH {STRETCHED}, {_knn_sql("found", "stretched", "stretched", 5, "inner_product")}
SELECT {RESULT} FROM found""")
def save_and_load(spark, sf_dir):
    path = sizing.new_path(spark)
    store.save(_stretched(spark, sf_dir, "inner_product"), path, sort_by_id=True)
    return _rounded(knn.self_knn(store.load(spark, path), 5))


@_query("""SELECT 'original' AS name, 2 * count(*) AS ntotal FROM embeddings
UNION ALL SELECT 'copy', count(*) FROM embeddings
UNION ALL SELECT 'emptied', 0""")
def snapshot_and_truncate(spark, sf_dir):
    points = _embeddings(spark, sf_dir)
    copy = store.snapshot(points, sizing.new_path(spark))
    grown = table.append_with_ids(points, points.df)
    emptied = store.truncate(copy)
    parts = [("original", grown), ("copy", copy), ("emptied", emptied)]
    counts = [
        t.df.agg(F.lit(n).alias("name"), F.count("*").alias("ntotal")).select("name", "ntotal")
        for n, t in parts
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@_query("""SELECT CAST(sum(n) AS BIGINT) AS ntotal, 4 AS min_dim, 4 AS max_dim,
  count(*) FILTER (WHERE n > 1) AS duplicate_ids
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)""")
def profile(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem").withColumn(
        "vec", F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    )
    return table.profile(table.vector_table(lines, "l_orderkey", "vec", 4))


# --------------------------------------------------------- vector expressions


@_query(f"""SELECT vec_id AS id,
  round({_cost_sql("l2", "embedding", "list_reverse(embedding)")}, 6) AS distance,
  round({_cost_sql("inner_product", "embedding", "list_reverse(embedding)")}, 6) + 0.0 AS product
FROM embeddings""")
def vector_expressions(spark, sf_dir):
    back = F.reverse("embedding")
    return _rounded(
        _read(spark, sf_dir, "embeddings").select(
            F.col("vec_id").alias("id"),
            expr.l2_squared("embedding", back).alias("distance"),
            expr.inner_product("embedding", back).alias("product"),
        ),
        "distance",
        "product",
    )


@_query(f"""WITH {LINES} SELECT band, count(*) AS rows,
  round(max({_cost_sql("l2", "vec", "[CAST(25 AS FLOAT), 25, 5, 4]")}), 6) AS farthest,
  round(max({_cost_sql("inner_product", "vec", "vec")}), 6) AS longest
FROM lines GROUP BY band""")
def sql_functions(spark, sf_dir):
    expr.register_sql_functions(spark)
    return spark.sql(
        "SELECT band, count(*) AS rows, "
        "round(max(l2_squared(vec, array(25f, 25f, 5f, 4f))), 6) AS farthest, "
        "round(max(inner_product(vec, vec)), 6) AS longest FROM {lines} GROUP BY band",
        lines=_lines(spark, sf_dir).df,
    )


@_query("""WITH scaled AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x * label AS FLOAT)) AS vec, label
  FROM embeddings),
unit AS (SELECT id, sqrt(list_inner_product(CAST(vec AS DOUBLE[]), CAST(vec AS DOUBLE[]))) AS norm, vec
  FROM scaled WHERE label > 0)
SELECT id, CAST(pos AS INTEGER) AS pos, round(CAST(CAST(CAST(x AS DOUBLE) / norm AS FLOAT) AS DOUBLE), 6) + 0.0 AS x
FROM (SELECT id, norm, unnest(range(len(vec))) AS pos, unnest(vec) AS x FROM unit)
UNION ALL SELECT id, -1, NULL FROM scaled WHERE label = 0""")
def l2_normalize(spark, sf_dir):
    scaled = _read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.transform("embedding", lambda x: (x * F.col("label")).cast("float")).alias("vec"),
    )
    good, rejects = knn.l2_normalize(scaled)
    zero = rejects.select("id", F.lit(-1).alias("pos"), F.lit(None).cast("double").alias("x"))
    return _elements(good, "id").unionByName(zero)


@_query(_elements_sql(
    """(SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(CAST(x AS DOUBLE) /
  sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS FLOAT)) AS vec
  FROM embeddings)""", "id"))
def unit_expression(spark, sf_dir):
    df = _read(spark, sf_dir, "embeddings")
    return _elements(df.select(F.col("vec_id").alias("id"), expr.unit("embedding").alias("vec")), "id")


@_query(_elements_sql(
    """(SELECT vec_id AS id, list_transform(range(1, 65), lambda i:
  CAST(embedding[i] - embedding[65 - i] AS FLOAT)) AS vec FROM embeddings)""", "id"))
def vector_subtract(spark, sf_dir):
    df = _read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        expr.vector_subtract("embedding", F.reverse("embedding")).alias("vec"),
    )
    return _elements(df, "id")


# ---------------------------------------------------------------- exact search


@_query(f"""WITH {STRETCHED}, {_knn_sql("found", "stretched", "stretched", 10)}
SELECT {RESULT} FROM found""")
def knn_l2(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    return _rounded(knn.knn_join(knn.as_queries(points.df, "id"), points, 10))


@_query(f"""WITH {STRETCHED}, {_knn_sql("found", "stretched", "stretched", 10, "inner_product")}
SELECT {RESULT} FROM found""")
def knn_inner_product(spark, sf_dir):
    points = _stretched(spark, sf_dir, "inner_product")
    return _rounded(knn.knn_join(knn.as_queries(points.df, "id"), points, 10))


@_query(f"""WITH {STRETCHED},
unit AS (SELECT id, list_transform(vec, lambda x: CAST(CAST(x AS DOUBLE) / norm AS FLOAT)) AS vec FROM (
  SELECT id, vec, sqrt(list_inner_product(CAST(vec AS DOUBLE[]), CAST(vec AS DOUBLE[]))) AS norm
  FROM stretched)),
{_knn_sql("found", "unit", "unit", 10, "inner_product")}
SELECT {RESULT} FROM found""")
def cosine_knn(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    return _rounded(knn.cosine_knn(knn.as_queries(points.df, "id"), points, 10))


@_query(f"""WITH {CUSTOMERS}, {_knn_sql("found", "customers", "customers", 5)}
SELECT {RESULT} FROM found""")
def knn_customers(spark, sf_dir):
    points = _customers(spark, sf_dir)
    # read several times by a join of two large sides, so aggregated once
    points = replace(points, df=sizing.cut_lineage(points.df))
    points = replace(points, rows=points.df.count())
    return _rounded(knn.knn_join(knn.as_queries(points.df, "id"), points, 5, query_rows=points.rows))


@_query(f"""WITH {LINES},
places AS (SELECT p_partkey AS id, [CAST(p_size AS FLOAT), CAST(p_retailprice / 1000 AS FLOAT),
  CAST(5 AS FLOAT), CAST(4 AS FLOAT)] AS vec FROM part),
{_means_sql("means", "lines", "band")},
queries AS (SELECT CAST(cluster AS BIGINT) AS id, CAST(vec AS FLOAT[]) AS vec FROM means),
{_knn_sql("found", "queries", "lines", 20)}
SELECT {RESULT} FROM found""")
def batch_search_lines(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    queries = sizing.cut_lineage(knn.as_queries(_means(lines, "band"), "cluster"))
    return _rounded(knn.knn_join(queries, lines, 20))


@_query(f"""WITH places AS (SELECT CAST(n_nationkey AS BIGINT) AS id,
  [CAST(n_nationkey AS FLOAT), CAST(n_regionkey AS FLOAT)] AS vec FROM nation),
people AS (SELECT c_custkey AS id, [CAST(c_nationkey AS FLOAT), CAST(c_acctbal / 1000 AS FLOAT)] AS vec
  FROM customer),
{_knn_sql("found", "people", "places", 30)},
slots AS (SELECT id AS qid, CAST(unnest(range(1, 31)) AS INTEGER) AS rank FROM people)
SELECT s.qid, s.rank, coalesce(f.id, -1) AS id, round(f.distance, 6) AS distance
FROM slots s LEFT JOIN found f ON s.qid = f.qid AND s.rank = f.rank""")
def pad_results(spark, sf_dir):
    nation = _read(spark, sf_dir, "nation").withColumn(
        "vec", F.array("n_nationkey", "n_regionkey")
    )
    customer = _read(spark, sf_dir, "customer").withColumn(
        "vec", F.array(F.col("c_nationkey").cast("double"), F.col("c_acctbal") / 1000)
    )
    queries = knn.as_queries(customer, "c_custkey")
    found = knn.knn_join(queries, table.vector_table(nation, "n_nationkey", "vec", 2), 30)
    return _rounded(shape.pad_results(found, queries, 30))


@_query(f"""WITH {STRETCHED}, {_knn_sql("found", "stretched", "stretched", 8)}
SELECT qid, array_to_string(list(id ORDER BY rank), ',') AS labels,
  round(list_sum(list(distance ORDER BY rank)), 6) AS total FROM found GROUP BY qid""")
def wide_results(spark, sf_dir):
    wide = shape.to_wide(knn.self_knn(_stretched(spark, sf_dir), 8))
    total = F.aggregate("distances", F.lit(0.0), lambda s, x: s + x)
    return wide.select(
        "qid",
        F.array_join(F.transform("labels", lambda x: x.cast("string")), ",").alias("labels"),
        F.round(total, 6).alias("total"),
    )


@_query(f"""WITH {STRETCHED}, {_knn_sql("found", "stretched", "stretched", 10)}
SELECT {RESULT} FROM found""")
def merge_shards(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    queries = knn.as_queries(points.df, "id")
    shards = [
        table.VectorTable(points.df.filter(part), DIM)
        for part in (F.col("label") < 5, F.col("label") >= 5)
    ]
    found = [knn.knn_join(queries, shard, 10) for shard in shards]
    return _rounded(shape.knn_merge(found, 10, "l2"))


@_query(f"""WITH {STRETCHED}, {_knn_sql("found", "stretched", "stretched", 10)}
SELECT {RESULT} FROM found WHERE distance < 2.5""")
def threshold_filter(spark, sf_dir):
    return _rounded(shape.within(knn.self_knn(_stretched(spark, sf_dir), 10), 2.5))


SEMANTIC = f"""WITH unit AS (
  SELECT id, label, list_transform(vec, lambda x: CAST(CAST(x AS DOUBLE) / norm AS FLOAT)) AS vec FROM (
  SELECT vec_id AS id, label, embedding AS vec,
    sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm
  FROM embeddings)),
{_knn_sql("found", "unit", "unit", 10, "inner_product")}
SELECT f.id, qid, rank, round(distance, 6) + 0.0 AS score, label FROM found f JOIN unit u ON f.id = u.id"""


@_query(SEMANTIC)
def semantic_search(spark, sf_dir):
    points = _embeddings(spark, sf_dir)
    queries = knn.as_queries(points.df, "id")
    return _rounded(shape.semantic_search(queries, points, 10), "score")


@_query(f"""WITH {STRETCHED},
{_knn_sql("found", "stretched", "stretched", 10, "l2", "WHERE q.id <> x.id")}
SELECT {RESULT} FROM found""")
def self_knn_without_self(spark, sf_dir):
    return _rounded(knn.self_knn(_stretched(spark, sf_dir), 10, exclude_self=True))


# --------------------------------------------------------------------- lookup


@_query(f"""WITH {CUSTOMERS}, got AS (
  SELECT o_orderkey AS pos, o_custkey AS id, vec FROM orders JOIN customers ON o_custkey = id)
{_elements_sql("got", "pos", "id").replace("CAST(pos AS INTEGER) AS pos", "CAST(i AS INTEGER) AS i")
 .replace("AS pos, unnest(CAST", "AS i, unnest(CAST")}""")
def reconstruct(spark, sf_dir):
    keys = _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pos"), F.col("o_custkey").alias("id")
    )
    got = lookup.reconstruct(_customers(spark, sf_dir), keys)
    return got.select("pos", "id", F.posexplode("vec").alias("i", "x")).withColumn(
        "x", F.round(F.col("x").cast("double"), 6)
    )


@_query(f"""WITH {CUSTOMERS} SELECT p_partkey AS pos, p_partkey AS id, vec IS NULL AS missing
FROM part LEFT JOIN customers ON p_partkey = id""")
def reconstruct_missing(spark, sf_dir):
    keys = _read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pos"), F.col("p_partkey").alias("id")
    )
    got = lookup.reconstruct(_customers(spark, sf_dir), keys, on_missing="null")
    return got.select("pos", "id", F.col("vec").isNull().alias("missing"))


@_query(_elements_sql(
    "(SELECT vec_id AS id, embedding AS vec FROM embeddings WHERE vec_id BETWEEN 100 AND 349)", "id"))
def reconstruct_range(spark, sf_dir):
    return _elements(lookup.reconstruct_range(_embeddings(spark, sf_dir), 100, 250), "id")


@_query(f"""WITH {CUSTOMERS}
SELECT o_orderkey AS pos, o_custkey AS id,
  round(CAST(CAST(o_totalprice / 1000 AS FLOAT) - vec[1] AS DOUBLE), 6) + 0.0 AS first,
  round(CAST(CAST(2 AS FLOAT) - vec[2] AS DOUBLE), 6) + 0.0 AS second,
  round(CAST(CAST(o_totalprice / 1000 AS FLOAT) - vec[3] AS DOUBLE), 6) + 0.0 AS third,
  round(CAST(CAST(o_totalprice / 1000 AS FLOAT) - vec[4] AS DOUBLE), 6) + 0.0 AS fourth
FROM orders JOIN customers ON o_custkey = id""")
def residuals(spark, sf_dir):
    price = F.col("o_totalprice") / 1000
    xs = _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pos"),
        F.col("o_custkey").alias("id"),
        F.array(price, F.lit(2.0), price, price).cast("array<float>").alias("vec"),
    )
    out = lookup.residuals(_customers(spark, sf_dir), xs)
    rounded = [
        F.round(F.col("residual")[i].cast("double"), 6).alias(n)
        for i, n in enumerate(("first", "second", "third", "fourth"))
    ]
    return out.select("pos", "id", *rounded)


# ------------------------------------------------------------------ clustering


@_query(f"""WITH {STRETCHED}, {_means_sql("means", "stretched", "label")},
{_lloyd_sql("stretched", "means", 3)}
{_elements_sql("c3", "cluster")}""")
def kmeans_centroids(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    means = _means(points, "label")
    model = kmeans.kmeans_train(points, 10, iterations=3, init=means)
    return _elements(model.centroids(), "cluster")


@_query(f"""WITH {LINES}, {_means_sql("means", "lines", "band")},
{_lloyd_sql("lines", "means", 2)}, {_assign_sql("found", "lines", "c2")}
SELECT id, cluster, round(distance, 6) AS distance FROM found""")
def kmeans_assign_lines(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    model = kmeans.kmeans_train(lines, 6, iterations=2, init=_means(lines, "band"))
    return _rounded(kmeans.assign(model, lines.df.select("id", "vec")))


@_query(f"""WITH {STRETCHED}, {_means_sql("means", "stretched", "label")},
{_assign_sql("found", "stretched", "means")}
SELECT id, label, cluster, round(distance, 6) AS distance FROM found JOIN stretched USING (id)
WHERE distance < 1.2""")
def near_centroid_filter(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    near = kmeans.near_centroid_filter(_label_model(spark, sf_dir, points), points.df, 1.2)
    return _rounded(near.drop("vec"))


@_query()
def kmeans_seeded(spark, sf_dir):
    model = kmeans.kmeans_train(_stretched(spark, sf_dir), 16)
    return _rounded(kmeans.assign(model, _stretched(spark, sf_dir).df.select("id", "vec")))


# -------------------------------------------------------------- inverted lists

LABEL_LISTS = f"""{STRETCHED}, {_means_sql("means", "stretched", "label")},
{_assign_sql("listed", "stretched", "means")},
lists AS (SELECT id, cluster AS list_id, vec FROM listed JOIN stretched USING (id)),
coarse AS (SELECT CAST(cluster AS BIGINT) AS id, vec FROM means)"""


def _ivf_sql(name: str, k: int, nprobe: int, rows: str = "lists") -> str:
    probes = _knn_sql(f"{name}_probes", "stretched", "coarse", nprobe)
    pairs = f"""SELECT q.id AS qid, x.id AS id, {_cost_sql("l2", "q.vec", "x.vec")} AS distance
    FROM stretched q JOIN {name}_probes p ON q.id = p.qid JOIN {rows} x ON x.list_id = p.id"""
    return f"{probes},\n{_ranked_sql(name, pairs, k)}"


def _label_lists(spark, sf_dir, metric="l2") -> ivf.IvfIndex:
    points = _stretched(spark, sf_dir, metric)
    return ivf.ivf_build(points, model=_label_model(spark, sf_dir, points))


@_query(f"WITH {LABEL_LISTS} SELECT id, CAST(list_id AS INTEGER) AS list_id FROM lists")
def ivf_lists(spark, sf_dir):
    return _label_lists(spark, sf_dir).rows.select("id", "list_id")


@_query(f"""WITH {LABEL_LISTS} SELECT CAST(list_id AS INTEGER) AS list_id, count(*) AS rows
FROM lists GROUP BY 1""")
def ivf_list_sizes(spark, sf_dir):
    return ivf.list_sizes(_label_lists(spark, sf_dir))


@_query(f"""WITH {STRETCHED}, {_means_sql("means", "stretched", "label")},
{_lloyd_sql("stretched", "means", 2)}, {_assign_sql("found", "stretched", "c2")}
SELECT id, CAST(cluster AS INTEGER) AS list_id FROM found""")
def ivf_trained_lists(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    index = ivf.ivf_index(DIM, 10)
    index = ivf.ivf_train(index, points, iterations=2, init=_means(points, "label"))
    return ivf.ivf_add(index, points).rows.select("id", "list_id")


@_query(f"WITH {LABEL_LISTS}, {_ivf_sql('found', 10, 3)} SELECT {RESULT} FROM found")
def ivf_search(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    queries = knn.as_queries(points.df, "id")
    return _rounded(ivf.ivf_search(_label_lists(spark, sf_dir), queries, 10, nprobe=3))


@_query(f"WITH {LABEL_LISTS}, {_ivf_sql('found', 10, 1)} SELECT {RESULT} FROM found")
def ivf_search_stored(spark, sf_dir):
    index = store.snapshot(_label_lists(spark, sf_dir), sizing.new_path(spark))
    queries = knn.as_queries(_stretched(spark, sf_dir).df, "id")
    return _rounded(ivf.ivf_search(index, queries, 10))


@_query(f"""WITH {STRETCHED}, {_knn_sql("found", "stretched", "stretched", 10)}
SELECT {RESULT} FROM found""")
def ivf_all_lists(spark, sf_dir):
    index = _label_lists(spark, sf_dir)
    queries = knn.as_queries(_stretched(spark, sf_dir).df, "id")
    return _rounded(ivf.ivf_search(index, queries, 10, nprobe=index.nlist))


@_query(f"""WITH {STRETCHED}, {_means_sql("means", "stretched", "label")},
coarse AS (SELECT CAST(cluster AS BIGINT) AS id, vec FROM means),
{_knn_sql("listed", "stretched", "coarse", 1, "inner_product")},
{_knn_sql("probes", "stretched", "coarse", 2, "inner_product")},
{_ranked_sql("found", f'''SELECT q.id AS qid, x.id AS id,
  {_cost_sql("inner_product", "q.vec", "x.vec")} AS distance
  FROM stretched q JOIN probes p ON q.id = p.qid JOIN listed l ON l.id = p.id
  JOIN stretched x ON x.id = l.qid''', 10, "inner_product")}
SELECT {RESULT} FROM found""")
def ivf_inner_product(spark, sf_dir):
    index = _label_lists(spark, sf_dir, "inner_product")
    queries = knn.as_queries(_stretched(spark, sf_dir).df, "id")
    return _rounded(ivf.ivf_search(index, queries, 10, nprobe=2))


@_query(f"""WITH {LABEL_LISTS}, {_ivf_sql('found', 10, 2)},
{_knn_sql("truth", "stretched", "stretched", 10)}
SELECT t.qid, avg(CASE WHEN f.id IS NULL THEN 0 ELSE 1 END) AS recall
FROM truth t LEFT JOIN found f ON t.qid = f.qid AND t.id = f.id GROUP BY t.qid""")
def ivf_recall(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    queries = knn.as_queries(points.df, "id")
    found = ivf.ivf_search(_label_lists(spark, sf_dir), queries, 10, nprobe=2)
    return evaluate.recall_at_k(found, knn.knn_join(queries, points, 10))


# ---------------------------------------------------------------- compression


@_query("SELECT vec_id AS id, 128 AS bytes, true AS close FROM embeddings")
def half_round_trip(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    coded = points.df.withColumn("half", quant.half_encode("vec", DIM))
    back = coded.withColumn("back", quant.half_decode("half", DIM))
    # float16 keeps 11 significant bits; below 2**-14 its steps are 2**-24
    close = F.forall(
        F.zip_with(
            "vec",
            "back",
            lambda x, y: F.abs(x.cast("double") - y.cast("double"))
            <= F.greatest(F.abs(x.cast("double")) * 2**-11, F.lit(2.0**-25)),
        ),
        lambda ok: ok,
    )
    return back.select("id", F.octet_length("half").alias("bytes"), close.alias("close"))


# float16 has 11 significant bits and no exponent below -14; ties round to even
HALF_LISTS = f"""{LABEL_LISTS},
half_lists AS (SELECT id, list_id, list_transform(vec, lambda x: CASE WHEN x = 0 THEN 0 ELSE
  round_even(CAST(x AS DOUBLE) / pow(2, greatest(floor(log2(abs(CAST(x AS DOUBLE)))), -14) - 10), 0)
  * pow(2, greatest(floor(log2(abs(CAST(x AS DOUBLE)))), -14) - 10) END) AS vec FROM lists)"""


@_query(f"WITH {HALF_LISTS}, {_ivf_sql('found', 10, 3, 'half_lists')} SELECT {RESULT} FROM found")
def ivf_half_search(spark, sf_dir):
    index = quant.ivf_half(_label_lists(spark, sf_dir))
    queries = knn.as_queries(_stretched(spark, sf_dir).df, "id")
    return _rounded(ivf.ivf_search(index, queries, 10, nprobe=3))


def _sign_codebook(rows: DataFrame, centre: float) -> quant.Codebook:
    """16 codes per sub-vector: mean of the sub-vectors with the same signs around a centre."""
    width = DIM // SUBS
    parts = rows.select(
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.lit(SUBS - 1)),
                lambda s: F.slice("vec", s * width + 1, width),
            )
        ).alias("sub", "part")
    )
    signs = F.transform("part", lambda x: (x > centre).cast("int"))
    code = F.aggregate(signs, F.lit(0), lambda s, x: s * 2 + x)
    return quant.codebook(
        parts.select("sub", code.alias("code"), F.posexplode("part").alias("pos", "x"))
        .groupBy("sub", "code", "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy("sub", "code")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v"))
        .select("sub", "code", F.col("v.x").alias("vec"))
    )


def _sign_sql(centre: float) -> str:
    bits = (f"CASE WHEN vec[{i + 1}] > {centre} THEN {8 >> i} ELSE 0 END" for i in range(4))
    return " + ".join(bits)


SUBVECTORS = """{name} AS (
  SELECT id, label, sub, list(x ORDER BY pos) AS vec FROM (
    SELECT id, label, pos // 4 AS sub, pos, x FROM (
      SELECT id, label, unnest(range(len(vec))) AS pos, unnest(CAST(vec AS DOUBLE[])) AS x
      FROM {source})) GROUP BY id, label, sub)"""


def _book_sql(name: str, rows: str, by: str) -> str:
    return f"""{name} AS (
  SELECT sub, code, list(x ORDER BY pos) AS vec FROM (
    SELECT sub, code, pos, avg(x) AS x FROM (
      SELECT sub, {by} AS code, unnest(range(len(vec))) AS pos, unnest(vec) AS x FROM {rows})
    GROUP BY sub, code, pos) GROUP BY sub, code)"""


def _codes_sql(name: str, rows: str, book: str) -> str:
    return f"""{name} AS (
  SELECT id, sub, m.code AS code, label FROM (
    SELECT r.id, r.sub, r.label, min({{'distance': {_cost_sql("l2", "r.vec", "b.vec")},
      'code': b.code}}) AS m
    FROM {rows} r JOIN {book} b ON r.sub = b.sub GROUP BY r.id, r.sub, r.label))"""


@_query(f"""WITH {STRETCHED}, {SUBVECTORS.format(name="parts", source="stretched")},
{_book_sql("book0", "parts", _sign_sql(0.25))}, {_codes_sql("codes0", "parts", "book0")},
coded AS (SELECT c.sub, c.code, p.vec FROM codes0 c JOIN parts p ON c.id = p.id AND c.sub = p.sub),
{_book_sql("book1", "coded", "code")}, {_codes_sql("codes1", "parts", "book1")}
SELECT id, CAST(sub AS INTEGER) AS sub, CAST(code AS INTEGER) AS code FROM codes1""")
def pq_codes(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    book = quant.pq_train(points, SUBS, iterations=1, init=_sign_codebook(points.df, 0.25))
    coded = points.df.withColumn("codes", quant.pq_encode(points.df, book))
    byte = F.substring(F.hex("codes"), F.col("sub") * 2 + 1, F.lit(2))
    return coded.select(
        "id", F.explode(F.sequence(F.lit(0), F.lit(SUBS - 1))).alias("sub"), "codes"
    ).select("id", "sub", F.conv(byte, 16, 10).cast("int").alias("code"))


PQ_LISTS = f"""{LABEL_LISTS},
shifted AS (SELECT l.id, s.label, list_transform(range(1, {DIM + 1}), lambda i:
  CAST(CAST(l.vec[i] AS DOUBLE) - c.vec[i] AS FLOAT)) AS vec
  FROM lists l JOIN coarse c ON l.list_id = c.id JOIN stretched s ON s.id = l.id),
{SUBVECTORS.format(name="parts", source="shifted")},
{_book_sql("book", "parts", _sign_sql(0.0))}, {_codes_sql("codes", "parts", "book")},
rebuilt AS (
  SELECT id, list(x ORDER BY sub, pos) AS vec FROM (
    SELECT k.id, k.sub, unnest(range(len(b.vec))) AS pos, unnest(b.vec) AS x
    FROM codes k JOIN book b ON k.sub = b.sub AND k.code = b.code) GROUP BY id),
pq_lists AS (SELECT r.id, l.list_id, list_transform(range(1, {DIM + 1}), lambda i:
  CAST(r.vec[i] + c.vec[i] AS FLOAT)) AS vec
  FROM rebuilt r JOIN lists l ON r.id = l.id JOIN coarse c ON c.id = l.list_id)"""


def _pq_index(spark, sf_dir) -> quant.IvfIndex:
    index = _label_lists(spark, sf_dir)
    points = table.VectorTable(index.rows, DIM)
    return quant.ivf_pq(index, _sign_codebook(quant.residual_rows(index, points), 0.0))


@_query(f"WITH {PQ_LISTS}, {_ivf_sql('found', 10, 3, 'pq_lists')} SELECT {RESULT} FROM found")
def ivf_pq_search(spark, sf_dir):
    queries = knn.as_queries(_stretched(spark, sf_dir).df, "id")
    return _rounded(ivf.ivf_search(_pq_index(spark, sf_dir), queries, 10, nprobe=3))


@_query(f"""WITH {PQ_LISTS}, {_ivf_sql('rough', 40, 3, 'pq_lists')},
{_ranked_sql("found", f'''SELECT qid, r.id AS id, {_cost_sql("l2", "q.vec", "x.vec")} AS distance
  FROM rough r JOIN stretched q ON r.qid = q.id JOIN stretched x ON r.id = x.id''', 10)}
SELECT {RESULT} FROM found""")
def ivf_pq_rerank(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    queries = knn.as_queries(points.df, "id")
    rough = ivf.ivf_search(_pq_index(spark, sf_dir), queries, 40, nprobe=3)
    return _rounded(quant.rerank(rough, queries, points, 10))


@_query(ORACLES["ivf_pq_rerank"])
def ivf_pq_rerank_padded(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    queries = knn.as_queries(points.df, "id")
    rough = ivf.ivf_search(_pq_index(spark, sf_dir), queries, 40, nprobe=3)
    return _rounded(quant.rerank(shape.pad_results(rough, queries, 60), queries, points, 10))


@_query(f"WITH {PQ_LISTS} {_elements_sql('pq_lists', 'id')}")
def pq_reconstruct(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    keys = points.df.select(F.col("id").alias("pos"), "id")
    got = lookup.reconstruct(quant.decoded_table(_pq_index(spark, sf_dir)), keys)
    return _elements(got, "id")


@_query(f"""WITH {PQ_LISTS} SELECT s.id AS id, round({_cost_sql("l2", "s.vec", "p.vec")}, 6) AS error
FROM stretched s JOIN pq_lists p ON s.id = p.id""")
def pq_error(spark, sf_dir):
    errors = quant.quantization_error(_pq_index(spark, sf_dir), _stretched(spark, sf_dir))
    return _rounded(errors.select("id", "error"), "error")


@_query()
def pq_trained_search(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    index = ivf.ivf_build(points, nlist=8, iterations=5)
    book = quant.pq_train(points, SUBS, nbits=6, index=index, iterations=5)
    rough = ivf.ivf_search(quant.ivf_pq(index, book), knn.as_queries(points.df, "id"), 50, nprobe=8)
    return _rounded(quant.rerank(rough, knn.as_queries(points.df, "id"), points, 10))


# ---------------------------------------------------------------------- graph


@_query(f"""WITH {STRETCHED},
{_knn_sql("near", "stretched", "stretched", 8, "l2", "WHERE q.id <> x.id")},
both_ways AS (SELECT qid, id, distance FROM near UNION SELECT id, qid, distance FROM near),
{_ranked_sql("kept", "SELECT * FROM both_ways", 16)}
SELECT qid AS src, id AS dst, round(distance, 6) AS distance FROM kept""")
def graph_edges(spark, sf_dir):
    return _rounded(graph.graph_build(_stretched(spark, sf_dir), 8, "exact").edges)


@_query(ORACLES["graph_edges"])
def graph_edges_by_descent(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    return _rounded(graph.graph_build(points, 8, nprobe=points.count()).edges)


@_query(ORACLES["graph_edges"])
def save_and_load_graph(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    index = new_index(spark, DIM, "graph", degree=8)
    index = replace(index, table=points, graph=graph.graph_build(points, 8, "exact"))
    return _rounded(index.clone(sizing.new_path(spark)).graph.edges)


@_query("SELECT true AS near, count(*) AS rows FROM embeddings")
def graph_descent_recall(spark, sf_dir):
    """Whether descent from its default start finds at least 0.9 of each row's 8 nearest."""
    points = _stretched(spark, sf_dir)
    found = graph.nearest_edges(points, 8)
    found = found.withColumnsRenamed({"src": "qid", "dst": "id"})
    truth = knn.self_knn(points, 8, exclude_self=True)
    recall = evaluate.recall_at_k(found, truth)
    return recall.agg((F.avg("recall") >= 0.9).alias("near"), F.count("*").alias("rows"))


@_query()
def graph_search(spark, sf_dir):
    points = _stretched(spark, sf_dir)
    built = graph.graph_build(points, 16, "exact")
    return _rounded(graph.graph_search(built, knn.as_queries(points.df, "id"), 10))


# ------------------------------------------------------------------ streaming


def _stream(spark, sf_dir) -> DataFrame:
    # a pattern, as a stream takes a single file by no plain path; a folder of files fits it too
    return (
        spark.readStream.schema(SCHEMAS["embeddings"])
        .parquet(f"{sf_dir}/embeddings.parque[t]")
        .select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    )


@_query(_elements_sql("(SELECT vec_id AS id, embedding AS vec FROM embeddings)", "id"))
def stream_append(spark, sf_dir):
    path = sizing.new_path(spark)
    job = jobs.stream_append(_stream(spark, sf_dir), path, DIM, f"{path}/log", "embeddings")
    job.trigger(availableNow=True).start().awaitTermination()
    return _elements(jobs.appended(spark, path, DIM).df, "id")


@_query(_elements_sql("""(SELECT vec_id AS id, embedding AS vec FROM embeddings
UNION ALL SELECT vec_id + 1000000000, embedding FROM embeddings)""", "id"))
def stream_append_two_writers(spark, sf_dir):
    path = sizing.new_path(spark)
    rows = _stream(spark, sf_dir)
    moved = rows.withColumn("id", F.col("id") + 1000000000)
    for name, source in (("first", rows), ("second", moved)):
        job = jobs.stream_append(source, path, DIM, f"{path}/log-{name}", name)
        job.trigger(availableNow=True).start().awaitTermination()
    # the first one again from the start: nothing is added
    job = jobs.stream_append(rows, path, DIM, f"{path}/log-again", "first", replace=True)
    job.trigger(availableNow=True).start().awaitTermination()
    return _elements(jobs.appended(spark, path, DIM).df, "id")


@_query(f"""WITH plain AS (SELECT vec_id AS id, embedding AS vec FROM embeddings), {STRETCHED},
{_knn_sql("found", "plain", "stretched", 5)} SELECT {RESULT} FROM found""")
def stream_search(spark, sf_dir):
    path = sizing.new_path(spark)
    queries = _stream(spark, sf_dir).withColumnRenamed("id", "qid")
    job = jobs.stream_search(queries, _stretched(spark, sf_dir), 5, path, f"{path}-log", "queries")
    job.trigger(availableNow=True).start().awaitTermination()
    return _rounded(spark.read.parquet(path).drop("writer", "run", "batch"))


@_query(f"""WITH {STRETCHED}, {_means_sql("means", "stretched", "label")},
plain AS (SELECT vec_id AS id, embedding AS vec FROM embeddings),
{_assign_sql("found", "plain", "means")}
SELECT id, CAST(cluster AS INTEGER) AS cluster, round(distance, 6) AS distance FROM found""")
def stream_assign(spark, sf_dir):
    path = sizing.new_path(spark)
    labelled = jobs.stream_assign(_stream(spark, sf_dir), _label_model(spark, sf_dir))
    (
        labelled.drop("vec")
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{path}-log")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return _rounded(spark.read.parquet(path))


# ------------------------------------------------------------ driver contract


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: cosine top-10 with payload over the smallest tables."""
    return semantic_search(spark, "/root/testdata/sf0.001")


def _optional(name: str):
    """A module of the text operators, or None where these are not installed."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as e:
        if e.name not in (name, "nearfield.llm", "corpus_pipeline"):
            raise
        return None


for _name in ("nearfield.llm.registry", "corpus_pipeline"):
    if (_module := _optional(_name)) is not None:
        QUERIES.update(_module.QUERIES)
        ORACLES.update(_module.ORACLES)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
