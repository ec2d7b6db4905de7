"""L2 k-means: training, centroids, assignment."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from nearfield.functions.kernels import TopK, matrix
from nearfield.operators.knn import knn_join
from nearfield.operators.shape import within
from nearfield.plans import sizing
from nearfield.sources.table import VectorTable, check_positive, number_rows

SPLIT = 1 / 1024


@dataclass(frozen=True)
class KMeansModel:
    """``k`` centroids of one dimension; untrained until it has them.

    ``table`` holds ``(id = cluster, vec array<double>)``.
    """

    k: int
    dim: int
    table: VectorTable | None = None
    inertia: tuple[float, ...] = ()

    @property
    def trained(self) -> bool:
        return self.table is not None

    def centroids(self) -> DataFrame:
        """k rows ``(cluster, vec)``."""
        self.require()
        return self.table.df.select(F.col("id").cast("int").alias("cluster"), "vec")

    def require(self) -> "KMeansModel":
        if not self.trained:
            raise RuntimeError("clustering not trained")
        return self


def kmeans_model(dim: int, k: int) -> KMeansModel:
    """Untrained model."""
    return KMeansModel(check_positive("k", k), check_positive("dim", dim))


def from_centroids(spark: SparkSession, centroids: np.ndarray, inertia=()) -> KMeansModel:
    """Trained model around a matrix of centroids."""
    k, dim = centroids.shape
    rows = pa.table(
        {
            "id": pa.array(np.arange(k)),
            "vec": pa.array(list(centroids.astype(np.float64)), pa.list_(pa.float64())),
        }
    )
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    return KMeansModel(k, dim, VectorTable(df, dim, "l2", k), tuple(inertia))


def kmeans_train(
    table: VectorTable,
    k: int,
    iterations: int = 25,
    init: DataFrame | None = None,
    seed: int = 1,
) -> KMeansModel:
    """Lloyd's algorithm; always k centroids, from at least k rows.

    Starts from ``init(cluster, vec)`` or k rows picked by a seeded hash of
    the id. Each round is one job: tasks add up their rows per cluster, Spark
    merges the sums, and k sums return to the driver. Training stops early
    when no centroid moves. Models beyond the broadcast limit stay distributed.
    """
    check_positive("k", k)
    df, dim, spark = table.df.select("id", "vec"), table.dim, table.df.sparkSession
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = df.count()
        if rows == 0:
            raise ValueError("cannot train on an empty table")
        if rows < k:
            raise ValueError(f"cannot train {k} clusters on {rows} rows")
        if not sizing.fits(spark, k, 2 * dim):
            return _train_distributed(df, init, k, dim, rows, iterations, seed)
        if init is None:
            init = df.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(k)
        centroids = _start_matrix(init, k, dim)
        inertia: list[float] = []
        for _ in range(iterations):
            sums, counts, cost = _sums(df, centroids, dim)
            inertia.append(cost)
            moved = next_centroids(centroids, sums, counts)
            still = np.array_equal(moved, centroids)
            centroids = moved
            if still:
                break
        return from_centroids(spark, centroids, inertia)
    finally:
        df.unpersist()


def _start_matrix(start: DataFrame, k: int, dim: int) -> np.ndarray:
    order = "cluster" if "cluster" in start.columns else None
    cols = [F.col("vec").cast("array<double>").alias("vec")]
    picked = (start.orderBy(order) if order else start).select(*cols).limit(k + 1).toArrow()
    if picked.num_rows != k:
        raise ValueError(f"init must hold exactly {k} centroids")
    return sizing.doubles(picked.column("vec").combine_chunks(), dim)


def _sums(df: DataFrame, centroids: np.ndarray, dim: int):
    """Vector sum, row count and cost per cluster for one assignment pass."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(centroids)

    def add(batches):
        model = shared.value
        k = len(model)
        sums, counts, cost = np.zeros((k, dim)), np.zeros(k, np.int64), np.zeros(k)
        for batch in batches:
            x = matrix(batch.column("vec"), dim)
            cluster, d = nearest(x, model)
            order = np.argsort(cluster, kind="stable")
            present, first = np.unique(cluster[order], return_index=True)
            sums[present] += np.add.reduceat(x[order].astype(np.float64), first, axis=0)
            counts += np.bincount(cluster, minlength=k)
            cost += np.bincount(cluster, d, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used),
                pa.array(list(sums[used]), pa.list_(pa.float64())),
                pa.array(counts[used]),
                pa.array(cost[used]),
            ],
            names=["cluster", "total", "n", "cost"],
        )

    partial = (
        df.select("vec")
        .coalesce(sizing.merge_width(spark))
        .mapInArrow(add, "cluster long, total array<double>, n long, cost double")
    )
    if not few_sums(spark, centroids.size):
        partial = merge_sums(partial, F.sum("cost").alias("cost"))
    found = partial.toArrow()
    shared.destroy()
    return *add_sums(found, centroids.shape), float(np.sum(found.column("cost").to_numpy()))


def few_sums(spark: SparkSession, size: int) -> bool:
    """Whether the partial sums of all tasks may go to the driver unmerged."""
    return sizing.merge_width(spark) * size * 8 <= sizing.broadcast_bytes(spark)


def add_sums(found: pa.Table, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Vector sums and row counts per cluster from collected partial sums."""
    sums, counts = np.zeros(shape), np.zeros(shape[0], np.int64)
    cluster = found.column("cluster").to_numpy()
    if len(cluster):
        total = sizing.doubles(found.column("total").combine_chunks(), shape[1])
        np.add.at(sums, cluster, total)
        np.add.at(counts, cluster, found.column("n").to_numpy())
    return sums, counts


def merge_sums(partial: DataFrame, *more: Column) -> DataFrame:
    """Adds up partial ``(cluster, total, n)`` rows, element by element."""
    return partial.groupBy("cluster").agg(
        vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total"),
        F.sum("n").alias("n"),
        *more,
    )


def nearest(x: np.ndarray, centroids: np.ndarray):
    """Cluster and squared distance of each row; ties go to the smaller cluster."""
    best = TopK(np.arange(len(x)), x, 1, "l2")
    best.push(np.arange(len(centroids)), centroids)
    return best.ids[:, 0], best.cost[:, 0]


def next_centroids(old: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Means of the clusters; an empty one takes half of the largest."""
    counts = counts.astype(np.float64)
    out = old.copy()
    full = counts > 0
    out[full] = sums[full] / counts[full, None]
    for empty in np.flatnonzero(~full):
        donor = counts.argmax()
        nudge = np.where(np.arange(out.shape[1]) % 2 == 0, 1 + SPLIT, 1 - SPLIT)
        out[empty], out[donor] = out[donor] * nudge, out[donor] * (2 - nudge)
        counts[empty] = counts[donor] = counts[donor] / 2
    return out


def _train_distributed(
    df: DataFrame, init: DataFrame | None, k: int, dim: int, rows: int, iterations: int, seed: int
) -> KMeansModel:
    """The same rounds with centroids as a table, for models too large to broadcast.

    Centroids are kept as float32, which is all that differs.
    """
    if init is not None:
        start = init.withColumn("id", F.col("cluster").cast("long"))
    else:
        start = _many_starts(df, k, rows, seed)
    start = sizing.cut_lineage(start.select("id", F.col("vec").cast("array<float>")))
    if start.count() != k:
        raise ValueError(f"init must hold exactly {k} centroids")
    centroids = VectorTable(start, dim, "l2", k)
    # ids may repeat, so rows are found again by a key of their own
    df = sizing.cut_lineage(df.withColumn("id", F.monotonically_increasing_id()))
    inertia: list[float] = []
    for _ in range(iterations):
        means = (
            df.join(assign_rows(df, centroids, rows), "id")
            .groupBy(F.col("cluster").cast("long").alias("id"))
            .agg(
                vector_to_array(Summarizer.mean(array_to_vector("vec"))).alias("mean"),
                F.count("*").alias("n"),
                F.sum("distance").alias("cost"),
            )
        )
        moved = sizing.cut_lineage(
            centroids.df.join(means, "id", "left").select(
                "id",
                F.coalesce(F.col("mean").cast("array<float>"), "vec").alias("vec"),
                (F.col("mean").cast("array<float>") == F.col("vec")).alias("still"),
                F.coalesce("n", F.lit(0)).alias("n"),
                "cost",
            )
        )
        cost, empty, moving = moved.agg(
            F.sum("cost"), F.count_if(F.col("n") == 0), F.count_if(~F.col("still"))
        ).first()
        inertia.append(cost)
        after = _split_largest(moved, empty) if empty else moved.select("id", "vec")
        centroids = VectorTable(after, dim, "l2", k)
        if not empty and not moving:
            break
    return KMeansModel(k, dim, centroids, tuple(inertia))


def _split_largest(moved: DataFrame, empty: int) -> DataFrame:
    """Centroids of which each empty cluster has taken half of the then largest one.

    Only clusters among the ``empty`` largest can be split, so their sizes and the numbers of the
    empty ones suffice to decide; the vectors stay where they are.
    """
    gaps = [r.id for r in moved.filter("n = 0").orderBy("id").select("id").collect()]
    top = moved.filter("n > 0").orderBy(F.desc("n"), "id").limit(empty).select("id", "n").collect()
    heap = [(-float(r.n), r.id) for r in top]
    heapq.heapify(heap)
    # what each changed cluster is made of: a centroid, and factors of its even and odd elements
    made = {r.id: (r.id, 1.0, 1.0) for r in top}
    for gap in gaps:
        size, donor = heapq.heappop(heap)
        base, even, odd = made[donor]
        made[gap] = (base, even * (1 + SPLIT), odd * (1 - SPLIT))
        made[donor] = (base, even * (1 - SPLIT), odd * (1 + SPLIT))
        for part in (donor, gap):
            heapq.heappush(heap, (size / 2, part))
    rows = [(i, *x) for i, x in made.items()]
    spark = moved.sparkSession
    changes = spark.createDataFrame(rows, "_id long, _base long, _even double, _odd double")
    split = changes.join(moved, F.col("_base") == F.col("id")).select(
        F.col("_id").alias("id"),
        F.expr("transform(vec, (x, i) -> float(x * if(i % 2 = 0, _even, _odd)))").alias("vec"),
    )
    rest = moved.join(changes, F.col("_id") == F.col("id"), "left_anti").select("id", "vec")
    return sizing.cut_lineage(rest.unionByName(split))


def _many_starts(df: DataFrame, k: int, rows: int, seed: int) -> DataFrame:
    """The k rows smallest by a seeded hash, numbered, without collecting them."""
    place = F.xxhash64(F.col("id"), F.lit(seed))
    share = min(1.0, 2 * k / rows)
    while True:
        # hashes spread evenly over 64 bits, so this keeps about 2k rows
        few = df.filter(place / 2.0**64 + 0.5 < share) if share < 1 else df
        numbered, found = number_rows(
            few.select(F.col("id").alias("row"), "vec", place.alias("place")), "place"
        )
        if found >= k:
            return numbered.filter(F.col("id") < k)
        share = min(1.0, 4 * share)


def assign_rows(df: DataFrame, centroids: VectorTable, rows: int | None = None) -> DataFrame:
    """``(id, cluster, distance)``: nearest centroid and squared distance of each row."""
    queries = df.select(F.col("id").alias("qid"), "vec")
    found = knn_join(queries, centroids, 1, "l2", rows)
    return found.select(
        F.col("qid").alias("id"), F.col("id").cast("int").alias("cluster"), "distance"
    )


def assign(model: KMeansModel, df: DataFrame) -> DataFrame:
    """``(id, cluster, distance)`` per row; map-only while the centroids can be broadcast."""
    rows = with_cluster(df.select("id", "vec"), model.require().table)
    return rows.select(F.col("id").cast("long").alias("id"), "cluster", "distance")


def with_cluster(
    df: DataFrame, centroids: VectorTable, name: str = "cluster", metric: str = "l2"
) -> DataFrame:
    """``df(id, vec, ...)`` with the nearest centroid and its distance as columns.

    While the centroids can be broadcast only ``vec`` visits Python and no row
    moves; beyond that the assignment is joined back on a key of the row, as
    ids may repeat.
    """
    local = sizing.small_matrix(centroids.df, "id", centroids.dim, centroids.rows)
    if local is None:
        rows = sizing.cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
        queries = rows.select(F.col("_row").alias("qid"), "vec")
        found = knn_join(queries, centroids, 1, metric).select(
            F.col("qid").alias("_row"), F.col("id").cast("int").alias(name), "distance"
        )
        return rows.join(found, "_row").drop("_row")
    shared, dim = df.sparkSession.sparkContext.broadcast(local), centroids.dim

    @F.arrow_udf("struct<cluster: int, distance: double>")
    def find(vec: pa.Array) -> pa.Array:
        ids, model = shared.value
        x = matrix(vec, dim)
        best = TopK(np.arange(len(x)), x, 1, metric)
        best.push(ids, model)
        cost = best.cost[:, 0]
        distance = cost if metric == "l2" else 0.0 - cost
        return pa.StructArray.from_arrays(
            [pa.array(best.ids[:, 0].astype(np.int32)), pa.array(distance)],
            names=["cluster", "distance"],
        )

    # not deterministic: keeps a later filter from running the function twice
    found = df.withColumn("_near", find.asNondeterministic()("vec"))
    return found.select(
        *df.columns, F.col("_near.cluster").alias(name), F.col("_near.distance").alias("distance")
    )


def near_centroid_filter(model: KMeansModel, df: DataFrame, threshold: float) -> DataFrame:
    """Rows closer to their centroid than the threshold, with cluster and distance."""
    return within(with_cluster(df, model.require().table), threshold)
