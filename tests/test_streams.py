import numpy as np
import pytest
from pyspark.sql import functions as F

import data
from nearfield.operators import kmeans, knn
from nearfield.plans import sizing
from nearfield.streaming import jobs


def stream(spark, folder, files=1):
    return (
        spark.readStream.schema("id long, vec array<float>")
        .option("maxFilesPerTrigger", files)
        .parquet(str(folder))
    )


def run(job):
    job.trigger(availableNow=True).start().awaitTermination()


def source(spark, folder, x):
    for s in range(0, len(x), 50):
        ids = list(range(s, min(s + 50, len(x))))
        data.rows(spark, x[s : s + 50], ids).write.mode("append").parquet(str(folder))


def test_append_counts_every_row_once(spark, tmp_path):
    source(spark, tmp_path / "in", np.eye(8).repeat(25, 0))
    bad = spark.createDataFrame([(999, [1.0])], "id long, vec array<float>")
    bad.write.mode("append").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    run(jobs.stream_append(stream(spark, tmp_path / "in"), out, 8, f"{out}-log", "a"))
    assert jobs.appended(spark, out, 8).df.count() == 200
    assert [r.id for r in spark.read.parquet(f"{out}/rejects").collect()] == [999]
    # a second run has nothing new
    run(jobs.stream_append(stream(spark, tmp_path / "in"), out, 8, f"{out}-log", "a"))
    assert jobs.appended(spark, out, 8).df.count() == 200
    # a replay, cut into other batches, replaces the first run
    whole = stream(spark, tmp_path / "in", files=100)
    run(jobs.stream_append(whole, out, 8, f"{out}-log2", "a", replace=True))
    assert jobs.appended(spark, out, 8).df.count() == 200
    assert jobs.appended(spark, out, 8).df.select("id").distinct().count() == 200
    assert spark.read.parquet(f"{out}/rejects").count() == 1


def test_writers_never_meet(spark, tmp_path):
    x = np.eye(8)
    out = str(tmp_path / "out")
    for name in ("left", "right"):
        data.rows(spark, x, [len(name) * 100 + i for i in range(8)]).write.parquet(str(tmp_path / name))
        rows = stream(spark, tmp_path / name)
        run(jobs.stream_append(rows, out, 8, f"{out}-{name}", name))
    assert jobs.appended(spark, out, 8).df.count() == 16
    # the same writer with a new checkpoint and other rows: nothing is lost
    data.rows(spark, x, list(range(8))).write.parquet(str(tmp_path / "more"))
    run(jobs.stream_append(stream(spark, tmp_path / "more"), out, 8, f"{out}-more", "left"))
    assert jobs.appended(spark, out, 8).df.select("id").distinct().count() == 24
    # a replay of one writer leaves the other alone
    again = stream(spark, tmp_path / "more")
    run(jobs.stream_append(again, out, 8, f"{out}-again", "left", replace=True))
    ids = {r.id for r in jobs.appended(spark, out, 8).df.collect()}
    assert ids == set(range(8)) | {500 + i for i in range(8)}
    with pytest.raises(ValueError, match="writer's name"):
        jobs.stream_append(again, out, 8, f"{out}-x", "a/b")


def test_bad_query_fails_the_stream(spark, tmp_path):
    data.rows(spark, np.array([[np.nan] * 6]), [3]).write.parquet(str(tmp_path / "in"))
    queries = stream(spark, tmp_path / "in").withColumnRenamed("id", "qid")
    table = data.points(spark, data.blobs(20, 6, 2))
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="vector 3 rejected: non_finite"):
        run(jobs.stream_search(queries, table, 2, out, f"{out}-log", "q"))


def test_search_equals_batch(spark, tmp_path):
    x = data.blobs(200, 6, 5)
    source(spark, tmp_path / "in", x)
    table = data.points(spark, x)
    out = str(tmp_path / "out")
    queries = stream(spark, tmp_path / "in").withColumnRenamed("id", "qid")
    run(jobs.stream_search(queries, table, 4, out, f"{out}-log", "q"))
    data.same(data.collected(spark.read.parquet(out)), data.brute_force(x, x, 4))


def test_assign_equals_batch(spark, tmp_path):
    x = data.blobs(200, 6, 5)
    source(spark, tmp_path / "in", x)
    table = data.points(spark, x)
    model = kmeans.kmeans_train(table, 5, iterations=4)
    out = str(tmp_path / "out")
    labelled = jobs.stream_assign(stream(spark, tmp_path / "in"), model)
    run(
        labelled.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{out}-log")
    )
    got = {r.id: r.cluster for r in spark.read.parquet(out).collect()}
    assert got == {r.id: r.cluster for r in kmeans.assign(model, table.df).collect()}


def test_assign_with_a_model_beyond_the_broadcast_limit(spark, tmp_path):
    x = data.blobs(100, 6, 5)
    source(spark, tmp_path / "in", x)
    table = data.points(spark, x)
    model = kmeans.kmeans_train(table, 5, iterations=4)
    want = {r.id: r.cluster for r in kmeans.assign(model, table.df).collect()}
    out = str(tmp_path / "out")
    rows = stream(spark, tmp_path / "in")
    spark.conf.set(sizing.BROADCAST_BYTES, "100")
    try:
        with pytest.raises(ValueError, match="broadcast limit"):
            jobs.stream_assign(rows, model)
        run(jobs.stream_assign_batches(rows, model, out, f"{out}-log", "w"))
    finally:
        spark.conf.unset(sizing.BROADCAST_BYTES)
    assert {r.id: r.cluster for r in spark.read.parquet(out).collect()} == want


def test_concurrent_appends_add_up(spark, tmp_path):
    from threading import Thread

    path = str(tmp_path / "shared")

    def work(n):
        rows = data.rows(spark, np.eye(8).repeat(7, 0)[:50], list(range(50 * n, 50 * n + 50)))
        jobs.append_batch(rows, jobs.Writer(path, f"writer{n}", "log"), 8, 0)

    threads = [Thread(target=work, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    table = jobs.appended(spark, path, 8)
    assert table.df.select("id").distinct().count() == table.count() == 200
    assert knn.self_knn(table, 1).filter(F.col("distance") == 0).count() == 200


def test_queries_stream_a_file_or_a_folder(spark, tmp_path):
    import __spark_entry__ as entry

    x = data.blobs(60, entry.DIM, 4)
    rows = data.rows(spark, x).withColumnsRenamed({"id": "vec_id", "vec": "embedding"})
    rows = rows.withColumn("label", (F.col("vec_id") % 4).cast("int"))
    rows.repartition(3).write.parquet(str(tmp_path / "folder" / "embeddings.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    (tmp_path / "file").mkdir()
    next((tmp_path / "one").glob("part-*.parquet")).rename(tmp_path / "file" / "embeddings.parquet")
    names = {"stream_append": 60, "stream_append_two_writers": 120, "stream_search": 60, "stream_assign": 60}
    for name, count in names.items():
        folder, file = (entry.queries()[name](spark, str(tmp_path / kind)) for kind in ("folder", "file"))
        id = "qid" if name == "stream_search" else "id"
        assert folder.select(id).distinct().count() == count
        assert folder.exceptAll(file).isEmpty() and file.exceptAll(folder).isEmpty()
