"""Packed binaries: row-major little-endian float32 vectors and signed 64-bit ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.functions.kernels import blobs, int64, matrix, vectors
from nearfield.sources.table import check_positive

SLICE = 8192


def from_base64(df: DataFrame, *columns: str) -> DataFrame:
    """Base64 text columns as binary."""
    return df.withColumns({c: F.unbase64(c) for c in columns})


def _size_error(column: str, what: str, unit: int, why: str) -> Column:
    size = F.octet_length(column)
    return F.when(
        size % unit != 0,
        F.concat(
            F.lit(f"{what} has "),
            size.cast("string"),
            F.lit(f" bytes, expected a multiple of {unit} ({why})"),
        ),
    )


def packed_reason(dim: int, data: str = "data", ids: str | None = None) -> Column:
    """What is wrong with a packed row, NULL for a good one."""
    reason = F.coalesce(
        F.when(F.col(data).isNull(), "binary is null"),
        _size_error(data, "binary", 4 * dim, f"dim {dim} * 4 bytes per float32"),
    )
    if ids is None:
        return reason
    return F.coalesce(
        reason,
        F.when(F.col(ids).isNull(), "ids binary is null"),
        _size_error(ids, "ids binary", 8, "8 bytes per id"),
        F.when(
            F.octet_length(data) / (4 * dim) != F.octet_length(ids) / 8,
            "binary size mismatch: as many ids as vectors are needed",
        ),
    )


def split_packed(
    df: DataFrame, dim: int, data: str = "data", ids: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(good rows, rejected rows with a reason)``."""
    check_positive("dim", dim)
    marked = df.withColumn("reason", packed_reason(dim, data, ids))
    good = marked.filter(F.col("reason").isNull()).drop("reason")
    return good, marked.filter(F.col("reason").isNotNull())


def _sound(df: DataFrame, dim: int, data: str, ids: str | None) -> DataFrame:
    reason = packed_reason(dim, data, ids)
    sound = F.when(reason.isNull(), F.col(data)).otherwise(F.raise_error(reason))
    return df.withColumn(data, sound)


def joined(col: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all blobs of a column one after the other, and how many each holds."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    width = np.dtype(kind).itemsize
    if not len(col):
        return np.empty(0, kind), np.empty(0, np.int64)
    wide = col.cast(pa.large_binary())
    ends = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.empty(0, np.uint8)
    return np.frombuffer(held.tobytes(), kind), np.diff(ends) // width


def unpack_vectors(
    df: DataFrame, dim: int, data: str = "data", blob_id: str = "blob_id", ids: str | None = None
) -> DataFrame:
    """One row per packed vector: ``(blob_id, pos, [id,] vec)``.

    With ``ids`` a second blob holds one id per vector. A blob of a wrong size
    fails the job; see :func:`split_packed`.
    """
    check_positive("dim", dim)
    columns = [blob_id, data] + ([ids] if ids else [])

    def unpack(batches):
        for batch in batches:
            flat, sizes = joined(batch.column(1), "<f4")
            mat, counts = flat.reshape(-1, dim), sizes // dim
            keys = joined(batch.column(2), "<i8")[0] if ids else None
            blob = np.repeat(np.arange(len(counts)), counts)
            pos = np.arange(len(mat)) - np.repeat(np.cumsum(counts) - counts, counts)
            for s in range(0, len(mat), SLICE):
                part = slice(s, s + SLICE)
                out = [batch.column(0).take(pa.array(blob[part])), pa.array(pos[part].astype(np.int32))]
                out += [pa.array(keys[part])] if ids else []
                yield pa.RecordBatch.from_arrays(out + [vectors(mat[part])], names=fields)

    kind = df.schema[blob_id].dataType.simpleString()
    fields = ["blob_id", "pos"] + (["id"] if ids else []) + ["vec"]
    schema = f"blob_id {kind}, pos int, " + ("id long, " if ids else "") + "vec array<float>"
    return _sound(df.select(*columns), dim, data, ids).mapInArrow(unpack, schema)


def unpack_ids(df: DataFrame, ids: str = "ids", blob_id: str = "blob_id") -> DataFrame:
    """One row per packed id: ``(blob_id, pos, id)``."""
    wrong = _size_error(ids, "ids binary", 8, "8 bytes per id")
    sound = F.when(wrong.isNull(), F.col(ids)).otherwise(F.raise_error(wrong))

    @F.arrow_udf("array<long>")
    def decode(col: pa.Array) -> pa.Array:
        flat, sizes = joined(col, "<i8")
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return df.select(
        F.col(blob_id).alias("blob_id"), F.posexplode(decode(sound)).alias("pos", "id")
    )


def zip_ids(vecs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs ``(blob_id, pos, vec)`` with ``(blob_id, pos, id)`` by position.

    Rows without a partner, where counts differ, come back as rejects.
    """
    both = vecs.join(ids, ["blob_id", "pos"], "full")
    lone = F.col("vec").isNull() | F.col("id").isNull()
    reason = F.when(F.col("id").isNull(), "no_id").otherwise("no_vector")
    return both.filter(~lone), both.filter(lone).withColumn("reason", reason)


def export_packed(df: DataFrame, dim: int, chunk: int = SLICE) -> DataFrame:
    """Rows ``(id, vec)`` as blobs of up to ``chunk`` vectors in id order.

    ``(first_id, n, ids, data)``; sorting by ``first_id`` gives the global order.
    """
    check_positive("chunk", chunk)

    def pack(batches):
        for ids, mat in _chunks(
            ((int64(b.column("id")), matrix(b.column("vec"), dim)) for b in batches), chunk
        ):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[:1]),
                    pa.array([len(ids)], pa.int32()),
                    blobs(ids.astype("<i8").reshape(1, -1)),
                    blobs(mat.astype("<f4").reshape(1, -1)),
                ],
                names=["first_id", "n", "ids", "data"],
            )

    ordered = df.select("id", "vec").repartitionByRange("id").sortWithinPartitions("id")
    return ordered.mapInArrow(pack, "first_id long, n int, ids binary, data binary")


def export_results(padded: DataFrame, k: int, chunk: int = SLICE) -> DataFrame:
    """Padded results as packed labels and float32 distances, k per query, row-major.

    ``(first_qid, n, qids, labels, distances)`` for up to ``chunk`` queries per
    blob; a missing distance is written as NaN.
    """
    check_positive("k", k)
    check_positive("chunk", chunk)

    def pack(batches):
        columns = ("qid", "id", "distance")
        arrays = (
            tuple(b.column(c).to_numpy(zero_copy_only=False) for c in columns) for b in batches
        )
        for qids, labels, distances in _chunks(arrays, chunk * k):
            qids = qids[::k]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(qids[:1]),
                    pa.array([len(qids)], pa.int32()),
                    blobs(qids.astype("<i8").reshape(1, -1)),
                    blobs(labels.astype("<i8").reshape(1, -1)),
                    blobs(distances.astype("<f4").reshape(1, -1)),
                ],
                names=["first_qid", "n", "qids", "labels", "distances"],
            )

    ordered = padded.repartitionByRange("qid").sortWithinPartitions("qid", "rank")
    return ordered.select("qid", "id", "distance").mapInArrow(
        pack, "first_qid long, n int, qids binary, labels binary, distances binary"
    )


def _chunks(parts, size: int):
    """Regroups tuples of equally long arrays into tuples of ``size`` rows."""
    held: list[tuple] = []
    rows = 0
    for part in parts:
        held.append(part)
        rows += len(part[0])
        if rows >= size:
            whole = [np.concatenate(c) for c in zip(*held)]
            cut = rows - rows % size
            for s in range(0, cut, size):
                yield tuple(c[s : s + size] for c in whole)
            held, rows = [tuple(c[cut:] for c in whole)], rows - cut
    if rows:
        yield tuple(np.concatenate(c) for c in zip(*held))
