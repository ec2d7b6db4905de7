"""Line dedup: a line that many documents hold stays in one of them.

Two Bloom filters go over the hashes of all lines: a bit of the first is set by any hash, a bit of
the second once two tasks, or two documents of one task, have set it. Tasks send the bits they set,
segment by segment, to the tasks that merge them. Only lines whose bits are all in the second filter,
the suspects, are shuffled, to count the documents that hold the very line and to choose the one that
keeps it. A false suspect costs a row of that shuffle, and no repeat is missed.

Both filters have ``2 ** bits`` bits whatever the input, 32 MiB each by default; the second is
broadcast. With up to ``2 ** bits / 8`` different lines fewer than 1 in 1,000 lines are suspected in
vain, at ``2 ** bits / 2`` 7 in 100; far beyond that all lines are, and the shuffle takes them all.

A line is compared by its key: without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Keys of
fewer than ``least`` code points are never dropped. Null or empty text is one empty line; null stays
null. Rows that share an id are one document, and each loses its lines. Rows without an id are one
document together, which keeps no repeat. Empty tables give no rows; new columns whose names the table
has get longer ones. A task holds the texts of one batch, and the filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from nearfield.llm.common import documents, pieces, query, stored, unused
from nearfield.plans import sizing

GAP_CHARS = " \t\n\x0b\x0c\r"
LEAST = 20
DOCUMENTS = 3
BITS = 28
#: A segment's bits travel as 16-bit positions, or as a bitmap where that is shorter.
SEGMENT = 16
BITMAP = 1 << SEGMENT - 3
#: Hashes that a task gathers before it sends the bits they set.
GATHERED = 1 << 21
BLOCK_BYTES = 8 << 20


def keys(text: pa.Array, least: int) -> tuple[np.ndarray, pa.Array]:
    """Keys long enough to count, with the row of each."""
    lines = pc.split_pattern(pc.fill_null(text, ""), "\n")
    row = np.repeat(np.arange(len(text)), pc.list_value_length(lines).to_numpy())
    key = pc.ascii_trim(pc.ascii_lower(lines.flatten()), GAP_CHARS)
    long = pc.greater_equal(pc.utf8_length(key), least)
    return row[long.to_numpy(zero_copy_only=False)], key.filter(long)


def hashes(key: pa.Array) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, key.cast(pa.binary()).to_pylist()), np.uint64, len(key))


def once_a_row(row: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Places of a row's different hashes, in order."""
    order = np.lexsort((hashed, row))
    r, h = row[order], hashed[order]
    first = np.ones(len(order), bool)
    first[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return np.sort(order[first])


def places(hashed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash."""
    return (hashed >> np.uint64(64 - bits)).astype(np.int64), (hashed & np.uint64((1 << bits) - 1)).astype(np.int64)


def packed(low: np.ndarray) -> bytes:
    """Ascending positions within a segment."""
    if 2 * len(low) < BITMAP:
        return low.astype("<u2").tobytes()
    bits = np.zeros(1 << SEGMENT, bool)
    bits[low] = True
    return np.packbits(bits).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if len(data) < BITMAP:
        return np.frombuffer(data, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8)))


def _segments(at: np.ndarray) -> dict[int, bytes]:
    at = np.unique(at)
    segment = at >> SEGMENT
    names, first = np.unique(segment, return_index=True)
    return {s: packed(x) for s, x in zip(names.tolist(), np.split(at & (1 << SEGMENT) - 1, first[1:]))}


def _set_bits(gathered: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """The bits that a task's hashes set in both filters."""
    found, times = np.unique(np.concatenate(gathered), return_counts=True)
    once = _segments(np.concatenate(places(found, bits)))
    twice = _segments(np.concatenate(places(found[times > 1], bits)))
    columns = [
        pa.array(once, pa.int32()),
        pa.array(once.values(), pa.binary()),
        pa.array([twice.get(s, b"") for s in once], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["segment", "once", "twice"])


def twice_seen(docs: DataFrame, text: str = "text", least: int = LEAST, bits: int = BITS) -> np.ndarray:
    """The second filter, as a bitmap of ``2 ** bits`` bits."""
    spark = docs.sparkSession

    def bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, n = [], 0
        for batch in pieces(batches, "text", BLOCK_BYTES):
            row, key = keys(batch.column("text"), least)
            hashed = hashes(key)
            gathered.append(hashed[once_a_row(row, hashed)])
            n += len(gathered[-1])
            if n > GATHERED:
                yield _set_bits(gathered, bits)
                gathered, n = [], 0
        if n:
            yield _set_bits(gathered, bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                if segment not in once:
                    once[segment], twice[segment] = np.zeros((2, 1 << SEGMENT), bool)
                low = unpacked(a)
                twice[segment][low] |= once[segment][low]
                twice[segment][unpacked(b)] = True
                once[segment][low] = True
        for segment, found in twice.items():
            if found.any():
                data = pa.array([packed(np.flatnonzero(found))], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), data], names=["segment", "twice"])

    merged = (
        docs.select(F.col(f"`{text}`").alias("text"))
        .mapInArrow(bits_of, "segment int, once binary, twice binary")
        .repartition(sizing.shuffle_partitions(spark), "segment")
        .mapInArrow(merge, "segment int, twice binary")
        .toArrow()
    )
    out = np.zeros((1 << max(bits - SEGMENT, 0), BITMAP), np.uint8)
    for segment, data in zip(merged.column("segment").to_pylist(), merged.column("twice").to_pylist()):
        found = np.zeros(1 << SEGMENT, bool)
        found[unpacked(data)] = True
        out[segment] = np.packbits(found, bitorder="little")
    return out.reshape(-1)


def suspects(docs: DataFrame, doc_id: str, text: str, least: int, bits: int) -> DataFrame:
    """``(doc_id, key)`` of every line that the second filter holds, once per row."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(twice_seen(docs, text, least, bits))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for batch in pieces(batches, "text", BLOCK_BYTES):
            row, key = keys(batch.column("text"), least)
            hashed = hashes(key)
            found = np.ones(len(key), bool)
            for at in places(hashed, bits):
                found &= (seen[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            some = np.flatnonzero(found)
            some = some[once_a_row(row[some], hashed[some])]
            columns = [batch.column("doc_id").take(pa.array(row[some])), key.take(pa.array(some))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key"])

    return rows.mapInArrow(look, rows.select("doc_id").schema.add("key", "string"))


def line_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = LEAST,
    least_documents: int = DOCUMENTS,
    keep: str = "largest",
    bits: int = BITS,
) -> DataFrame:
    """The table without lines that ``least_documents`` hold, but for the document that keeps each.

    That is the one of the largest id, or of the smallest. New columns: ``n_lines`` before the drop
    and ``n_dropped``.
    """
    if least_documents < 2:
        raise ValueError("least_documents must be at least 2")
    if not SEGMENT <= bits <= 32:
        raise ValueError(f"bits must lie between {SEGMENT} and 32")
    pick = {"largest": F.max, "smallest": F.min}[keep]
    met = stored(suspects(docs, doc_id, text, least, bits))
    repeated = stored(
        met.groupBy("key")
        .agg(F.count_distinct(F.struct("doc_id")).alias("n"), pick("doc_id").alias("keeper"))
        .filter(F.col("n") >= least_documents)
        .select("key", "keeper")
    )
    # tables of their own on both sides of a join, so that Spark can split a hot key of it
    dropped = stored(
        met.join(repeated, "key")
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias("keys"))
    )
    names = unused(docs, "n_lines", "n_dropped", "keys", "dropped_id")
    dropped = dropped.select(F.col("doc_id").alias(names[3]), F.col("keys").alias(names[2]))
    joined = docs.join(dropped, F.col(f"`{doc_id}`").eqNullSafe(F.col(f"`{names[3]}`")), "left").drop(names[3])
    schema = StructType([*docs.schema]).add(names[0], "long").add(names[1], "long")
    at, given = docs.columns.index(text), len(docs.columns)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, BLOCK_BYTES):
            whole, gone = batch.column(at), batch.column(given)
            n_lines = pc.add(pc.fill_null(pc.count_substring(whole, "\n"), 0), 1).cast(pa.int64())
            n_dropped = np.zeros(len(batch), np.int64)
            some = np.flatnonzero(gone.is_valid().to_numpy(zero_copy_only=False))
            if len(some):
                out = whole.cast(pa.binary()).to_pylist()
                taken = gone.take(pa.array(some)).cast(pa.list_(pa.binary())).to_pylist()
                for i, keys_gone in zip(some.tolist(), map(set, taken)):
                    if out[i] is not None:
                        lines = out[i].split(b"\n")
                        left = [x for x in lines if x.strip(GAP_CHARS.encode()).lower() not in keys_gone]
                        out[i], n_dropped[i] = b"\n".join(left), len(lines) - len(left)
                whole = pa.array(out, pa.binary()).cast(pa.string())
            columns = [whole if k == at else c for k, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays([*columns, n_lines, pa.array(n_dropped)], names=schema.names)

    return joined.mapInArrow(rewrite, schema)


SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {LEAST}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {DOCUMENTS}),
judged AS (
  SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
  FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query(SQL)
def op13_line_dedup(spark, sf_dir):
    out = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return out.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))
