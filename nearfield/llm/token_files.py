"""Token ids in files of directly addressable codes.

An id is split into chunks of 8 bits. Level 0 holds the lowest chunk of every id, level 1 the next
chunk of those that have one, and so on. A bitmap per level tells which entries continue, and a rank
directory counts the set bits before any place, which is where an entry continues on the next level.
Any id is found from its index in as many steps as it has chunks; nothing is decoded in front of it.

A segment holds the ids of consecutive documents with their document table and is complete in
itself. Segments are rows of a Parquet folder, so that Spark's commit makes a rerun task harmless
and any store that Spark writes will do. Shards follow ascending ids of documents; null ids come
first. The order among rows with one id follows their text. Null text reads as empty.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearfield.llm.common import documents, new_path, pieces, query, texts
from nearfield.llm.word_ids import with_end, word_ids

END_ID = 1
PIECE_BYTES = 4 << 20
SUPER = 512
MAGIC = b"DACT"


# ---------------------------------------------------------------------- codes


def _level(more: np.ndarray) -> list[np.ndarray]:
    """Bitmap as 64-bit words, ones before each super-block, ones before each word within it."""
    n = -(-len(more) // SUPER) * SUPER + SUPER
    bits = np.zeros(n, bool)
    bits[: len(more)] = more
    words = np.packbits(bits, bitorder="little").view("<u8")
    ones = np.bitwise_count(words).astype(np.int64).reshape(-1, SUPER // 64)
    inside = np.cumsum(ones, axis=1) - ones
    before = np.cumsum(ones.sum(axis=1)) - ones.sum(axis=1)
    return [words, before.astype("<u8"), inside.astype("<u2").ravel()]


def encode_ids(ids: np.ndarray) -> bytes:
    """The codes of unsigned 32-bit ids."""
    rest = np.ascontiguousarray(ids, "<u4")
    out = []
    while True:
        chunk, rest = (rest & 0xFF).astype(np.uint8), rest >> 8
        more = rest > 0
        level = [chunk, *_level(more)]
        out.append(struct.pack("<QQ", len(chunk), sum(x.nbytes for x in level)) + b"".join(x.tobytes() for x in level))
        rest = rest[more]
        if not len(rest):
            return struct.pack("<B", len(out)) + b"".join(out)


class Codes:
    """Reads ids at any index from codes."""

    def __init__(self, data: bytes | memoryview):
        data = memoryview(data)
        at, self.levels = 1, []
        for _ in range(data[0]):
            n, size = struct.unpack_from("<QQ", data, at)
            at += 16
            supers = -(-n // SUPER) + 1
            parts, end = [], at + size
            for kind, count in (("u1", n), ("<u8", supers * SUPER // 64), ("<u8", supers), ("<u2", supers * SUPER // 64)):
                parts.append(np.frombuffer(data, kind, count, at))
                at += parts[-1].nbytes
            assert at == end
            self.levels.append(parts)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _rank(level, at: np.ndarray) -> np.ndarray:
        _, words, before, inside = level
        below = words[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return before[at >> 9].astype(np.int64) + inside[at >> 6] + np.bitwise_count(below)

    def get(self, at) -> np.ndarray:
        """The ids at these indexes, in any order."""
        at = np.asarray(at, np.int64)
        out, open_ = np.zeros(len(at), np.uint32), np.arange(len(at))
        for k, level in enumerate(self.levels):
            out[open_] |= level[0][at].astype(np.uint32) << np.uint32(8 * k)
            more = (level[1][at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            at, open_ = self._rank(level, at[more]), open_[more]
        return out

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids from one index up to another; each level is entered at its rank."""
        return self._slice(0, start, stop)

    def _slice(self, k: int, start: int, stop: int) -> np.ndarray:
        level = self.levels[k]
        out = level[0][start:stop].astype(np.uint32)
        if k + 1 == len(self.levels):
            return out
        first = start >> 6
        bits = np.unpackbits(level[1][first : (stop >> 6) + 1].view(np.uint8), bitorder="little")
        more = bits[start - (first << 6) : stop - (first << 6)].astype(bool)
        a, b = self._rank(level, np.array([start, stop], np.int64)).tolist()
        out[more] |= self._slice(k + 1, a, b) << np.uint32(8)
        return out


# ------------------------------------------------------------------- segments


def encode_segment(doc_ids: np.ndarray, known: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> bytes:
    """A segment file: magic, counts, table of documents (id, whether it is null, end), codes."""
    head = MAGIC + struct.pack("<QQ", len(doc_ids), len(ids))
    table = doc_ids.astype("<i8").tobytes() + ends.astype("<u8").tobytes() + known.astype("u1").tobytes()
    return head + table + encode_ids(ids)


def decode_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, Codes]:
    """Ids of documents, whether each is known, ends of documents, codes."""
    data = memoryview(data)
    if data[:4] != MAGIC:
        raise ValueError("not a token segment")
    n, _ = struct.unpack_from("<QQ", data, 4)
    doc_ids = np.frombuffer(data, "<i8", n, 20)
    ends = np.frombuffer(data, "<u8", n, 20 + 8 * n).astype(np.int64)
    known = np.frombuffer(data, "u1", n, 20 + 16 * n).astype(bool)
    return doc_ids, known, ends, Codes(data[20 + 17 * n :])


def packed_ids(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values of the ids up to each end, without a copy."""
    if 4 * len(ids) > 2**31 - 1:
        raise ValueError("more ids than one batch can hold")
    offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
    data = pa.py_buffer(np.ascontiguousarray(ids, "<u4"))
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), data])


SEGMENTS = "shard int, segment long, n_docs long, n_tokens long, first_token long, file binary"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end=END_ID, doc_id="doc_id", text="text"):
    """Encodes whole texts and writes them as segments in ascending order of ``doc_id``."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, encode = TaskContext.get().partitionId(), 0, word_ids(tokenizer)
        for k, batch in enumerate(pieces(batches, "text", PIECE_BYTES)):
            ids, ends = with_end(*encode(texts(batch, "text")), end)
            key = batch.column("doc_id")
            known = key.is_valid().to_numpy(zero_copy_only=False)
            file = encode_segment(key.fill_null(0).to_numpy(), known, ends, ids)
            row = {"shard": shard, "segment": k, "n_docs": len(ends), "n_tokens": len(ids), "first_token": first, "file": file}
            types = [pa.int32(), *[pa.int64()] * 4, pa.binary()]
            first += len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], names=[*row]
            )

    rows.mapInArrow(run, SEGMENTS).write.option("compression", "none").parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: ``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit)."""
    files = spark.read.schema(SEGMENTS).parquet(folder)
    # one row per shard, and there are as many shards as one shuffle has partitions
    shards = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = files.join(F.broadcast(base), "shard").select(
        (F.col("base") + F.col("first_token")).alias("start"), "file"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, file in zip(batch.column("start").to_pylist(), batch.column("file"), strict=True):
                doc_ids, known, ends, codes = decode_segment(file.as_buffer())
                start = np.concatenate([[0], ends[:-1]])
                out = [
                    pa.array(doc_ids, mask=~known),
                    pa.array(first + start),
                    pa.array(ends - start),
                    packed_ids(codes.slice(0, len(codes)), ends),
                ]
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "start", "n_tokens", "ids"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


@query()
def op2_token_files(spark, sf_dir):
    import public_tokenizers

    folder = new_path(spark)
    write_token_files(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"))
    read = read_token_files(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
