"""Periodic run detection over a dictionary of basic factors.

The dictionary names, per power of two ``l``, the factors of ``l`` words: equal factors of a text have
equal names, and a name of ``2 l`` words is a pair of names of ``l``. Only factors that come back in
their text are held, as any other is unequal to all; so a text without repeats costs little more than
naming its words. Where a factor's next two occurrences follow at one distance, an arithmetic
progression of at most ``2 l``, that distance is proposed as period. Names of falling length extend
each proposal to both sides, and runs found more than once are dropped.

Every run with smallest period ``q`` and at least ``max(least, times * q)`` words (``times`` >= 4) is
found: at the first ``l >= q`` each factor of its first ``q + 2`` words comes next at ``q``, at
least twice, and never nearer.

Words are ``[^\\x20\\x09-\\x0D]+``, compared byte by byte. Null or empty text has no words and no run.
Rows are independent, repeated ones alike; nothing is shuffled, and columns other than id and text
aren't read. A task holds about 100 bytes per word of one block of texts, or of one text that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from nearfield.llm.common import documents, pieces, query, words

LEAST = 6
TIMES = 4
BLOCK_BYTES = 2 << 20
RUN = "struct<start:long,length:long,period:long>"


def repeated(place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places, ascending within a name, and names of the keys that occur more than once."""
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = sorted_key[1:] == sorted_key[:-1]
    again = same[1:] | same[:-1]
    return place[order][again], np.cumsum(~same[:-1])[again]


def proposals(place: np.ndarray, name: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a factor comes back twice at one distance, and that distance.

    Distances of up to ``size // 2`` are left to shorter factors; of neighbouring places with one
    distance the first stands for all.
    """
    step = np.diff(place)
    step[name[1:] != name[:-1]] = 0
    found = np.flatnonzero((step[:-1] == step[1:]) & (2 * step[:-1] > size) & (step[:-1] <= 2 * size))
    at, period = place[found], step[found]
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    head = np.ones(len(at), bool)
    head[1:] = (period[1:] != period[:-1]) | (at[1:] != at[:-1] + 1)
    return at[head], period[head]


class Factors:
    """The dictionary of a block of texts, with the proposals of all lengths.

    ``key`` numbers words so that no two texts share a number: then no factor that reaches from one
    text into the next comes back.
    """

    def __init__(self, key: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        at, periods, size = [], [], 1
        place, name = repeated(np.arange(len(key)), key)
        while len(place):
            for out, x in zip((at, periods), proposals(place, name, size)):
                out.append(x)
            order = np.argsort(place)
            place, name = place[order], name[order]
            self.levels.append((place, name))
            second = np.minimum(np.searchsorted(place, place + size), len(place) - 1)
            whole = np.flatnonzero(place[second] == place + size)
            pair = name[whole] * (int(name.max()) + 1) + name[second[whole]]
            place, name = repeated(place[whole], pair)
            size *= 2
        self.at = np.concatenate(at) if at else np.zeros(0, np.int64)
        self.period = np.concatenate(periods) if periods else np.zeros(0, np.int64)

    def _names(self, level: int, at: np.ndarray) -> np.ndarray:
        place, name = self.levels[level]
        found = np.minimum(np.searchsorted(place, at), len(place) - 1)
        return np.where(place[found] == at, name[found], -1)

    def alike(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many words agree from places ``a`` and ``b`` on, or in front of them."""
        n = np.zeros(len(a), np.int64)
        for level in reversed(range(len(self.levels))):
            by = n if forward else -(n + (1 << level))
            one = self._names(level, a + by)
            equal = (one >= 0) & (one == self._names(level, b + by))
            n += equal.astype(np.int64) << level
        return n

    def runs(self, least: int, times: int) -> np.ndarray:
        """``start, length, period`` of each run, by start, then period."""
        before = self.alike(self.at, self.at + self.period, False)
        after = self.alike(self.at, self.at + self.period, True)
        start, length = self.at - before, before + self.period + after
        found = np.stack([start, self.period, length], axis=1)
        found = found[length >= np.maximum(least, times * self.period)]
        return np.unique(found, axis=0)[:, [0, 2, 1]]


def split(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    row = np.repeat(np.arange(len(text)), pc.list_value_length(lists).to_numpy())
    flat = lists.flatten()
    real = pc.not_equal(flat, "")
    return flat.filter(real), np.bincount(row[real.to_numpy(zero_copy_only=False)], minlength=len(text))


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """Per row: ``doc_id, n_words, runs`` by start, then period, and the text ``collapsed``.

    Words of a run beyond its first period are dropped from the collapsed text, whose words are
    joined by one space.
    """
    if times < 4:
        raise ValueError("times must be at least 4")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = rows.select("doc_id").schema
    schema = schema.add("n_words", "long").add("runs", DataType.fromDDL(f"array<{RUN}>")).add("collapsed", "string")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BLOCK_BYTES):
            flat, size = split(batch.column("text"))
            ends = np.cumsum(size)
            coded = flat.dictionary_encode()
            row = np.repeat(np.arange(len(size)), size)
            key = row * len(coded.dictionary) + coded.indices.to_numpy()
            start, length, period = Factors(key).runs(least, times).T
            depth = np.zeros(len(key) + 1, np.int64)
            np.add.at(depth, start + period, 1)
            np.add.at(depth, start + length, -1)
            kept = np.cumsum(depth[:-1]) == 0
            own = row[start]
            found = pa.StructArray.from_arrays(
                [pa.array(start - (ends - size)[own]), pa.array(length), pa.array(period)],
                names=["start", "length", "period"],
            )
            left = pa.ListArray.from_arrays(_offsets(row[kept], len(size)), flat.filter(pa.array(kept)))
            columns = [
                batch.column("doc_id"),
                pa.array(size.astype(np.int64)),
                pa.ListArray.from_arrays(_offsets(own, len(size)), found),
                pc.binary_join(left, " "),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(search, schema)


def _offsets(row: np.ndarray, rows: int) -> pa.Array:
    return pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))


def looped(docs: DataFrame) -> DataFrame:
    """One document in ten, chosen by the crc32 of its id, with words from a place on made periodic."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    df = docs.select("doc_id", "text", F.when(h % 10 == 0, words(F.col("text"))).alias("w"), g.alias("g"))
    df = df.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.expr("int(g % n)")))
    df = df.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    tail = "slice(flatten(array_repeat(slice(w, a + 1, p), int(ceil((n - a) / p)))), 1, n - a)"
    again = F.expr(f"array_join(concat(slice(w, 1, a), {tail}), ' ')")
    return df.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


@query()
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs(looped(documents(spark, sf_dir)))
    # runs come by start, then period, so a later one has to be better
    best = F.reduce(
        "runs",
        F.lit(None).cast(RUN),
        lambda b, r: F.when(b.isNotNull() & (r["length"] * b["period"] <= b["length"] * r["period"]), b).otherwise(r),
    )
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
