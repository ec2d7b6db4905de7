"""Packing: documents become sequences of bounded length, in order, with chosen cuts.

The ids of consecutive documents form one stream. A sequence ends at the end of a document or of a
sentence, and only inside a sentence that is itself too long where there is no other way. Dynamic
programming picks the cuts: the cost of a sequence is its padding, a price for each sequence, and a
penalty for the kind of its last cut. The best start for an end is the least value in a window that
moves along with it, which a monotone queue yields in constant time. A sequence whose length is a
power of two needs no padding; such starts are tried too.

Each task packs the documents it scans, in that order, and keeps no more than a block of them; the
last sequences of a block are packed again with the next. Nothing is shuffled. Numbers of sequences
are unique across tasks, not dense. Null text reads as empty: a document of the end id alone.
Repeated rows are packed each for itself.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import documents, pieces, query, texts
from nearfield.llm.token_files import END_ID, packed_ids
from nearfield.llm.word_ids import with_end, word_ids

LENGTH = 2048
PIECE_BYTES = 4 << 20
#: Costs in tokens of padding.
PER_SEQUENCE, IN_DOCUMENT, IN_SENTENCE = 32, 24, 256
LEAST_POWER = 512


def padding(size: int, length: int = LENGTH) -> int:
    return 0 if size & (size - 1) == 0 else length - size


def choose_cuts(ends: np.ndarray, penalty: np.ndarray, length: int = LENGTH) -> list[int]:
    """Indexes of the ends at which sequences end; the last end is always one.

    ``ends`` ascend, with gaps of ``length`` at most, and the stream starts at 0.
    """
    at = np.concatenate([[0], ends])
    n = len(at)
    # starts that make the length a power of two, beside the best of the window
    exact: dict[int, list[int]] = {}
    power = LEAST_POWER
    while power < length:
        i = np.searchsorted(at, at - power)
        for j in np.flatnonzero(at[np.minimum(i, n - 1)] == at - power).tolist():
            exact.setdefault(j, []).append(int(i[j]))
        power *= 2
    place, price = at.tolist(), [0, *penalty.tolist()]
    best, come = [0] * n, [0] * n
    queue = deque([(0, 0)])  # (cost so far plus place, index), both ascending
    for j in range(1, n):
        p = place[j]
        while place[queue[0][1]] < p - length:
            queue.popleft()
        value, i = queue[0]
        cost = value + length - p
        if j in exact:
            for k in exact[j]:
                if best[k] < cost:
                    cost, i = best[k], k
        cost += price[j] + PER_SEQUENCE
        best[j], come[j] = cost, i
        value = cost + p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    out, j = [], n - 1
    while j:
        out.append(j - 1)
        j = come[j]
    return out[::-1]


def candidates(ids: np.ndarray, doc_ends: np.ndarray, closes: np.ndarray, length: int = LENGTH):
    """Places where a sequence may end, with the penalty of each."""
    closing = closes[ids]
    closing[:-1] &= ~closing[1:]  # a run of closing ids ends with its last
    penalty_at = np.where(closing, IN_DOCUMENT, -1)
    penalty_at[doc_ends - 1] = 0
    places = np.flatnonzero(penalty_at >= 0) + 1
    gaps = np.diff(places, prepend=0)
    for k in np.flatnonzero(gaps > length).tolist():
        penalty_at[np.arange(places[k] - gaps[k] + length, places[k], length) - 1] = IN_SENTENCE
    places = np.flatnonzero(penalty_at >= 0) + 1
    return places, penalty_at[places - 1]


def _tail(size: int, length: int) -> list[int]:
    """Lengths of the last sequences: one, or powers of two where that costs less."""
    parts = [1 << b for b in range(size.bit_length() - 1, -1, -1) if size >> b & 1]
    cost = (len(parts) - 1) * (IN_SENTENCE + PER_SEQUENCE)
    return parts if cost < padding(size, length) else [size]


class Packer:
    """Takes documents in order and returns the pieces of finished sequences."""

    def __init__(self, closes: np.ndarray, length: int = LENGTH):
        self.closes, self.length, self.sequence = closes, length, 0
        self.ids = np.empty(0, np.uint32)
        # open documents: index in the caller's keys, ids already packed, end in the stream
        self.key, self.done, self.ends = (np.empty(0, np.int64) for _ in range(3))

    def add(self, keys: np.ndarray, ids: np.ndarray, ends: np.ndarray, last: bool = False):
        """``(key, start, length, sequence, offset)`` of pieces, and their ids and ends."""
        self.ends = np.concatenate([self.ends, len(self.ids) + ends])
        self.ids = np.concatenate([self.ids, ids])
        self.key = np.concatenate([self.key, keys])
        self.done = np.concatenate([self.done, np.zeros(len(keys), np.int64)])
        if not len(self.ids):
            return None
        places, penalty = candidates(self.ids, self.ends, self.closes, self.length)
        cuts = places[choose_cuts(places, penalty, self.length)]
        if last:
            start = int(cuts[-2]) if len(cuts) > 1 else 0
            cuts = np.concatenate([cuts[:-1], start + np.cumsum(_tail(int(cuts[-1]) - start, self.length))])
        else:
            cuts = cuts[:-2]  # the next documents may change the last ones
        if not len(cuts):
            return None
        return self._emit(cuts)

    def _emit(self, cuts: np.ndarray):
        stop = int(cuts[-1])
        doc_starts = np.concatenate([[0], self.ends[:-1]])
        ends = np.zeros(stop, bool)
        ends[cuts - 1] = True
        ends[self.ends[self.ends <= stop] - 1] = True
        borders = np.flatnonzero(ends) + 1
        starts = np.concatenate([[0], borders[:-1]])
        doc = np.searchsorted(self.ends, starts, "right")
        window = np.searchsorted(cuts, starts, "right")
        window_start = np.concatenate([[0], cuts[:-1]])[window]
        pieces_ = (
            self.key[doc],
            self.done[doc] + starts - doc_starts[doc],
            borders - starts,
            self.sequence + window,
            starts - window_start,
        )
        out = pieces_, self.ids[:stop], borders
        self.sequence += len(cuts)
        left = self.ends > stop
        packed = np.maximum(stop - doc_starts[left], 0)
        self.done = self.done[left] + packed
        self.key, self.ends, self.ids = self.key[left], self.ends[left] - stop, self.ids[stop:]
        return out


_CLOSES: dict[str, np.ndarray] = {}


def closing_ids(path: str) -> np.ndarray:
    """By id: whether a sentence or line may end with it."""
    if path not in _CLOSES:
        tokenizer = word_ids(path).tokenizer
        size = max(tokenizer.get_vocab().values()) + 1
        shown = tokenizer.decode_batch([[i] for i in range(size)], skip_special_tokens=False)
        closes = np.array([x.rstrip(" \"')]}").endswith((".", "!", "?", "。", "\n")) for x in shown])
        _CLOSES[path] = closes
    return _CLOSES[path]


PIECES = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, tokenizer: str, length=LENGTH, end=END_ID, doc_id="doc_id", text="text") -> DataFrame:
    """Pieces of documents in sequences: ``doc_id`` and the columns of ``PIECES``."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = rows.select("doc_id").schema
    for name, kind in (x.split() for x in PIECES.split(", ")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = word_ids(tokenizer), Packer(closing_ids(tokenizer), length)
        task = TaskContext.get().partitionId() << 40
        keys, sizes, base = None, np.empty(0, np.int64), 0

        def rows_of(found):
            (key, start, size, sequence, offset), ids, ends = found
            values = (start, size, sizes[key - base], task + sequence, offset)
            columns = [keys.take(pa.array(key - base)), *map(pa.array, values), packed_ids(ids, ends)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in pieces(batches, "text", PIECE_BYTES):
            ids, ends = with_end(*encode(texts(batch, "text")), end)
            new = batch.column("doc_id")
            # only keys of documents that are still open are kept
            open_ = int(packer.key[0]) if len(packer.key) else base + len(sizes)
            keys = new if keys is None else pa.concat_arrays([keys.slice(open_ - base), new])
            sizes = np.concatenate([sizes[open_ - base :], np.diff(ends, prepend=0)])
            base = open_
            number = base + len(sizes) - len(ends) + np.arange(len(ends))
            if (found := packer.add(number, ids, ends)) is not None:
                yield rows_of(found)
        none = np.empty(0, np.int64)
        if keys is not None and (found := packer.add(none, none.astype(np.uint32), none, last=True)) is not None:
            yield rows_of(found)

    return rows.mapInArrow(run, schema)


@query()
def op9_packing(spark, sf_dir):
    import public_tokenizers

    packed = pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
