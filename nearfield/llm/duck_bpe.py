"""Byte-level BPE by recursive queries of DuckDB, which runs within each task on its own rows.

Encoding: the bytes of every distinct word are rows of (word, position, token). A step joins each
token and its successor with the merge table, takes each word's pair of least rank, the leftmost of
these, and contracts it. A word is finished when no pair of it merges. Words beyond ``LONG`` bytes go
through a second query that contracts all pairs of the least rank at once wherever no merge that
follows could have a lower rank than theirs, so that the number of steps stays bearable. Words beyond
``LONGEST`` bytes, of which that query would need too many steps and rows, are contracted in the same
order with a heap of their pairs.

Decoding: token rows join the vocabulary, and an aggregation ordered by position concatenates their
bytes per document.

Ids equal those of the tiktoken library without special tokens. Null text reads as empty: no ids.
Rows are independent, so nothing is shuffled; memory of DuckDB and of known pieces is bounded.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import documents, pieces, query, texts
from nearfield.llm.token_files import packed_ids
from nearfield.llm.word_ids import PieceMemory

PIECE_BYTES = 2 << 20
BLOCK = 20_000
LONG = 64
LONGEST = 2048
TOKENS = 1 << 20
MEMORY = "256MB"

MERGE_STEPS = """
WITH RECURSIVE step AS (
  SELECT word, pos, tok, lead(tok) OVER w AS nxt, lead(pos) OVER w AS after, false AS done
  FROM words WINDOW w AS (PARTITION BY word ORDER BY pos)
  UNION ALL (
    WITH ranked AS (
      SELECT s.*, (m::BIGINT << 32) | pos AS key
      FROM step s LEFT JOIN merges ON l = tok AND r = nxt WHERE NOT done),
    best AS (SELECT word, min(key) AS best FROM ranked GROUP BY word),
    pair AS (
      SELECT r.word, r.pos AS first, r.after AS second, best >> 32 AS m
      FROM ranked r JOIN best b ON r.word = b.word AND r.key = b.best),
    cut AS (
      SELECT p.*, r.nxt, r.after FROM pair p JOIN ranked r ON r.word = p.word AND r.pos = p.second)
    SELECT r.word, r.pos,
      CASE WHEN r.pos = c.first THEN c.m ELSE r.tok END::INT,
      CASE WHEN r.pos = c.first THEN c.nxt WHEN r.after = c.first THEN c.m ELSE r.nxt END::INT,
      CASE WHEN r.pos = c.first THEN c.after ELSE r.after END,
      c.word IS NULL
    FROM ranked r LEFT JOIN cut c ON r.word = c.word
    WHERE r.pos IS DISTINCT FROM c.second))
SELECT word, tok FROM step WHERE done ORDER BY word, pos
"""

LONG_STEPS = """
WITH RECURSIVE step(word, pos, tok, live, done) USING KEY (word, pos) AS (
  SELECT word, pos, tok, true, false FROM words
  UNION (
    WITH ranked AS (
      SELECT word, pos, tok, after, m, alone, (m::BIGINT << 32) | pos AS key
      FROM (
        SELECT word, pos, tok, lead(tok) OVER w AS nxt, lead(pos) OVER w AS after
        FROM recurring.step WHERE live AND NOT done WINDOW w AS (PARTITION BY word ORDER BY pos))
      LEFT JOIN merges ON l = tok AND r = nxt),
    best AS (SELECT word, min(key) AS best FROM ranked GROUP BY word),
    least AS (
      SELECT r.word, r.pos, r.after, r.m FROM ranked r JOIN best b ON r.word = b.word AND r.m = b.best >> 32
      WHERE NOT r.alone OR r.key = b.best),
    runs AS (
      SELECT *, sum(CASE WHEN ended = pos THEN 0 ELSE 1 END) OVER (PARTITION BY word ORDER BY pos) AS run
      FROM (SELECT *, lag(after) OVER (PARTITION BY word ORDER BY pos) AS ended FROM least)),
    cut AS (
      SELECT word, pos, after, m FROM runs
      QUALIFY row_number() OVER (PARTITION BY word, run ORDER BY pos) % 2 = 1)
    SELECT r.word, r.pos, coalesce(f.m, r.tok), s.word IS NULL, b.best IS NULL
    FROM ranked r JOIN best b ON r.word = b.word
    LEFT JOIN cut f ON f.word = r.word AND f.pos = r.pos
    LEFT JOIN cut s ON s.word = r.word AND s.after = r.pos))
SELECT word, tok FROM step WHERE live ORDER BY word, pos
"""

DECODE = """
SELECT doc, string_agg(shown, '' ORDER BY pos) AS shown FROM ids JOIN vocabulary USING (tok) GROUP BY doc
"""


class DuckBpe:
    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.words_of = regex.compile(pattern).findall
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        # every way to put a token together from two others
        made = [
            (a, b, m)
            for token, m in self.rank.items()
            for k in range(1, len(token))
            if (a := self.rank.get(token[:k])) is not None and (b := self.rank.get(token[k:])) is not None
        ]
        table = self.table = np.array(made, np.int32).reshape(-1, 3)
        pairs = pa.table({"l": table[:, 0], "r": table[:, 1], "m": table[:, 2]})
        # bytes stand as the characters from U+0100 on, as text is what DuckDB aggregates in order
        vocabulary = pa.table({
            "tok": pa.array(self.rank.values(), pa.int32()),
            "shown": ["".join(chr(256 + b) for b in token) for token in self.rank],
        })
        # one thread for one task, and no folder to spill to
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self.db.register("pairs", pairs)
        self.db.register("shown", vocabulary)
        # `alone`: the merged token may at once merge again at a lower rank
        self.db.execute(
            "CREATE TABLE merges AS SELECT l, r, m, m IN "
            "(SELECT l FROM pairs WHERE m < l UNION SELECT r FROM pairs WHERE m < r) AS alone FROM pairs"
        )
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM shown")
        self.db.unregister("pairs")
        self.db.unregister("shown")
        self.memory = PieceMemory(self._encode_pieces)

    def _merged(self, words: list[bytes], steps: str) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the words one after the other, and how many each has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        rows = pa.table({
            "word": np.repeat(np.arange(len(words), dtype=np.int32), size),
            "pos": (np.arange(len(data)) - np.repeat(start, size)).astype(np.int32),
            "tok": self.byte[data],
        })
        self.db.register("words", rows)
        try:
            out = self.db.execute(steps).fetchnumpy()
        finally:
            self.db.unregister("words")
        return out["tok"].astype(np.uint32), np.bincount(out["word"], minlength=len(words))

    @cached_property
    def pairs(self) -> dict[tuple[int, int], int]:
        """What two tokens merge to; few tasks meet a word that asks for it."""
        left, right, merged = self.table.T.tolist()
        return dict(zip(zip(left, right), merged))

    def _heaped(self, word: bytes) -> np.ndarray:
        """Tokens of one long word: always its leftmost pair of least rank is contracted."""
        token = self.byte[np.frombuffer(word, np.uint8)].tolist()
        n = len(token)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        merged = self.pairs
        heap = [(m, i) for i in range(n - 1) if (m := merged.get((token[i], token[i + 1]))) is not None]
        heapify(heap)
        while heap:
            m, i = heappop(heap)
            j = after[i]
            # what stood here may have been contracted since
            if token[i] < 0 or j < 0 or merged.get((token[i], token[j])) != m:
                continue
            token[i], token[j] = m, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (m := merged.get((token[i], token[k]))) is not None:
                    heappush(heap, (m, i))
            k = before[i]
            if k >= 0 and (m := merged.get((token[k], token[i]))) is not None:
                heappush(heap, (m, k))
        out = np.array(token, np.int64)
        return out[out >= 0].astype(np.uint32)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that the pattern has split off, in the order of the words."""
        whole = np.fromiter((self.rank.get(w, -1) for w in words), np.int64, len(words))
        size = np.fromiter(map(len, words), np.int64, len(words))
        count, parts, order = np.ones(len(words), np.int64), [whole[whole >= 0]], [np.flatnonzero(whole >= 0)]
        for steps, block, chosen in (
            (MERGE_STEPS, BLOCK, np.flatnonzero((whole < 0) & (size <= LONG))),
            (LONG_STEPS, 64, np.flatnonzero((whole < 0) & (size > LONG) & (size <= LONGEST))),
        ):
            for k in range(0, len(chosen), block):
                some = chosen[k : k + block]
                ids, n = self._merged([words[i] for i in some.tolist()], steps)
                count[some] = n
                parts.append(ids)
                order.append(some)
        for i in np.flatnonzero((whole < 0) & (size > LONGEST)).tolist():
            ids = self._heaped(words[i])
            count[i] = len(ids)
            parts.append(ids)
            order.append(np.array([i]))
        # the parts come by word; put them in the order of the words
        order, flat = np.concatenate(order), np.concatenate(parts)
        at = np.cumsum(count[order]) - count[order]
        start = np.empty(len(words), np.int64)
        start[order] = at
        ends = np.cumsum(count)
        return flat[np.arange(len(flat)) + np.repeat(start - (ends - count), count)].astype(np.uint32), count

    def _encode_pieces(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known: dict[str, int] = {}
        numbers, parts = [], np.empty(len(new), np.int64)
        for i, piece in enumerate(new):
            found = self.words_of(piece)
            parts[i] = len(found)
            numbers.extend([known.setdefault(w, len(known)) for w in found])
        flat, count = self.encode_words([w.encode() for w in known])
        at = np.array(numbers, np.int64)
        start = np.cumsum(count) - count
        n = count[at]
        ends = np.cumsum(n)
        ids = flat[np.arange(int(n.sum())) + np.repeat(start[at] - (ends - n), n)]
        total = np.concatenate([[0], ends])
        return ids, np.diff(total[np.concatenate([[0], np.cumsum(parts)])])

    def encode(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and where each document's end."""
        return self.memory(docs)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each document, a bounded number of tokens at a time."""
        size = np.diff(ends, prepend=0)
        doc = np.repeat(np.arange(len(ends), dtype=np.int32), size)
        parts: list[list[bytes]] = [[] for _ in range(len(ends))]
        for s in range(0, len(ids), TOKENS):
            some = slice(s, s + TOKENS)
            n = len(ids[some])
            rows = {"doc": doc[some], "pos": np.arange(n, dtype=np.int32), "tok": ids[some].astype(np.int32)}
            self.db.register("ids", pa.table(rows))
            try:
                for i, shown in self.db.execute(DECODE).fetchall():
                    parts[i].append(np.frombuffer(shown.encode("utf-16-le"), "<u2").astype(np.uint8).tobytes())
            finally:
                self.db.unregister("ids")
        return [b"".join(x) for x in parts]


_OPEN: dict[tuple[str, str], DuckBpe] = {}


def duck_bpe(path: str, pattern: str) -> DuckBpe:
    """The encoder of a file, opened once per process."""
    if (path, pattern) not in _OPEN:
        _OPEN[path, pattern] = DuckBpe(path, pattern)
    return _OPEN[path, pattern]


def encode_decode(docs: DataFrame, path: str, pattern: str, doc_id="doc_id", text="text") -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit) and ``decoded`` bytes."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = rows.select("doc_id").schema
    schema = schema.add("n_tokens", "long").add("ids", "binary").add("decoded", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = duck_bpe(path, pattern)
        for batch in pieces(batches, "text", PIECE_BYTES):
            ids, ends = bpe.encode(texts(batch, "text"))
            out = [
                batch.column("doc_id"),
                pa.array(np.diff(ends, prepend=0)),
                packed_ids(ids, ends),
                pa.array(bpe.decode(ids, ends), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_tokens", "ids", "decoded"])

    return rows.mapInArrow(run, schema)


@query()
def op7_byte_bpe(spark, sf_dir):
    import public_tokenizers as vocabularies

    path = vocabularies.path("byte_bpe_50k.tiktoken")
    coded = encode_decode(documents(spark, sf_dir), path, vocabularies.PATTERN)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
