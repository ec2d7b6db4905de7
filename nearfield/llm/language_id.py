"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of order 0 to 3 holds how often each symbol followed. The
probability of a symbol comes from the longest context; one that was never seen there costs an escape
and is sought in the next shorter one, without the symbols that were ruled out (method C with
exclusions, down to equal chances). After training the statistics are frozen, so the code length of a
symbol depends on the three before it alone. The trees are kept sparsely: code lengths of the triples
and quadruples that some language has seen, with the cost of leaving a context, and whole tables for
pairs. The order and the alphabet are the same for any number of languages. A text belongs to the
language that codes the whole of it in the fewest bits.

Symbols are all 256 bytes, ASCII letters folded, digits and white space as one each. Training takes
documents up to an expected ``TRAIN_BYTES`` per language, chosen by a hash of their id, from a long one
a stretch of a quarter of that; with many languages less of each, so that the table has at most some
``MOST_CELLS`` numbers. The sample and the table are thus bounded and may be sent to all tasks.

Text that is null or has no letter is ``und`` with score 0. Without a document to learn from, all is
``und``. The score is the probability of the language, given as much evidence as ``EVIDENCE`` bytes.
Ties go to the first language in alphabetical order. A long text is scored in blocks, so that beside
the text itself a task needs the same memory for any length. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import documents, pieces, query, unused

UNKNOWN = "und"
TRAIN_BYTES = 1 << 20
MOST_CELLS = 1 << 28
ORDER = 3
PIECE_BYTES = 1 << 20
BLOCK_CELLS = 1 << 22
EVIDENCE = 64


def _folded() -> np.ndarray:
    """Byte by byte: small ASCII letters, one digit, one white space."""
    fold = np.arange(256, dtype=np.uint8)
    fold[ord("A") : ord("Z") + 1] += 32
    fold[ord("0") : ord("9") + 1] = ord("0")
    fold[[9, 10, 11, 12, 13]] = 32
    return fold


FOLD = _folded()
#: The symbol of each byte, without gaps.
SYMBOL = np.unique(FOLD, return_inverse=True)[1].astype(np.uint8)
N_SYMBOLS = int(SYMBOL.max()) + 1
BLANK = int(SYMBOL[32])


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Bits of each symbol after each context of the full order, from counts of that shape."""
    levels = [counts]
    while levels[-1].ndim > 1:
        levels.append(levels[-1].sum(axis=0))
    p = np.full(counts.shape[-1], 1 / counts.shape[-1])
    for c in reversed(levels):
        n, seen = c.sum(axis=-1, keepdims=True), c > 0
        kinds = seen.sum(axis=-1, keepdims=True)
        lower = np.broadcast_to(p, c.shape)
        left = (lower * ~seen).sum(axis=-1, keepdims=True)
        escape = np.where(left > 0, kinds / np.maximum(n + kinds, 1), 0.0)
        known = c / np.maximum(n + np.where(left > 0, kinds, 0), 1)
        p = np.where(n == 0, lower, np.where(seen, known, escape * lower / np.where(left > 0, left, 1)))
    return -np.log2(p)


def _leaving(keys: np.ndarray, counts: np.ndarray, lower: np.ndarray):
    """Bits of the symbols seen after each context, the contexts, and what an escape from each costs.

    ``keys`` are sorted, a context and its symbol in the last byte; ``lower`` has the bits of these
    symbols in the next shorter context.
    """
    first = np.flatnonzero(np.append(True, keys[1:] >> 8 != keys[:-1] >> 8))
    kinds = np.diff(np.append(first, len(keys)))
    left = np.maximum(1 - np.add.reduceat(np.exp2(-lower), first), np.finfo(float).tiny)
    some = kinds < N_SYMBOLS
    total = np.add.reduceat(counts, first) + np.where(some, kinds, 0)
    bits = np.repeat(np.log2(total), kinds) - np.log2(counts)
    return bits, keys[first] >> 8, np.where(some, np.log2(total) - np.log2(kinds) + np.log2(left), 0.0)


class Rows:
    """Sorted distinct keys, found by hashing; the row of a key is its rank, -1 if it is not there."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint32(32 - max(1, int(2 * len(keys)).bit_length()))
        self.slots = np.full(1 << (32 - int(self.shift)), -1, np.int32)
        rows, at = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(rows):
            free = self.slots[at] < 0
            self.slots[at[free]] = rows[free]
            out = self.slots[at] != rows
            rows, at = rows[out], (at[out] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found = self.slots[at]
        other = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(other):
            at[other] = (at[other] + 1) & (len(self.slots) - 1)
            row = found[other] = self.slots[at[other]]
            other = other[(row >= 0) & (self.keys[row] != keys[other])]
        return found


@dataclass
class Model:
    """Languages and their code lengths, a column each.

    ``pairs`` and ``leaves`` go by two symbols: bits of the second after the first, and what it costs to
    leave both as a context. ``triples`` and ``quads`` hold what some language has seen.
    """

    languages: list[str]
    limits: np.ndarray
    pairs: np.ndarray
    leaves: np.ndarray
    triples: Rows
    triple_bits: np.ndarray
    triple_leaves: np.ndarray
    quads: Rows
    quad_bits: np.ndarray
    symbol: np.ndarray = field(default_factory=lambda: SYMBOL)
    n_symbols: int = N_SYMBOLS
    order: int = ORDER

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of the last symbol of each quadruple, by language."""
        row = self.quads.find(grams)
        out = self.quad_bits[row]
        new = np.flatnonzero(row < 0)
        if len(new):
            grams = grams[new]
            triple, context = self.triples.find(grams & 0xFFFFFF), self.triples.find(grams >> 8)
            below = self.leaves[(grams >> 8) & 0xFFFF] + self.pairs[grams & 0xFFFF]
            below = np.where((triple >= 0)[:, None], self.triple_bits[triple], below)
            out[new] = below + np.where((context >= 0)[:, None], self.triple_leaves[context], 0)
        return out

    def total_bits(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Code length of each text, by language; texts must not be empty."""
        out = np.zeros((len(starts), len(self.languages)))
        step = max(1, BLOCK_CELLS // len(self.languages))
        for lo in range(0, len(data), step):
            hi, begin = min(len(data), lo + step), max(0, lo - ORDER)
            a, b, c = np.searchsorted(starts, [begin, lo + 1, hi])
            bits = self.bits(_grams(data[begin:hi], starts[a:c] - begin)[lo - begin :])
            # the text that the block begins in, and those that begin in it
            out[b - 1 : c] += np.add.reduceat(bits, np.append(lo, starts[b:c]) - lo, axis=0, dtype=np.float64)
        return out


def _grams(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """At each place the symbol and the three before it as one number; texts begin after blanks."""
    symbols = SYMBOL[data]
    out = symbols.astype(np.uint32)
    for back in range(1, ORDER + 1):
        before = np.full(len(symbols), BLANK, np.uint32)
        before[back:] = symbols[:-back]
        for k in range(back):  # a text must not see the one before it
            at = starts + k
            before[at[at < len(symbols)]] = BLANK
        out |= before << np.uint32(8 * back)
    return out


def _union(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, np.uint32), *parts]))


def train(rows: list[tuple[str, bytes]]) -> Model:
    """A model of ``(language, UTF-8 text)`` rows."""
    by: dict[str, list[bytes]] = {}
    for language, text in rows:
        if text:
            by.setdefault(language, []).append(text)
    languages = sorted(by)
    n = len(languages)
    pairs, leaves, limits = np.zeros((1 << 16, n)), np.zeros((1 << 16, n)), np.zeros(n)
    trees = []
    for j, k in enumerate(languages):
        size = np.array([len(x) for x in by[k]])
        grams = _grams(np.frombuffer(b"".join(by[k]), np.uint8), np.cumsum(size) - size)
        four, times = np.unique(grams, return_counts=True)
        two = np.bincount(four & 0xFFFF, times, 1 << 16).reshape(256, 256)
        bits = np.zeros((256, 256))
        bits[:N_SYMBOLS, :N_SYMBOLS] = code_lengths(two[:N_SYMBOLS, :N_SYMBOLS])
        pairs[:, j] = bits.ravel()
        limits[j] = np.log2(max(2, (two.sum(axis=0) > 0).sum()))
        three, at = np.unique(four & 0xFFFFFF, return_inverse=True)
        of_three, context, cost = _leaving(three, np.bincount(at, times), pairs[three & 0xFFFF, j])
        leaves[context, j] = cost
        of_four, context, cost = _leaving(four, times, of_three[at])
        trees.append((three, of_three, context, cost, four, of_four))
    triples = _union([x for t in trees for x in (t[0], t[2])])
    triple_bits = leaves[triples >> 8] + pairs[triples & 0xFFFF]
    triple_leaves = np.zeros(triple_bits.shape)
    for j, (three, bits, context, cost, _, _) in enumerate(trees):
        triple_bits[np.searchsorted(triples, three), j] = bits
        triple_leaves[np.searchsorted(triples, context), j] = cost
    quads = _union([t[4] for t in trees])
    quad_bits = triple_leaves[np.searchsorted(triples, quads >> 8)]
    quad_bits += triple_bits[np.searchsorted(triples, quads & 0xFFFFFF)]
    for j, (*_, four, bits) in enumerate(trees):
        quad_bits[np.searchsorted(quads, four), j] = bits
    tables = [x.astype(np.float32) for x in (pairs, leaves, triple_bits, triple_leaves, quad_bits)]
    return Model(languages, limits, *tables[:2], Rows(triples), *tables[2:4], Rows(quads), tables[4])


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from; a null id is neither held out nor learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, doc_id="doc_id", text="text", lang="lang", most=TRAIN_BYTES) -> Model:
    """Learns from a bounded sample of the labelled documents that are not held out."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")
    )
    rows = rows.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    part = F.substring("text", 1 + F.pmod(F.xxhash64("text"), F.length("text")).cast("int"), F.lit(most // 4))
    rows = rows.withColumn("text", F.when(F.octet_length("text") <= most // 4, F.col("text")).otherwise(part))
    found = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    each = min(most, MOST_CELLS // max(1, len(found)) ** 2)
    if not found:
        return train([])
    wanted = F.create_map(*(F.lit(x) for r in found for x in (r["lang"], each / max(1, r["n"]))))[F.col("lang")]
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    # a language of a few documents gets them all
    few = [x["lang"] for x in found if x["n"] <= 4 * each]
    chosen = rows.filter((chance < wanted) | F.col("lang").isin(few))
    return train([(x["lang"], x["text"].encode()) for x in chosen.select("lang", "text").collect()])


def judge(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and bits per symbol of each text."""
    whole = [x or "" for x in texts.to_pylist()]
    letters = np.fromiter((any(map(str.isalpha, x)) for x in whole), bool, len(whole))
    names, score, rate = [UNKNOWN] * len(whole), np.zeros(len(whole)), np.zeros(len(whole))
    real = np.flatnonzero(letters)
    if not len(real) or not model.languages:
        return names, score, rate
    raw = [whole[i].encode() for i in real.tolist()]
    size = np.array([len(x) for x in raw])
    bits = model.total_bits(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size)
    best = bits.argmin(axis=1)
    more = (bits - bits.min(axis=1, keepdims=True)) / size[:, None] * np.minimum(size, EVIDENCE)[:, None]
    score[real] = 1 / np.exp2(-more).sum(axis=1)
    rate[real] = bits.min(axis=1) / size
    for i, k in zip(real.tolist(), best.tolist(), strict=True):
        names[i] = model.languages[k]
    return names, score, rate


def predict(rows: DataFrame, model: Model, text="text", drop_text=False) -> tuple[DataFrame, list[str]]:
    """The rows with language, score and bits per symbol; the names of these columns."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    new = unused(rows, "lang_pred", "score", "bits_per_symbol")
    kept = [i for i, c in enumerate(rows.columns) if not (drop_text and c == text)]
    at = rows.columns.index(text)
    schema = rows.select(*(F.col(f"`{rows.columns[i]}`") for i in kept)).schema
    for name, kind in zip(new, ("string", "double", "double"), strict=True):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, at, PIECE_BYTES):
            names, score, rate = judge(shared.value, batch.column(at))
            columns = [batch.column(i) for i in kept] + [pa.array(names, pa.string()), pa.array(score), pa.array(rate)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema), new


def language_filter(docs: DataFrame, model: Model, text="text") -> DataFrame:
    """The documents in a known language, with the columns they came with.

    Rejected are ``und`` and texts that no language codes better than equal chances of all the symbols
    that it was learned from would.
    """
    df, (lang, _, rate) = predict(docs, model, text)
    if not model.languages:
        return docs.filter(F.lit(False))
    limits = zip(model.languages, model.limits.tolist(), strict=True)
    most = F.create_map(*(F.lit(x) for kv in limits for x in kv))[F.col(lang)]
    return df.filter((F.col(lang) != UNKNOWN) & (F.col(rate) < most)).drop(*df.columns[len(docs.columns) :])


@query()
def op8_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    df, _ = predict(rows, fit(docs), drop_text=True)
    return df
