"""N-gram Jaccard join by signature trees, exact, with one row per document.

The set of a text holds its distinct shingles of ``words`` words, as 64-bit hashes. Two documents link
when their sets share ``share`` of the union, a fraction of whole numbers; the defaults are the query's. Texts with equal sets
form a class. Two classes whose sets link share one of their smallest hashes, so classes meet in
blocks by such a hash; of these, each class leaves out those that most classes have, as many as can
be spared without a loss (see ``spare``).

Links that are likely are verified first: those of a block's classes with the one that shares most
with others, which joins groups of near copies at little cost. Then the blocks that still hold
different components are searched in full. A block becomes a signature tree: nodes hold the OR and
AND of the bitmaps below them and the range of sizes. Two trees, or one with itself, are traversed
together, and a pair of nodes is left as soon as the largest possible overlap is too small, or all
below it is joined already. What the search joins is a family; every link lies within one. It emits
no more pairs than join a family, and whole sets then decide inside the families. Large blocks and
families are cut into tiles that meet in separate tasks.

Nothing but a bitmap of fixed size and counters reaches the driver. Null or empty text, or text
without words, has no shingles and links to nothing. Null ids are ignored as names of components.
Repeated rows are documents of their own, and linked. Hashes of 64 bits stand for shingles and sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.llm.common import documents, pieces, query, stored, unused

WORDS = 4
#: Links have an overlap of this share of the union: 85 hundredths are 17 / 37 of the sum of sizes.
SHARE = (85, 100)
SPARED = (6, 100)
BITS = 512
LEAF, FAN = 32, 8
TILE, FAMILY_TILE = 4096, 512
COLUMNS = 4096
MEMBERS = 4096
SLOTS = 1 << 23
PIECE_BYTES = 2 << 20

# --------------------------------------------------------------------- sizes


def least_overlap(n, share=SHARE):
    """Overlap that a set of ``n`` needs with any set it links to."""
    return -(-n * share[0] // share[1])


def prefix(n, share=SHARE):
    return n - least_overlap(n, share) + 1


def spared(n):
    return n * SPARED[0] // SPARED[1]


def spare(n, share=SHARE):
    """How many hashes of a prefix that is longer by ``spared(n)`` may be left out.

    Linked sets share ``1 + min(spared)`` hashes of their longer prefixes. In one order for all, each
    set may leave out its last ``min(spared)``: the first shared hash stays. As a partner has at
    least ``share`` of ``n`` elements, its ``spared`` is known to be no less than this.
    """
    return spared(least_overlap(n, share))


def links(overlap, a, b, share=SHARE):
    """Whether sets of these sizes link."""
    return (share[0] + share[1]) * overlap >= share[0] * (a + b)


# ---------------------------------------------------------------------- sets

_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[ord("A") : ord("Z") + 1] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_PLACE = _mixed(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def shingle_sets(raw: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each UTF-8 text."""
    step = _mixed(np.arange(11, 11 + words, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    data = _LOW[np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    text_at = 1 + np.cumsum(size + 1) - (size + 1)
    inside = ~_GAP[data]
    start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    stop = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    if not len(start):
        return [np.empty(0, np.uint64)] * len(raw)
    place = np.arange(len(data)) - np.repeat(np.append(0, start), np.diff(np.append(np.append(0, start), len(data))))
    turn = (place >> 12).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    value = np.where(inside, _BYTE[data] * (_PLACE[place & 4095] + (turn << np.uint64(1))), np.uint64(0))
    word = _mixed(np.add.reduceat(value, start) + (stop - start).astype(np.uint64))
    first = np.searchsorted(start, text_at)
    last = np.append(first[1:], len(start))
    count = last - first
    # every run of words; runs over a border of texts are not used
    run = np.zeros(len(word), np.uint64)
    for k in range(min(words, len(word))):
        run[: len(word) - k] += word[k:] * step[k]
    run = _mixed(run)
    out = []
    for a, n in zip(first.tolist(), count.tolist(), strict=True):
        if n >= words:
            found = np.sort(run[a : a + n - words + 1])
            out.append(found[np.append(True, found[1:] != found[:-1])])
        elif n:
            whole = (word[a : a + n] * step[:n]).sum(dtype=np.uint64) ^ np.uint64(n)
            out.append(_mixed(np.array([whole], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def class_of(s: np.ndarray) -> int:
    """A hash of a set as a signed 64-bit integer."""
    total = _mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(s))
    return int(_mixed(np.array([total], np.uint64)).view(np.int64)[0])


def signature(s: np.ndarray) -> bytes:
    bits = np.zeros(BITS, bool)
    bits[(s >> np.uint64(20)).astype(np.int64) % BITS] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _raw(batch: pa.RecordBatch) -> list[bytes]:
    return [(x or "").encode() for x in batch.column("text").to_pylist()]


def classes(docs: DataFrame, doc_id="doc_id", text="text", words=WORDS, share=SHARE) -> DataFrame:
    """Per row: ``doc_id, n, cls``, the hashes that lead to its blocks, its signature."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = rows.select("doc_id").schema.add("n", "long").add("cls", "long")
    schema = schema.add("keys", T.ArrayType(T.LongType())).add("sig", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE_BYTES):
            sets = shingle_sets(_raw(batch), words)
            keys = [s[: prefix(len(s), share) + spared(len(s))] for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            columns = [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([class_of(s) for s in sets], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys).view(np.int64))),
                pa.array([signature(s) for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


# -------------------------------------------------------------- verification


def sets_of(wanted: DataFrame, docs: DataFrame, table: DataFrame, doc_id="doc_id", text="text", words=WORDS) -> DataFrame:
    """``cls, shingles`` for the classes of ``wanted(cls)``.

    One text of each class is read again and becomes a set. Texts are found through a bitmap of
    ``SLOTS`` hashed ids, which lets some others pass but none be missed.
    """
    spark = wanted.sparkSession
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int")
    chosen = table.groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    slots = chosen.join(wanted, "cls", "left_semi").select(slot.alias("slot")).distinct().toArrow()
    bitmap = np.zeros(SLOTS, bool)
    bitmap[slots.column("slot").to_numpy()] = True
    shared = spark.sparkContext.broadcast(np.packbits(bitmap))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).astype(bool)
        for batch in pieces(batches, "text", PIECE_BYTES):
            some = batch.filter(pa.array(bits[batch.column("slot").to_numpy()]))
            sets = [s for s in shingle_sets(_raw(some), words) if len(s)] if some.num_rows else []
            columns = [pa.array([class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["cls", "shingles"])

    sets = rows.select("text", slot.alias("slot")).mapInArrow(read, "cls long, shingles binary")
    return sets.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.first("shingles").alias("shingles"))


def verified(
    pairs: DataFrame, docs: DataFrame, table: DataFrame, doc_id="doc_id", text="text", words=WORDS, share=SHARE
) -> DataFrame:
    """Those pairs of classes ``(a, b)`` whose sets link.

    The sets of all ``b`` of one ``a`` stream past its own; beyond ``MEMBERS`` of them they are
    dealt out to several tasks.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = sets_of(wanted, docs, table, doc_id, text, words)
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    heads = parts.join(sets, F.col("a") == F.col("cls")).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "shingles"
    )
    members = (
        pairs.join(parts, "a")
        .select("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), "b")
        .join(sets, F.col("b") == F.col("cls"))
        .select("a", "part", "b", "shingles")
    )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = None, None
        for batch in batches:
            out = []
            for a, b, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "shingles")), strict=True):
                s = np.frombuffer(raw, np.uint64)
                if b is None:
                    own, at = s, a
                elif at == a:
                    k = np.searchsorted(own, s)
                    overlap = int((own[np.minimum(k, len(own) - 1)] == s).sum())
                    if links(overlap, len(own), len(s), share):
                        out.append((a, b))
            found = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    dealt = heads.unionByName(members).repartition("a", "part")
    order = ["a", "part", F.col("b").asc_nulls_first()]
    return dealt.sortWithinPartitions(*order).select("a", "b", "shingles").mapInArrow(test, "a long, b long")


# ---------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """``(cls, comp)``: the least class that each class of an edge reaches.

    Edges are rewired towards the least neighbour, from larger and from smaller ones in turn, until
    every class hangs on the least of its component.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, before = stored(edges.filter("u <> v").distinct()), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        # equal counts and sums of hashes: nothing moved
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            return edges.select(F.col("u").alias("cls"), F.col("v").alias("comp"))
        before = after


# -------------------------------------------------------------------- trees


class SignatureTree:
    """Classes of one block, ordered so that alike ones share leaves."""

    def __init__(self, n: np.ndarray, comp: np.ndarray, sig: np.ndarray):
        order = np.lexsort((n, comp))
        self.order, self.n, self.comp, self.sig = order, n[order], comp[order], sig[order]
        at = np.arange(0, len(n), LEAF)
        self.levels = [self._node(at, self.sig, self.sig, self.n, self.n, self.comp, self.comp)]
        while len(self.levels[-1][0]) > 1:
            any_, all_, low, high, c, d = self.levels[-1]
            self.levels.append(self._node(np.arange(0, len(low), FAN), any_, all_, low, high, c, d))

    def below(self, level: int, node: int) -> tuple[int, np.ndarray]:
        """The level under a node, and its nodes there."""
        step = FAN if level else LEAF
        size = len(self.levels[level - 1][0]) if level else len(self.n)
        return level - 1, np.arange(node * step, min(size, (node + 1) * step))

    def fields(self, level: int, at: np.ndarray):
        if level < 0:
            return tuple(f[at] for f in (self.sig, self.sig, self.n, self.n, self.comp, self.comp))
        return tuple(f[at] for f in self.levels[level])

    @staticmethod
    def _node(at, any_, all_, low, high, c, d):
        """OR and AND of the bitmaps, range of sizes, range of components."""
        return (
            np.bitwise_or.reduceat(any_, at),
            np.bitwise_and.reduceat(all_, at),
            np.minimum.reduceat(low, at),
            np.maximum.reduceat(high, at),
            np.minimum.reduceat(c, at),
            np.maximum.reduceat(d, at),
        )


def _survive(x, y, share=SHARE) -> np.ndarray:
    """Of two arrays of nodes, broadcast against each other: pairs that may hold a link."""
    any_x, all_x, low_x, high_x, c_x, d_x = x
    any_y, all_y, low_y, high_y, c_y, d_y = y
    apart = ~((c_x == d_x) & (c_y == d_y) & (c_x == c_y))
    only_x = np.bitwise_count(all_x & ~any_y).sum(axis=-1, dtype=np.int64)
    only_y = np.bitwise_count(all_y & ~any_x).sum(axis=-1, dtype=np.int64)
    overlap = np.minimum(high_x - only_x, high_y - only_y)
    # the bound against the least sum of sizes that still allows such an overlap
    return apart & links(overlap, np.maximum(low_x, overlap), np.maximum(low_y, overlap), share)


class Labels:
    """Which rows are joined; every row has the label of its group."""

    def __init__(self, first: np.ndarray):
        _, self.of = np.unique(first, return_inverse=True)
        self.groups = int(self.of.max(initial=-1)) + 1

    def join(self, rows: np.ndarray, others: np.ndarray, out: list[tuple[int, int]]) -> None:
        """Joins pairs of rows in turn, noting those that brought two groups together."""
        apart = self.of[rows] != self.of[others]
        while apart.any():
            k = int(apart.argmax())
            p, q = int(rows[k]), int(others[k])
            out.append((p, q))
            self.of[self.of == self.of[q]] = self.of[p]
            self.groups -= 1
            rows, others = rows[apart], others[apart]
            apart = self.of[rows] != self.of[others]


def join_trees(x: SignatureTree, y: SignatureTree, at_x, at_y, labels: Labels, share=SHARE) -> list[tuple[int, int]]:
    """Joins rows of two trees (or of one with itself) that may link.

    ``at_x`` and ``at_y`` are the places of the trees' rows among those labelled. Pairs that brought
    two groups together are returned.
    """
    same, out = x is y, []
    at_x, at_y = at_x[x.order], at_y[y.order]
    tops = [(len(x.levels) - 1, 0, len(y.levels) - 1, 0)]
    while tops and labels.groups > 1:
        i, a, j, b = tops.pop()
        if i == j == 0:  # two leaves: nothing to do where all is joined
            own = labels.of[at_x[a * LEAF : (a + 1) * LEAF]], labels.of[at_y[b * LEAF : (b + 1) * LEAF]]
            if (own[0] == own[0][0]).all() and (own[1] == own[0][0]).all():
                continue
        # the higher node opens, or both; the rows of a leaf count as level -1
        ni, rows_x = x.below(i, a) if i >= j else (i, np.array([a]))
        nj, rows_y = y.below(j, b) if j >= i else (j, np.array([b]))
        left = tuple(f[:, None] for f in x.fields(ni, rows_x))
        right = tuple(f[None] for f in y.fields(nj, rows_y))
        ok = _survive(left, right, share)
        if same and ni == nj:
            ok &= rows_x[:, None] <= rows_y[None] if ni >= 0 else rows_x[:, None] < rows_y[None]
        p, q = np.nonzero(ok)
        if ni < 0 and nj < 0:
            labels.join(at_x[rows_x[p]], at_y[rows_y[q]], out)
        else:
            tops.extend((ni, int(r), nj, int(s)) for r, s in zip(rows_x[p], rows_y[q], strict=True))
    return out


def block_pairs(cls, n, comp, sig, side, share=SHARE) -> list[tuple[int, int]]:
    """Pairs that join all of a block that may link; ``side`` tells two tiles apart."""
    labels = Labels(comp)
    if (side == side[0]).all():
        tree, all_ = SignatureTree(n, comp, sig), np.arange(len(n))
        found = join_trees(tree, tree, all_, all_, labels, share)
    else:
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found = join_trees(SignatureTree(n[x], comp[x], sig[x]), SignatureTree(n[y], comp[y], sig[y]), x, y, labels, share)
    return [(int(cls[p]), int(cls[q])) for p, q in found]


def _whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows sorted by the named columns, cut between groups, and where groups begin and end."""
    rest = None

    def borders(rows):
        new = np.zeros(rows.num_rows, bool)
        new[:1] = True
        for c in names:
            v = rows.column(c).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.append(np.flatnonzero(new), rows.num_rows)

    for batch in batches:
        if batch.num_rows:
            rows = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            at = borders(rows)
            if len(at) > 2:
                yield rows.slice(0, int(at[-2])), at[:-1]
            rest = rows.slice(int(at[-2]))
    if rest is not None:
        yield rest, borders(rest)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _searched(batches: Iterator[pa.RecordBatch], share) -> Iterator[pa.RecordBatch]:
    """Pairs that join the families of all blocks; rows come sorted by block."""
    seen: set[tuple[int, int]] = set()
    for rows, at in _whole_groups(batches, ["key", "i", "j"]):
        side, cls, n, comp = (rows.column(c).to_numpy() for c in ("side", "cls", "n", "comp"))
        sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint64).reshape(len(n), -1)
        size = np.diff(at)
        two = at[:-1][size == 2]
        ok = _survive(*(tuple(f[two + k] for f in (sig, sig, n, n, comp, comp)) for k in (0, 1)), share)
        found = list(zip(cls[two[ok]].tolist(), cls[two[ok] + 1].tolist(), strict=True))
        for a, b in zip(at[:-1][size > 2].tolist(), at[1:][size > 2].tolist(), strict=True):
            found.extend(block_pairs(cls[a:b], n[a:b], comp[a:b], sig[a:b], side[a:b], share))
        fresh = sorted({(min(p), max(p)) for p in found} - seen)
        if len(seen) < 1_000_000:  # fewer repeats to send; what slips through is dropped later
            seen.update(fresh)
        yield _pairs(fresh)


def overlaps(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from products of incidence matrices, some columns at a time."""
    size = np.array([len(s) for s in (*sets, *others)])
    token, at, times = np.unique(np.concatenate([*sets, *others]), return_inverse=True, return_counts=True)
    row, several = np.repeat(np.arange(len(size)), size), times[at] > 1
    # tokens of a single set are in no intersection
    _, at = np.unique(at[several], return_inverse=True)
    row = row[several]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    out = np.zeros((len(sets), len(others)), np.float32)
    for base in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        a, b = np.searchsorted(at, [base, base + COLUMNS])
        held = np.zeros((len(size), COLUMNS), np.float32)
        held[row[a:b], at[a:b] - base] = 1
        out += held[: len(sets)] @ held[len(sets) :].T
    return out.astype(np.int64)


def family_links(cls, comp, sets, side, share=SHARE) -> list[tuple[int, int]]:
    """Links that join components within one family, or between two tiles of it."""
    labels, out = Labels(comp), []
    n = np.array([len(s) for s in sets])
    one = (side == side[0]).all()
    x = np.arange(len(n)) if one else np.flatnonzero(side == 0)
    y = x if one else np.flatnonzero(side == 1)
    for a in range(0, len(x), FAMILY_TILE):
        for b in range(a if one else 0, len(y), FAMILY_TILE):
            p, q = x[a : a + FAMILY_TILE], y[b : b + FAMILY_TILE]
            i, j = np.nonzero(links(overlaps([sets[k] for k in p], [sets[k] for k in q]), n[p][:, None], n[q][None], share))
            labels.join(p[i], q[j], out)
    return [(int(cls[p]), int(cls[q])) for p, q in out]


def _decided(batches: Iterator[pa.RecordBatch], share) -> Iterator[pa.RecordBatch]:
    """Links between components of all families; rows come sorted by family."""
    for rows, at in _whole_groups(batches, ["family", "i", "j"]):
        cls, comp, side = (rows.column(c).to_numpy() for c in ("cls", "comp", "side"))
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
        found = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            found.extend(family_links(cls[a:b], comp[a:b], sets[a:b], side[a:b], share))
        yield _pairs(found)


# ---------------------------------------------------------------------- join


def blocks(table: DataFrame, share=SHARE) -> DataFrame:
    """``key, cls, n, weight``: classes by shared hash, without the commonest hashes of each class."""
    rows = table.select("cls", "n", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.count("*").alias("df"))
    shared = shared.filter("lo <> hi").select("key", "df")
    # copies of one text come together here
    rows = rows.join(shared, "key").groupBy("cls", "n", "key").agg(F.first("df").alias("df"))
    own = Window.partitionBy("cls", "n")
    least = f"((n * {share[0]} + {share[1] - 1}) DIV {share[1]})"
    rows = rows.select(
        "key",
        "cls",
        "n",
        F.row_number().over(own.orderBy(F.desc("df"), F.desc("key"))).alias("rank"),
        F.sum("df").over(own).alias("weight"),
    )
    return rows.filter(F.col("rank") > F.expr(f"{least} * {SPARED[0]} DIV {SPARED[1]}")).drop("rank")


def likely(rows: DataFrame, share=SHARE) -> DataFrame:
    """Pairs of a block's weightiest class and others that meet it in a quarter of their blocks."""
    top = rows.groupBy("key").agg(F.max(F.struct("weight", "cls", "n")).alias("top"), F.count("*").alias("m"))
    met = rows.join(top.filter("m > 1"), "key").filter("cls <> top.cls")
    met = met.filter(f"least(n, top.n) * {share[1]} >= greatest(n, top.n) * {share[0]}")
    pairs = met.groupBy(F.col("top.cls").alias("a"), F.col("cls").alias("b")).agg(
        F.count("*").alias("times"), F.max("n").alias("n")
    )
    return pairs.filter(f"times * 4 * {share[1]} >= n * {share[1] - share[0]}").select("a", "b")


def _tiled(rows: DataFrame, group: str, tiles: Column, *columns: str) -> DataFrame:
    """Rows dealt to the pairs of tiles of their group, each tile with itself and every other."""
    rows = rows.withColumn("tiles", tiles.cast("int"))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("cls"), "tiles").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select(
        group,
        F.least("tile", "other").alias("i"),
        F.greatest("tile", "other").alias("j"),
        (F.col("tile") > F.col("other")).cast("int").alias("side"),
        *columns,
    )
    return rows.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


def searched(rows: DataFrame, table: DataFrame, comps: DataFrame, share=SHARE) -> DataFrame:
    """Pairs ``(a, b)`` that join what some block does not rule out to link."""
    rows = rows.join(comps, "cls", "left").select("key", "cls", "n", F.coalesce("comp", "cls").alias("comp"))
    open_ = rows.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("small"), F.max("n").alias("big"), F.count("*").alias("m")
    )
    # two classes of sizes too far apart need no search
    open_ = open_.filter(f"lo <> hi AND (m > 2 OR small * {share[1]} >= big * {share[0]})")
    sigs = table.groupBy("cls").agg(F.first("sig").alias("sig"))
    rows = rows.join(open_.select("key", "m"), "key").join(sigs, "cls")
    rows = _tiled(rows, "key", F.ceil(F.col("m") / TILE), "cls", "n", "comp", "sig")
    return rows.mapInArrow(lambda batches: _searched(batches, share), "a long, b long").distinct()


def decided(
    pairs: DataFrame, first: DataFrame, comps: DataFrame, docs, table, doc_id="doc_id", text="text", words=WORDS, share=SHARE
) -> DataFrame:
    """Links ``(a, b)`` between the components that make up the families of ``pairs``."""
    families = components(pairs.unionByName(first)).withColumnRenamed("comp", "family")
    lone = families.select(F.col("family").alias("cls"), "family").distinct()
    rows = families.unionByName(lone).join(comps, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    sizes = rows.groupBy("family").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"))
    rows = stored(rows.join(sizes.filter("lo <> hi").select("family", "m"), "family"))
    sets = sets_of(rows.select("cls").distinct(), docs, table, doc_id, text, words)
    rows = rows.join(sets, "cls")
    rows = _tiled(rows, "family", F.ceil(F.col("m") / FAMILY_TILE), "cls", "comp", "shingles")
    return rows.mapInArrow(lambda batches: _decided(batches, share), "a long, b long")


def _named(docs: DataFrame, doc_id: str, text: str, words: int, share: tuple[int, int]) -> DataFrame:
    """Per row: ``doc_id, n, cls, comp``; rows without shingles have no component."""
    table = stored(classes(docs, doc_id, text, words, share))
    rows = stored(blocks(table.filter("n > 0"), share))
    first = stored(verified(stored(likely(rows, share)), docs, table, doc_id, text, words, share))
    comps = components(first)
    pairs = stored(searched(rows, table, comps, share))
    second = decided(pairs, first, comps, docs, table, doc_id, text, words, share)
    comps = components(first.unionByName(second))
    named = table.select("doc_id", "n", "cls").join(comps, "cls", "left")
    return stored(named.withColumn("comp", F.when(F.col("n") > 0, F.coalesce("comp", "cls"))))


def ngram_join(docs: DataFrame, doc_id="doc_id", text="text", words=WORDS, share=SHARE) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id``."""
    named = _named(docs, doc_id, text, words, share)
    ids = named.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return named.join(ids, "comp", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, doc_id="doc_id", text="text", words=WORDS, share=SHARE) -> DataFrame:
    """The documents without near copies of others: of each component one row stays.

    It is a row with the least id, and of several texts under that id one with the least hash. Rows
    without shingles all stay. Columns are those of ``docs``.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    content, row = unused(docs, "content", "row")
    texts = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    # the join sees the hash of the text as part of the id, so that both lead back to the row
    key = F.struct(F.col(f"`{doc_id}`").isNull().alias("none"), F.col(f"`{doc_id}`").alias("id"), texts.alias("content"))
    named = _named(docs.select(key.alias("doc_id"), F.col(f"`{text}`").alias("text")), "doc_id", "text", words, share)
    of = F.col("doc_id.id").alias("of_id"), F.col("doc_id.content").alias("of_content")
    kept = named.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("doc_id")).select(*of)
    bare = named.filter("comp IS NULL").select(*of).distinct()
    kept = kept.withColumn("bare", F.lit(False)).unionByName(bare.withColumn("bare", F.lit(True)))
    (found,) = unused(docs, "bare")
    kept = kept.withColumnRenamed("bare", found)
    rows = docs.withColumn(content, texts).join(
        kept, F.col(f"`{doc_id}`").eqNullSafe(F.col("of_id")) & (F.col(content) == F.col("of_content"))
    )
    same = Window.partitionBy("of_id", "of_content").orderBy(texts)
    rows = rows.withColumn(row, F.row_number().over(same))
    return rows.filter(F.col(found) | (F.col(row) == 1)).select(*own)


SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE
      WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM texts)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * i >= 85 * (x.n + y.n - i)),
reached(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT links.b, reached.r FROM reached JOIN links ON links.a = reached.doc_id)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


@query(SQL)
def op1_ngram_join(spark, sf_dir):
    return ngram_join(documents(spark, sf_dir))
