"""NumPy helpers that run inside Arrow tasks.

They see one bounded block of vectors at a time; Spark decides which rows
share a block. ``TopK`` keeps the k best rows per query while blocks stream by.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

FIRST_ROWS = 256
TILE_ROWS = 2048
TILE_QUERIES = 512
PAIR_BLOCK = 1 << 21
#: Most queries of one list that read costs from tables, and rows that they look up at a time.
TABLE_QUERIES = 12
TABLE_ROWS = 1 << 14
#: Rows that are compared or put together at a time.
BLOCK_ROWS = 1 << 13
# odd 64-bit number near 2**64 over the golden ratio
HASH_FACTOR = 0x9E3779B97F4A7C15
NO_ID = np.iinfo(np.int64).max


def matrix(column, dim: int) -> np.ndarray:
    """Arrow ``list<float>`` column -> ``(n, dim)`` float32."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.empty((0, dim), np.float32)
    lengths = np.diff(column.offsets.to_numpy())
    if column.null_count or not (lengths == dim).all():
        raise ValueError(f"every vector must be non-null with {dim} elements")
    values = column.flatten()
    if values.null_count:
        raise ValueError("vector contains a null element")
    return values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(n, dim)


def int64(column) -> np.ndarray:
    return column.to_numpy().astype(np.int64, copy=False)


def vectors(mat: np.ndarray) -> pa.ListArray:
    """``(n, dim)`` matrix -> Arrow ``list<float>``."""
    n, dim = mat.shape
    offsets = np.arange(0, (n + 1) * dim, dim, dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(mat, np.float32).ravel())


def sq_norms(mat: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", mat, mat)


def exact_cost(q: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    """Row-by-row cost in float64; lower is better for both metrics."""
    if metric == "l2":
        diff = q.astype(np.float64) - x.astype(np.float64)
        return np.einsum("ij,ij->i", diff, diff)
    return -np.einsum("ij,ij->i", q.astype(np.float64), x.astype(np.float64))


def _positions(mask: np.ndarray) -> np.ndarray:
    """Flat positions of the true elements, eight at a time as few are true."""
    if mask.size % 8:
        return np.flatnonzero(mask)
    word = np.flatnonzero(mask.reshape(-1).view(np.uint64))
    part, bit = np.nonzero(mask.reshape(-1, 8)[word])
    return word[part] * 8 + bit


class TopK:
    """The k best rows of every query over a stream of row blocks.

    A tile is scored with one matrix product; only pairs within the proven
    rounding error of the current k-th best are scored again in float64, so
    results equal a full float64 scan with ties going to the smaller id.
    """

    def __init__(self, qids: np.ndarray, queries: np.ndarray, k: int, metric: str, bound=np.inf):
        """``bound``: cost that the k-th best row is known not to exceed, per query."""
        self.qids, self.queries, self.k, self.metric = qids, queries, k, metric
        self.bound = np.broadcast_to(np.asarray(bound, float), len(qids))
        self.cost = np.full((len(qids), k), np.inf)
        self.ids = np.full((len(qids), k), NO_ID, np.int64)
        self.seen = np.zeros(len(qids), np.int64)
        self.length = np.sqrt(sq_norms(queries.astype(np.float64)))
        self.left = {}

    def _left(self, dtype) -> np.ndarray:
        """Query side of the matrix product: ``[-2q, 1]`` for L2, ``[-q]`` otherwise."""
        if dtype not in self.left:
            q = self.queries.astype(dtype)
            one = np.ones((len(q), 1), dtype)
            self.left[dtype] = np.hstack([-2 * q, one]) if self.metric == "l2" else -q
        return self.left[dtype]

    def _right(self, x: np.ndarray, dtype) -> np.ndarray:
        """Row side: ``[x, |x|^2]`` for L2, so a product gives ``|x|^2 - 2qx``."""
        x = x.astype(dtype, copy=False)
        return np.hstack([x, sq_norms(x)[:, None]]) if self.metric == "l2" else x

    def push(self, ids: np.ndarray, rows: np.ndarray, only: np.ndarray | None = None) -> None:
        """Offer a block of rows to all queries, or to the query positions ``only``."""
        picked = np.arange(len(self.qids)) if only is None else only
        kept = without_copies(ids, rows, self.k)
        if kept is not None:
            ids, rows = ids[kept], rows[kept]
        start = 0
        while start < len(ids) and len(picked):
            # tiles grow with what was seen: each step offers few new candidates
            size = int(np.clip(self.seen[picked].min(), FIRST_ROWS, TILE_ROWS))
            x, x_ids = rows[start : start + size], ids[start : start + size]
            x_length = np.sqrt(sq_norms(x.astype(np.float64)).max())
            right = {}
            for qs in range(0, len(picked), TILE_QUERIES):
                sel = picked[qs : qs + TILE_QUERIES]
                near = self._shortlist(sel, x, x_length, right)
                step = max(1, PAIR_BLOCK // x.shape[1])
                for s in range(0, len(near), step):
                    qi, xi = np.divmod(near[s : s + step], len(x))
                    cost = exact_cost(self.queries[sel[qi]], x[xi], self.metric)
                    self._merge(sel[qi], cost, x_ids[xi])
            self.seen[picked] += len(x)
            start += size

    def _shortlist(self, sel, x, x_length: float, right: dict) -> np.ndarray:
        """Flat positions of the pairs of a tile that may enter the k best.

        float32 serves unless its error leaves many pairs or it would overflow.
        """
        reach = self.length[sel] + x_length
        for dtype in (np.float32, np.float64):
            if dtype is np.float32 and reach.max() > 1e15:
                continue
            if dtype not in right:
                right[dtype] = self._right(x, dtype).T
            approx = self._left(dtype)[sel] @ right[dtype]
            slack = 2 * (x.shape[1] + 8) * np.finfo(dtype).eps * reach**2
            shift = self.length[sel] ** 2 if self.metric == "l2" else 0.0
            limit = np.minimum(self.cost[sel, -1], self.bound[sel]) - shift + slack
            if not np.isfinite(limit).all() and len(x) > self.k:
                kth = np.partition(approx, self.k - 1, axis=1)[:, self.k - 1].astype(np.float64)
                limit = np.minimum(limit, kth + 2 * slack)
            limit = np.nextafter(limit.astype(dtype), dtype(np.inf))
            near = _positions(approx <= limit[:, None])
            if len(near) <= len(sel) * max(4 * self.k, 64):
                break
        return near

    def _merge(self, qi, cost, ids) -> None:
        if not len(qi):
            return
        touched = np.unique(qi)
        qi = np.concatenate([np.repeat(touched, self.k), qi])
        cost = np.concatenate([self.cost[touched].ravel(), cost])
        ids = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((ids, cost, qi))
        qi, cost, ids = qi[order], cost[order], ids[order]
        first = np.searchsorted(qi, touched)
        keep = first[:, None] + np.arange(self.k)
        self.cost[touched], self.ids[touched] = cost[keep], ids[keep]

    def batch(self) -> pa.RecordBatch:
        """What was found, as ``(qid, rank, id, distance)``."""
        qi, pos = np.nonzero(np.isfinite(self.cost))
        cost = self.cost[qi, pos]
        distance = cost if self.metric == "l2" else 0.0 - cost
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.qids[qi]),
                pa.array((pos + 1).astype(np.int32)),
                pa.array(self.ids[qi, pos]),
                pa.array(distance),
            ],
            names=["qid", "rank", "id", "distance"],
        )


def without_copies(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray | None:
    """Positions to score when some vector has more than k copies, else None.

    Copies have equal distances, so none but the k with the smallest ids can be
    among the k best of any query. Rows are grouped by a hash of their bits and
    count as copies only if they equal the first row of their group.
    """
    if len(rows) <= k:
        return None
    # a few elements tell most blocks apart; only crowded ones need the whole row
    for step in sorted({max(1, rows.shape[1] // 16), 1}, reverse=True):
        key = np.zeros(len(rows), np.uint64)
        for at, column in enumerate(range(0, rows.shape[1], step), 1):
            word = np.ascontiguousarray(rows[:, column], np.float32).view(np.uint32)
            key += word * np.uint64((2 * at + 1) ** 2 * HASH_FACTOR % 2**64)
        _, first, group, size = np.unique(
            key, return_index=True, return_inverse=True, return_counts=True
        )
        crowded = np.flatnonzero(size[group] > k)
        if not len(crowded):
            return None
    copy = np.empty(len(crowded), bool)
    for s in range(0, len(crowded), BLOCK_ROWS):
        part = crowded[s : s + BLOCK_ROWS]
        copy[s : s + BLOCK_ROWS] = (rows[part] == rows[first[group[part]]]).all(axis=1)
    crowded = crowded[copy]
    crowded = crowded[np.lexsort((ids[crowded], group[crowded]))]
    starts = np.searchsorted(group[crowded], group[crowded])
    keep = np.ones(len(rows), bool)
    keep[crowded[np.arange(len(crowded)) - starts >= k]] = False
    return np.flatnonzero(keep)


class Flat:
    """Reads plain ``vec`` arrays out of a batch."""

    columns = ["vec"]

    def __init__(self, dim: int):
        self.dim = dim

    def __call__(self, batch) -> np.ndarray:
        return matrix(batch.column("vec"), self.dim)


class Half:
    """Reads float16 blobs out of a batch."""

    columns = ["half"]

    def __init__(self, dim: int):
        self.dim = dim

    def __call__(self, batch) -> np.ndarray:
        return binary_matrix(batch.column("half"), self.dim, "<f2").astype(np.float32)


class Product:
    """Product-quantized rows: codes of the residual to the centroid of their list.

    ``books`` is a broadcast ``(m, codes, dim / m)`` matrix, ``coarse`` a broadcast of the list centroids.
    Without it whoever reads the rows knows their list's centroid, as rows hold nothing but codes.
    """

    columns = ["codes"]

    def __init__(self, books, coarse):
        self.books, self.coarse = books, coarse

    def codes(self, batch) -> np.ndarray:
        return binary_matrix(batch.column("codes"), self.books.value.shape[0], "u1")

    def vectors(self, codes: np.ndarray, base: np.ndarray) -> np.ndarray:
        """The rows that the codes stand for, with one centroid for all or one for each."""
        books = self.books.value
        m, _, width = books.shape
        out = np.empty((len(codes), m * width), np.float32)
        for s in range(0, len(codes), BLOCK_ROWS):
            part = codes[s : s + BLOCK_ROWS]
            own = base if base.ndim == 1 else base[s : s + BLOCK_ROWS]
            out[s : s + BLOCK_ROWS] = books[np.arange(m), part].reshape(len(part), m * width) + own
        return out

    def __call__(self, batch) -> np.ndarray:
        if self.coarse is None:
            dim = self.books.value.shape[0] * self.books.value.shape[2]
            return self.vectors(self.codes(batch), matrix(batch.column("coarse"), dim))
        return self.vectors(self.codes(batch), self.coarse.value[batch.column("list_id").to_numpy()])

    def tables(self, queries: np.ndarray, base: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
        """What each code of each sub-space adds to a query's cost within a list, and the rest of that cost."""
        books = self.books.value
        m, _, width = books.shape
        q, base = queries.astype(np.float64), base.astype(np.float64)
        if metric == "l2":
            left = (q - base).reshape(len(q), m, width)
            cross = np.einsum("qsw,scw->qsc", left, books)
            norms = np.einsum("qsw,qsw->qs", left, left)[:, :, None]
            return norms - 2 * cross + np.einsum("scw,scw->sc", books, books), np.zeros(len(q))
        return -np.einsum("qsw,scw->qsc", q.reshape(len(q), m, width), books), -(q @ base)

    def push(self, best: TopK, ids: np.ndarray, codes: np.ndarray, base: np.ndarray, only=None) -> None:
        """Offers the rows of one list.

        For few queries a row's cost is a sum of table entries, one for each of its codes, and only rows near
        enough are put together, to be scored as all others are. For many queries it takes less to put all
        rows together once and score them with a matrix product.
        """
        picked = np.arange(len(best.qids)) if only is None else only
        if len(picked) > TABLE_QUERIES:
            best.push(ids, self.vectors(codes, base), only)
            return
        q, k = best.queries[picked], best.k
        table, rest = self.tables(q, base, best.metric)
        longest = np.sqrt((sq_norms(self.books.value.reshape(-1, self.books.value.shape[2])).max()) * table.shape[1])
        # vectors are rounded to float32 when put together, sums of table entries are not
        reach = best.length[picked] + np.sqrt(sq_norms(base[None, :].astype(np.float64)))[0] + longest
        slack = 8 * np.finfo(np.float32).eps * reach**2
        for s in range(0, len(ids), TABLE_ROWS):
            part = np.ascontiguousarray(codes[s : s + TABLE_ROWS].T)
            approx = np.repeat(rest[:, None], part.shape[1], axis=1)
            for sub, code in enumerate(part):
                approx += table[:, sub].take(code, axis=1)
            limit = np.minimum(best.cost[picked, -1], best.bound[picked]) + slack
            if not np.isfinite(limit).all() and part.shape[1] > k:
                kth = np.partition(approx, k - 1, axis=1)[:, k - 1]
                limit = np.minimum(limit, kth + 2 * slack)
            qi, xi = np.nonzero(approx <= limit[:, None])
            rows, at = np.unique(xi, return_inverse=True)
            x = self.vectors(codes[s + rows], base)
            best._merge(picked[qi], exact_cost(q[qi], x[at], best.metric), ids[s + xi])
        best.seen[picked] += len(ids)


def binary_matrix(column, width: int, dtype: str) -> np.ndarray:
    """Arrow binary column of equal-sized blobs -> ``(n, width)`` array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.empty((0, width), dtype)
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1]
    size = width * np.dtype(dtype).itemsize
    if column.null_count or not (np.diff(offsets) == size).all():
        raise ValueError(f"every blob must be non-null with {size} bytes")
    data = np.frombuffer(column.buffers()[2], "u1")[offsets[0] : offsets[-1]]
    return data.view(dtype).reshape(n, width)


def blobs(mat: np.ndarray) -> pa.BinaryArray:
    """``(n, width)`` array -> Arrow binary column, one row-major blob per row."""
    mat = np.ascontiguousarray(mat)
    size = mat.shape[1] * mat.itemsize
    offsets = np.arange(0, (len(mat) + 1) * size, size, dtype=np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(mat), [None, pa.py_buffer(offsets), pa.py_buffer(mat.tobytes())]
    )
