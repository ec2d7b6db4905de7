"""Quality classifier by co-training of two views.

One view reads the text: shares of hashed byte trigrams and a few ratios. The other reads what is
known about the page: language, source and length. Both start from the labelled documents. In each
round a view labels those unlabelled documents that it is surest of, and the other view learns from
them. A held-out fold of the labelled documents then calibrates each view, and the calibrated log odds
add up (less the prior, which both contain) to the score of every document.

Training learns from about ``MOST_LABELLED`` labelled documents, chosen by a hash of the id. Each class
of each fold has the same share of these, and one with fewer is taken whole; what that shifts is weighed
back in the calibration and the prior. Both views look at all unlabelled documents in every round, in a
pass of their own of which the ``CONFIDENT`` surest remain, copies counting once whatever their ids. All documents are
scored whole.

A document with several labels has the lowest; null labels count as none. Without labels of both
kinds in both folds there is no model: scores are null and all documents are kept. Text that is null
or has no word scores 0 and is not kept. Repeated rows are scored alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearfield.llm.common import documents, pieces, query, stored
from nearfield.plans import sizing

MOST_LABELLED = 8000
ROUNDS, CONFIDENT, SURE = 3, 400, 0.95
TRIGRAMS, RATIOS = 1024, 7
LANGUAGES, SOURCES = 16, 64
PIECE_BYTES, PIECE_ROWS = 1 << 20, 256
#: Lists of the tasks' surest documents are merged in so many groups first.
LISTS = 32

# --------------------------------------------------------------------- views

KIND = np.zeros(256, np.uint8)  # 1 space, 2 capital, 3 digit, 4 sign, 0 other
KIND[[9, 10, 11, 12, 13, 32]] = 1
KIND[ord("A") : ord("Z") + 1] = 2
KIND[ord("0") : ord("9") + 1] = 3
KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4


def text_view(raw: list[bytes]) -> np.ndarray:
    """Features of the texts, one row each."""
    n = len(raw)
    size = np.fromiter(map(len, raw), np.int64, n)
    data = np.frombuffer(b"".join(raw), np.uint8)
    out = np.zeros((n, TRIGRAMS + RATIOS), np.float32)
    if not len(data):
        return out
    doc = np.repeat(np.arange(n), size)
    x = data.astype(np.uint32)
    code = x * 0x9E3779B1
    code[1:] ^= x[:-1] * 0x85EBCA6B
    code[2:] ^= x[:-2] * 0xC2B2AE35
    code = (code ^ code >> 15) * np.uint32(0x2C1B3C6D) >> 22
    counts = np.bincount(doc * TRIGRAMS + code, minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
    real = np.maximum(size, 1)[:, None]
    out[:, :TRIGRAMS] = counts / real * 100
    kinds = np.bincount(doc * 5 + KIND[data], minlength=n * 5).reshape(n, 5) / real
    words = [x.split() for x in raw]
    many = np.array([max(1, len(w)) for w in words])
    out[:, TRIGRAMS : TRIGRAMS + 4] = kinds[:, 1:]
    out[:, TRIGRAMS + 4] = [len(set(w)) / m for w, m in zip(words, many, strict=True)]
    out[:, TRIGRAMS + 5] = (counts > 0).sum(axis=1) / np.minimum(real[:, 0], TRIGRAMS)
    out[:, TRIGRAMS + 6] = np.log1p(size / many)
    return out


def metadata_view(lang: list, source: list, n_chars: list) -> np.ndarray:
    """Features of what is known about the pages."""
    out = np.zeros((len(lang), LANGUAGES + SOURCES + 2), np.float32)
    for i, (a, b, c) in enumerate(zip(lang, source, n_chars, strict=True)):
        if a is not None:
            out[i, zlib.crc32(str(a).encode()) % LANGUAGES] = 1
        if b is not None:
            out[i, LANGUAGES + zlib.crc32(str(b).encode()) % SOURCES] = 1
        out[i, -2] = np.log1p(max(0, c or 0)) / 10
        out[i, -1] = c is None
    return out


# ------------------------------------------------------------------ learning


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 120) -> np.ndarray:
    """Weights of a logistic regression, the intercept last; classes weigh the same."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = ((x - mean) / scale).astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    w, b = np.zeros(x.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        r = weight * (1 / (1 + np.exp(-np.clip(z @ w.astype(np.float32) + b, -30, 30))) - y)
        g = np.append(r.astype(np.float32) @ z + ridge * w, r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return np.append(w / scale, b - (mean / scale) @ w)


def odds(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return x @ weights[:-1] + weights[-1]


def platt(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that calibrate log odds, by damped Newton steps; the slope is not negative."""
    scale = float(logit.std()) + 1e-9
    x = np.stack([logit / scale, np.ones(len(logit))], axis=1)
    w = np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + 0.1 * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), g)
        w = w - np.clip(step, -0.5, 0.5)
        if np.abs(step).max() < 1e-9:
            break
    if w[0] < 0:
        mean = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
        return 0.0, float(np.log(mean / (1 - mean)))
    return float(w[0] / scale), float(w[1])


@dataclass
class Model:
    """Weights of both views, their calibrations, and the prior log odds."""

    views: tuple[np.ndarray, np.ndarray]
    calibration: tuple[tuple[float, float], tuple[float, float]]
    prior: float

    def score(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by text, by metadata, by both."""
        logits = [a * odds(x, w) + b for x, w, (a, b) in zip((text, metadata), self.views, self.calibration, strict=True)]
        p = [1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in (*logits, logits[0] + logits[1] - self.prior)]
        return p[0], p[1], p[2]


def chance(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds(x, weights), -30, 30)))


def held(pool):
    """The surest of a pool in memory, see ``cotrain``."""
    free = [np.ones(len(pool[0]), bool), np.ones(len(pool[1]), bool)]

    def surest(weights, most):
        out = []
        for k in (0, 1):
            other, p = 1 - k, chance(pool[k], weights[k])
            for label, sure in ((1, p), (0, 1 - p)):
                ranked = np.flatnonzero(free[other] & (sure >= SURE))
                chosen = ranked[np.argsort(-sure[ranked], kind="stable")[: most[label]]]
                free[other][chosen] = False
                out.append((other, label, pool[other][chosen]))
        return out

    return surest


def cotrain(views, y, fold, pool, rounds=ROUNDS, confident=CONFIDENT, weight=None) -> Model | None:
    """``views`` hold the features of both views; ``fold`` marks the calibration fold.

    ``weight`` says how many labelled documents a row stands for. ``pool`` holds the features of
    unlabelled documents, or is a function of the weights of both views and of the most by label: it
    gives ``(other, label, features)``, what a view is surest of, for the other to learn, each once.
    """
    learn = ~fold
    if min(((y == k) & f).sum() for k in (0, 1) for f in (learn, fold)) == 0:
        return None
    surest = pool if callable(pool) else held(pool)
    weight = np.ones(len(y)) if weight is None else weight
    sets = [(x[learn], y[learn]) for x in views]
    share = np.average(y[learn], weights=weight[learn])
    most = {1: max(1, int(confident * share)), 0: max(1, int(confident * (1 - share)))}
    for _ in range(rounds):
        for other, label, found in surest([logistic(*s) for s in sets], most):
            x, have = sets[other]
            sets[other] = np.concatenate([x, found]), np.append(have, np.full(len(found), label))
    weights = tuple(logistic(*s) for s in sets)
    each = weight[fold] / weight[fold].mean()
    calibration = tuple(platt(odds(x[fold], w), y[fold], each) for x, w in zip(views, weights, strict=True))
    known = np.clip(np.average(y[fold], weights=each), 1e-3, 1 - 1e-3)
    return Model(weights, calibration, float(np.log(known / (1 - known))))


# -------------------------------------------------------------------- tables


def _features(rows: DataFrame) -> DataFrame:
    """``doc_id, label, text_view, metadata_view`` of ``doc_id, label, text, lang, source, n_chars``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            a, b = _both(batch)
            columns = [batch.column("doc_id"), batch.column("label")]
            columns += [pa.array([r.tobytes() for r in x], pa.binary()) for x in (a, b)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "text_view", "metadata_view"])

    schema = rows.select("doc_id", "label").schema.add("text_view", "binary").add("metadata_view", "binary")
    return rows.mapInArrow(run, schema)


def _blocks(batches):
    for batch in pieces(batches, "text", PIECE_BYTES):
        for k in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(k, PIECE_ROWS)


def _both(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw = [(x or "").encode() for x in batch.column("text").to_pylist()]
    known = (batch.column(c).to_pylist() for c in ("lang", "source", "n_chars"))
    return text_view(raw), metadata_view(*known)


def _share(labels: DataFrame, most: int) -> DataFrame:
    """``doc_id, label, weight`` of about ``most`` rows by a hash of the id, alike of each class and fold."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    rows = labels.withColumn("fold", fold).withColumn("good", F.col("label") > 0)
    groups = sorted(rows.groupBy("good", "fold").count().collect(), key=lambda r: r["count"])
    kept, weight = F.lit(False), F.lit(1.0)
    for i, (good, in_fold, n) in enumerate(groups):
        some = min(n, most // (len(groups) - i))
        most -= some
        of = (F.col("good") == good) & (F.col("fold") == in_fold)
        kept = kept | (of & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < -(-(some << 30) // n)))
        weight = F.when(of, F.lit(n / some)).otherwise(weight)
    return rows.filter(kept).select("doc_id", "label", weight.alias("weight"))


def _top(sure: np.ndarray, key: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The surest, each key once; ties go to the smaller key."""
    order = np.lexsort((key, -sure))
    _, first = np.unique(key[order], return_index=True)
    kept = order[np.sort(first)[:most]]
    return sure[kept], key[kept]


def once(rows: DataFrame) -> DataFrame:
    """Of the rows of one ``doc_id`` the least one."""
    rest = [c for c in rows.columns if c != "doc_id"]
    return rows.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row")).select("doc_id", *(f"row.{c}" for c in rest))


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task sends one row of an id; for few ids, whose rows are all alike."""
    seen = np.empty(0, np.int64)
    for batch in batches:
        ids, first = np.unique(batch.column("doc_id").to_numpy(), return_index=True)
        new = ~np.isin(ids, seen)
        seen = np.union1d(seen, ids)
        yield batch.take(pa.array(np.sort(first[new])))


def _surest(docs: DataFrame, labels: DataFrame):
    """The surest of all documents without a label, see ``cotrain``."""
    names = ("doc_id", "text", "lang", "source", "n_chars")
    rows = docs.filter(F.col("doc_id").isNotNull())
    n = labels.count()
    known = np.empty(0, np.int64)
    if 8 * n <= sizing.broadcast_bytes(docs.sparkSession):
        known = np.sort(labels.select(F.xxhash64("doc_id").alias("id")).toArrow().column("id").to_numpy())
    else:
        rows = stored(rows.join(labels, "doc_id", "left_anti").select(*names))
    rows = rows.select(*names, F.xxhash64("doc_id").alias("id"), F.xxhash64(*names[1:]).alias("key"))
    labelled = docs.sparkSession.sparkContext.broadcast(known)
    taken: list[list[int]] = [[], []]

    def free(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = labelled.value
        if not len(ids):
            return batch
        id_ = batch.column("id").to_numpy()
        return batch.filter(pa.array(ids[np.minimum(np.searchsorted(ids, id_), len(ids) - 1)] != id_))

    def surest(weights, most):
        shared = docs.sparkSession.sparkContext.broadcast((weights, [np.array(t, np.int64) for t in taken]))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, gone = shared.value
            best = {(k, label): (np.empty(0), np.empty(0, np.int64)) for k in (0, 1) for label in (1, 0)}
            for batch in _blocks(map(free, batches)):
                key = batch.column("key").to_numpy()
                for k, x in enumerate(_both(batch)):
                    p, new = chance(x, weights[k]), ~np.isin(key, gone[1 - k])
                    for label, sure in ((1, p), (0, 1 - p)):
                        some = new & (sure >= SURE)
                        if some.any():
                            s, c = best[k, label]
                            best[k, label] = _top(np.append(s, sure[some]), np.append(c, key[some]), most[label])
            for (k, label), (s, c) in best.items():
                columns = [np.full(len(c), k, np.int32), np.full(len(c), label, np.int32), s, c]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["k", "label", "sure", "key"])

        top = rows.mapInArrow(look, "k int, label int, sure double, key long")
        top = top.withColumn("list", F.spark_partition_id() % LISTS)
        bound = F.when(F.col("label") == 1, most[1]).otherwise(most[0])
        for by in (("k", "label", "list"), ("k", "label")):
            top = top.groupBy("key", *by).agg(F.max("sure").alias("sure"))
            best = Window.partitionBy(*by).orderBy(F.desc("sure"), "key")
            top = top.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= bound).drop("rank")
        chosen = top.toArrow().to_pandas().sort_values(["k", "label", "sure", "key"], ascending=[True, False, False, True])
        wanted = docs.sparkSession.createDataFrame([(x,) for x in sorted({int(x) for x in chosen["key"]})], "key long")
        # the texts of the few that were chosen are read again
        found = rows.join(F.broadcast(wanted), "key", "left_semi").select(F.col("key").alias("doc_id"), F.lit(None).cast("int").alias("label"), *names[1:])
        found = found.mapInArrow(_first_seen, found.schema).dropDuplicates(["doc_id"])
        of = {}
        for r in _features(found).toArrow().to_pylist():
            of[r["doc_id"]] = [np.frombuffer(r[c], np.float32) for c in ("text_view", "metadata_view")]
        out = []
        for k in (0, 1):
            for label in (1, 0):
                keys = chosen["key"][(chosen["k"] == k) & (chosen["label"] == label)].tolist()
                taken[1 - k].extend(keys)
                if keys:
                    out.append((1 - k, label, np.stack([of[x][1 - k] for x in keys])))
        return out

    return surest


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Learns from ``doc_id, text, lang, source, n_chars`` and ``doc_id, label``."""
    labels = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    labels = labels.groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    # labels of documents that are not there take no place in the sample
    labels = stored(labels.join(docs.select("doc_id"), "doc_id", "left_semi"))
    known = _share(labels, MOST_LABELLED)
    # the sample is bounded whatever the size of the tables
    labelled = docs.join(F.broadcast(known), "doc_id").select("doc_id", "label", "text", "lang", "source", "n_chars")
    labelled = once(labelled)
    found = _features(labelled).toArrow().to_pandas()
    weight = {r.doc_id: r.weight for r in known.collect()}
    found = found.sort_values(["doc_id", "label", "text_view"], ignore_index=True)
    views = [np.stack([np.frombuffer(x, np.float32) for x in found[c]]) if len(found) else np.empty((0, 1)) for c in ("text_view", "metadata_view")]
    fold = np.array([zlib.crc32(str(x).encode()) % 4 == 2 for x in found["doc_id"]], bool)
    y = found["label"].to_numpy(np.int64)
    each = np.array([weight[x] for x in found["doc_id"]], float)
    return cotrain(views, y, fold, _surest(docs, labels), weight=each)


def scores(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """Per row: ``doc_id, score, keep, text_score, metadata_score``."""
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select("doc_id", none.alias("score"), F.lit(True).alias("keep"), none.alias("text_score"), none.alias("metadata_score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            text, metadata, both = shared.value.score(*_both(batch))
            words = np.array([bool(x and not x.isspace()) for x in batch.column("text").to_pylist()])
            both = np.where(words, both, 0.0)
            columns = [batch.column("doc_id"), *map(pa.array, (both, words & (both >= least), text, metadata))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "keep", "text_score", "metadata_score"])

    schema = docs.select("doc_id").schema
    for name, kind in (("score", "double"), ("keep", "boolean"), ("text_score", "double"), ("metadata_score", "double")):
        schema = schema.add(name, kind)
    return docs.select("doc_id", "text", "lang", "source", "n_chars").mapInArrow(run, schema)


@query()
def op6_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return scores(docs, fit(docs, labels))
