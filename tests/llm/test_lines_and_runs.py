import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from cases import LOWER, TEXTS, words

from check_oracles import compare, connect
from nearfield.llm import line_dedup, periodic_runs

GAP = " \t\n\x0b\x0c\r"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


# ----------------------------------------------------------------------- runs


def runs(w, least=6):
    """Every run, straight from its definition."""
    found = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i + q - start
            part = w[start : start + length]
            smallest = all(any(part[k] != part[k + d] for k in range(length - d)) for d in range(1, q))
            if length >= max(least, 4 * q) and smallest:
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def digest(doc_id, text):
    w = words(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs(w)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(found), *tail, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(collapsed(w, found))


def loops(n, seed=3):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            unit = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
            parts += (unit * 9)[: rng.randrange(1, 9 * len(unit) + 1)]
        out.append(" ".join(parts))
    return out + ["a " * k for k in (5, 6, 7, 1000)] + ["x y " * 200 + "x", "a b a b a b a b c " * 8]


def by_rows(df):
    return Counter((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in df.collect())


@pytest.mark.parametrize("block", [1, 1 << 21])
def test_runs_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(periodic_runs, "BLOCK_BYTES", block)
    texts = loops(300) + TEXTS
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = Counter()
    for i, t in enumerate(texts):
        found = runs(words(t))
        want[i, tuple(found), collapsed(words(t), found)] += 1
    assert by_rows(periodic_runs.periodic_runs(df)) == want


def test_runs_of_strained_rows(spark, strained):
    got = periodic_runs.periodic_runs(strained)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    want = Counter()
    for r in strained.collect():
        found = runs(words(r.text))
        want[r.doc_id, tuple(found), collapsed(words(r.text), found)] += 1
    assert by_rows(got) == want
    assert periodic_runs.periodic_runs(strained.limit(0)).count() == 0
    renamed = strained.selectExpr("doc_id AS runs", "text AS collapsed", "doc_id")
    assert periodic_runs.periodic_runs(renamed, text="collapsed").count() == strained.count()


def test_long_periods_and_other_bounds():
    rng = random.Random(1)
    unit = [rng.randrange(50) for _ in range(3000)]
    key = np.array([60, *unit * 5, 61], np.int64)
    assert periodic_runs.Factors(key).runs(6, 4).tolist() == [[1, 15000, 3000]]
    assert periodic_runs.Factors(key).runs(6, 6).tolist() == []


def test_run_query(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    some = 0
    for r in periodic_runs.op11_periodic_runs(spark, small).collect():
        assert tuple(r)[1:] == digest(r.doc_id, docs[r.doc_id])
        some += r.n_runs > 0
    assert some > 5


# ---------------------------------------------------------------------- lines


def key(line):
    return line.strip(GAP).translate(LOWER)


def deduped(rows, least=20, documents=3, keep=max):
    """``(doc_id, text) -> (n_lines, n_dropped, kept)`` in the order of the rows."""
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                held[key(line)].add(i)
    keeper = {k: keep(x for x in ids if x is not None) for k, ids in held.items() if len(ids) >= documents}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if keeper.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return Counter(out)


def lines_of(df):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect())


def lined(n, seed=2):
    rng = random.Random(seed)
    pool = [f"A line that {'é' * (i % 9)} comes back, number {i}" for i in range(60)] + ["short", "", " ", "x" * 19, "ß" * 20]
    dress = [str, str.upper, lambda x: f"  {x}\t", lambda x: f"\r{x}\r", lambda x: f"\xa0{x}"]
    rows = [(i, "\n".join(rng.choice(dress)(rng.choice(pool)) for _ in range(rng.randrange(1, 9)))) for i in range(n)]
    return rows + [(None, rows[0][1]), (None, rows[1][1]), (3, rows[5][1]), (3, rows[5][1]), (n, None)]


@pytest.mark.parametrize(("bits", "gathered"), [(28, 1 << 21), (16, 1 << 21), (16, 5), (20, 0)])
def test_lines_equal_brute_force(spark, monkeypatch, bits, gathered):
    monkeypatch.setattr(line_dedup, "GATHERED", gathered)
    rows = lined(120) + list(enumerate(TEXTS, 1000))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert lines_of(line_dedup.line_dedup(df, bits=bits)) == deduped(rows)


def test_lines_by_other_bounds(spark):
    rows = [r for r in lined(60) if r[0] is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = line_dedup.line_dedup(df, least=3, least_documents=2, keep="smallest")
    assert lines_of(got) == deduped(rows, 3, 2, min)


def test_lines_keep_other_columns(spark, strained):
    clash = strained.selectExpr("*", "1 AS n_lines", "'k' AS keys", "'d' AS dropped_id")
    got = line_dedup.line_dedup(clash, least_documents=2)
    assert got.columns == [*clash.columns, "_n_lines", "n_dropped"]
    assert Counter(map(str, got.select("lang", "score", "part").collect())) == Counter(
        map(str, clash.select("lang", "score", "part").collect())
    )
    want = deduped([(r.doc_id, r.text) for r in strained.collect()], documents=2)
    assert Counter((r.doc_id, r._n_lines, r.n_dropped, r.text or "") for r in got.collect()) == want
    assert line_dedup.line_dedup(strained.limit(0)).count() == 0
    assert {r.text for r in got.filter("text IS NULL OR doc_id = 1").collect()} == {None}


def test_only_suspects_are_shuffled(spark):
    rows = [(i, f"line number {i} is only here and nowhere else\nbut this line is in every document") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    met = line_dedup.suspects(df, "doc_id", "text", 20, 28)
    assert {r.key for r in met.collect()} == {"but this line is in every document"} and met.count() == 500


def test_filter_misses_no_repeat(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(f"a line of number {rng.randrange(400):020}" for _ in range(4))) for i in range(300)]
    seen = Counter(x for _, t in rows for x in set(t.split("\n")))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    bitmap = line_dedup.twice_seen(df, bits=16)
    hashed = line_dedup.hashes(pa.array([k for k, n in seen.items() if n > 1]))
    for at in line_dedup.places(hashed, 16):
        assert (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).all()


def test_line_query(spark, small):
    query = line_dedup.op13_line_dedup
    assert compare(spark, connect(small), query, line_dedup.SQL, small) is None
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = Counter((i, n, gone, sha(t)) for i, n, gone, t in deduped(rows).elements())
    assert Counter(map(tuple, query(spark, small).collect())) == want
