import base64
import hashlib
import os
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as vocabularies
import pytest
import tiktoken

os.environ["TOKENIZERS_PARALLELISM"] = "false"
from cases import TEXTS  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from nearfield.llm import packing, token_files  # noqa: E402
from nearfield.llm.common import new_path  # noqa: E402
from nearfield.llm.duck_bpe import LONG_STEPS, DuckBpe, encode_decode, op7_byte_bpe  # noqa: E402
from nearfield.llm.token_count import op10_token_counts, token_counts  # noqa: E402
from nearfield.llm.word_ids import WordIds, with_end  # noqa: E402

JSON, RANKS, CLIP = (vocabularies.path(x) for x in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))


def library(path, texts):
    got = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids for e in got]


def loaded(spark, small):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def mixed(seed, n):
    rng = np.random.default_rng(seed)
    parts = ["'", "s", "re", "'ll", " ", "  ", "\n", "\t", "a", "Z", "é", "1", "²", "!", ".", ",", "_", "　", "中", "😀", "́", "<|endoftext|>", " the", "ing", "\x1c", "\x85", "\x00", "\x01", "aaaa", "----", "ß"]
    return ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("path", [JSON, CLIP])
def test_pieces_give_the_ids_of_whole_texts(path):
    texts = [t or "" for t in TEXTS] + mixed(1, 3000)
    encode = WordIds(path, most=500)
    for _ in range(2):  # the second time the memory starts anew
        ids, ends = encode(texts)
        starts = np.append(0, ends[:-1])
        assert [ids[a:b].tolist() for a, b in zip(starts, ends)] == library(path, texts)
    ids, ends = with_end(ids, ends, 1)
    assert (ids[ends - 1] == 1).all() and len(ids) == ends[-1]


def test_counts_equal_the_library(spark, strained):
    got = token_counts(strained, JSON).collect()
    texts = strained.select("doc_id", "text").collect()
    want = [(r.doc_id, len((r.text or "").encode()), n) for r, n in zip(texts, map(len, library(JSON, [r.text for r in texts])))]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_bytes, r.n_tokens)) for r in got)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert token_counts(strained.limit(0), JSON).count() == 0


def test_counts_of_mixed_texts():
    from nearfield.llm import token_count

    texts = mixed(2, 4000)
    count = token_count.Counter(JSON)
    assert count(texts).tolist() == list(map(len, library(JSON, texts)))
    token_count.MAX_STATES, before = 50, token_count.MAX_STATES
    try:
        assert count(texts).tolist() == list(map(len, library(JSON, texts)))
    finally:
        token_count.MAX_STATES = before


def test_counts_over_the_table(spark, small):
    docs = loaded(spark, small)
    want = dict(zip(docs, map(len, library(JSON, docs.values()))))
    assert {r.doc_id: r.n_tokens for r in op10_token_counts(spark, small).collect()} == want


def test_codes_are_directly_addressable():
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 2**k, 3000) for k in (4, 8, 9, 16, 17, 31)]).astype("<u4")
    rng.shuffle(ids)
    codes = token_files.Codes(token_files.encode_ids(ids))
    at = rng.integers(0, len(ids), 5000)
    assert (codes.get(at) == ids[at]).all() and len(codes) == len(ids)
    for a, b in np.sort(rng.integers(0, len(ids), (40, 2))).tolist():
        assert (codes.slice(a, b) == ids[a:b]).all()
    assert len(token_files.Codes(token_files.encode_ids(ids[:0])).slice(0, 0)) == 0


def test_token_files_round_trip(spark, strained):
    folder = new_path(spark)
    token_files.write_token_files(strained, folder, CLIP)
    got = token_files.read_token_files(spark, folder).orderBy("start").collect()
    source = strained.select("doc_id", "text").collect()
    source.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
    want, at = [], 0
    for r, ids in zip(source, library(CLIP, [r.text for r in source])):
        want.append((r.doc_id, at, np.array([*ids, 1], "<u4").tobytes()))
        at += len(ids) + 1
    assert [(r.doc_id, r.start, bytes(r.ids)) for r in got] == want
    empty = new_path(spark)
    token_files.write_token_files(strained.limit(0), empty, CLIP)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_token_files_over_the_table(spark, small):
    docs, at = loaded(spark, small), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.op2_token_files(spark, small).collect()}
    for key, ids in zip(sorted(docs), library(CLIP, [docs[k] for k in sorted(docs)])):
        raw = np.array([*ids, 1], "<u4").tobytes()
        assert got[key] == (at, len(ids) + 1, zlib.crc32(raw))
        at += len(ids) + 1


def check_pieces(rows, texts, share):
    """``rows`` cover ``texts`` (by id) without gaps, in sequences of at most 2048 with little padding."""
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for key, ids in zip(texts, library(JSON, texts.values())):
        ids, at = np.array([*ids, 1], "<u4"), 0
        for r in sorted(by[key], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    padded = used = 0
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        used, padded = used + at, padded + packing.padding(at)
    assert padded <= share * used


def test_packing_over_the_table(spark, small):
    check_pieces(packing.op9_packing(spark, small).collect(), loaded(spark, small), 0.03)


def test_packing_of_strained_texts(spark, strained):
    from pyspark.sql import functions as F

    df = strained.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.pack(df, JSON).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(rows, {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}, 1)
    assert packing.pack(strained, JSON).select("doc_id").distinct().count() == len(TEXTS) + 1
    assert packing.pack(strained.limit(0), JSON).count() == 0


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(4)
    for _ in range(40):
        ends = np.cumsum(rng.integers(1, 40, 30))
        penalty = rng.choice([0, packing.IN_DOCUMENT, packing.IN_SENTENCE], 30)
        length, at = 64, [0, *ends.tolist()]
        best = [0] + [None] * 30
        for j in range(1, 31):
            best[j] = min(
                best[i] + packing.padding(at[j] - at[i], length) + packing.PER_SEQUENCE + int(penalty[j - 1])
                for i in range(j)
                if at[j] - at[i] <= length
            )
        cuts = packing.choose_cuts(ends, penalty, length)
        cost, start = 0, 0
        for c in cuts:
            size = int(ends[c]) - start
            assert size <= length
            cost, start = cost + packing.padding(size, length) + packing.PER_SEQUENCE + int(penalty[c]), int(ends[c])
        # starts at small powers of two are not tried, so a little may be left
        assert best[30] <= cost and cuts[-1] == 29


def test_duckdb_merges_equal_the_library():
    bpe = DuckBpe(RANKS, vocabularies.PATTERN)
    own = tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=bpe.rank, special_tokens={})
    texts = [t or "" for t in TEXTS] + mixed(5, 1500)
    ids, ends = bpe.encode(texts)
    starts = np.append(0, ends[:-1])
    assert [ids[a:b].tolist() for a, b in zip(starts, ends)] == [own.encode_ordinary(t) for t in texts]
    assert bpe.decode(ids, ends) == [t.encode() for t in texts]
    words = list({w.encode() for t in texts for w in bpe.words_of(t)})
    flat, count = bpe._merged(words, LONG_STEPS)
    at = np.cumsum(count) - count
    for w, a, n in zip(words, at, count):
        if w not in bpe.rank:
            assert flat[a : a + n].tolist() == own._encode_single_piece(w)


def test_byte_bpe_over_the_table(spark, small):
    docs, bpe = loaded(spark, small), DuckBpe(RANKS, vocabularies.PATTERN)
    own = tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=bpe.rank, special_tokens={})
    for r in op7_byte_bpe(spark, small).collect():
        ids = own.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_bpe_of_very_long_words_and_after_a_failure():
    rng = np.random.default_rng(6)
    long = [
        "a" * 300_000,
        "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 100_000)),
        "".join(map(chr, rng.integers(0x4E00, 0x9FA5, 60_000))),
        "ab" * 1500 + " tail " + "xyzw" * 600,
    ]
    ranks = dict(line.split() for line in open(RANKS, "rb"))
    ranks = {base64.b64decode(k): int(v) for k, v in ranks.items()}
    want = tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe = DuckBpe(RANKS, vocabularies.PATTERN)
    for text in long:
        ids, ends = bpe.encode([text, "after it"])
        assert ids.tolist() == [*want.encode_ordinary(text), *want.encode_ordinary("after it")]
        assert bpe.decode(ids, ends) == [text.encode(), b"after it"]
    with pytest.raises(Exception, match="no_such_table"):
        bpe._merged([b"abc"], "SELECT * FROM words, no_such_table")
    ids, ends = bpe.encode(["still at work"])
    assert bpe.decode(ids, ends) == [b"still at work"]


def test_bpe_of_nulls_repeated_rows_and_clashing_names(spark, strained):
    got = encode_decode(strained.selectExpr("*", "1 AS ids", "2 AS decoded"), RANKS, vocabularies.PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    want = sorted((str(r.doc_id), (r.text or "").encode()) for r in strained.collect())
    rows = got.collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in rows) == want
    assert all(len(r.ids) == 4 * r.n_tokens for r in rows)
    assert encode_decode(strained.limit(0), RANKS, vocabularies.PATTERN).count() == 0
