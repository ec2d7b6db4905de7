import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import TEXTS, linked, quality, secrets

from nearfield.llm import cotraining, fingerprints, language_id, ngram_join, quality_rules, secret_scan


def loaded(spark, small):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_counts(spark, strained):
    df = strained.select("doc_id", "text", "score")
    got = quality_rules.judged(df)[0].collect()
    assert Counter(quality(r.text) for r in got) == Counter(quality(r.text) for r in df.collect())
    assert all(tuple(r[c] for c in BASE) == quality(r.text) for r in got)
    assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.quality_filter(strained).columns == strained.columns
    assert quality_rules.quality_filter(strained.limit(0)).count() == 0


def test_quality_names_may_clash(spark):
    df = spark.createDataFrame([(1, "the cat " * 30, 7, "k")], "doc_id long, text string, n_words long, kept string")
    row = quality_rules.judged(df)[0].first()
    assert row.n_words == 7 and row._n_words == 60 and row.kept == "k"


def test_quality_over_the_table(spark, small):
    docs = loaded(spark, small)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    clean = kept = 0
    for r in quality_rules.op4_quality_rules(spark, small).collect():
        assert tuple(r[c] for c in BASE) == quality(docs[r.doc_id])
        if labels.get(r.doc_id) == 1 and not r.base_failed:
            clean, kept = clean + 1, kept + r.kept
    assert kept == clean


def fixed(spans):
    return ",".join(x for x in spans.split(",") if not x.startswith("generic"))


def test_secrets(spark, strained, small):
    for df in (strained, spark.read.parquet(f"{small}/documents.parquet")):
        want = Counter((r.doc_id, secrets(r.text)) for r in df.collect())
        got = secret_scan.secret_scan(df).collect()
        assert Counter((r.doc_id, fixed(r.spans)) for r in got) == want
        assert all(hashlib.sha256(fixed(r.spans).encode()).hexdigest() == r.base_sha256 for r in got)
    assert secret_scan.secret_scan(strained.limit(0)).count() == 0


def test_secrets_of_one_owner_look_live(spark):
    own, copied = "Zx9" + "k7Q" * 8, "Ab1" + "m2R" * 8
    rows = [(1, f"see {own} here", "a"), (2, f"and {copied}", "a"), (3, f"or {copied} too", "b"), (4, f"again {own}", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.spans for r in secret_scan.secret_scan(df).collect()}
    assert got == {1: "generic:4:31", 2: "", 3: "", 4: "generic:6:33"}
    masked = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert masked[1] == "see [secret] here" and masked[2] == rows[1][1]


def test_secrets_by_owners_and_repositories(spark):
    example, mirrored = "Zx9" + "k7Q" * 8, "Ab1" + "m2R" * 8
    rows = [(i, f"see {example} in {i}", "hot") for i in range(secret_scan.MAX_REPOSITORIES + 1)]
    rows += [(1000, f"use {mirrored}", "a"), (1001, f"use {mirrored}", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.spans, r.counts) for r in secret_scan.secret_scan(df).collect()}
    assert got == {i: ("", "") for i, _, _ in rows[:-2]} | {i: ("generic:4:31", "2:2") for i in (1000, 1001)}
    masked = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert masked == {i: t for i, t, _ in rows[:-2]} | {i: "use [secret]" for i in (1000, 1001)}
    few = {r.doc_id: r.counts for r in secret_scan.secret_scan(df, max_repositories=200).collect()}
    assert few[0] == f"1:{secret_scan.MAX_REPOSITORIES + 1}"


def test_mask_covers_a_value_beyond_a_fixed_span(spark):
    value = "a1b2c3d4e5f6" * 2 + "XYZQRSTUVWXK9mn8PQ"
    df = spark.createDataFrame([(1, f"see {value} here", "a")], "doc_id long, text string, source string")
    row = secret_scan.secret_scan(df).first()
    assert row.n_hex == 1 and row.spans == "hex:4:28,generic:4:46"
    assert secret_scan.redact(df).first().text == "see [secret] here"


def test_many_spans_in_one_text(spark):
    text = "token=abcdef é" * 1500
    df = spark.createDataFrame([(1, text, "a", len(text))], "doc_id long, text string, source string, n_chars long")
    assert fixed(secret_scan.secret_scan(df).first().spans) == secrets(text)
    row = secret_scan.redact(df).first()
    assert row.text == "[secret] é" * 1500 and row.n_chars == len(row.text)


def test_redaction_keeps_columns_and_clean_rows(spark, strained):
    out = secret_scan.redact(strained)
    assert out.dtypes == strained.dtypes
    before = Counter(map(str, strained.filter("text NOT LIKE '%AKIA%' OR text IS NULL").collect()))
    after = Counter(map(str, out.filter("text NOT LIKE '%[secret]%' OR text IS NULL").collect()))
    assert before == after


def near(n, vocabulary=40, seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 10, 40, 150, 300]))] for _ in range(12)]
    out = []
    for _ in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(base[0] + w if rng.random() < 0.3 else w))
    return out


@pytest.mark.parametrize(("tile", "leaf", "members"), [(4096, 32, 4096), (12, 3, 5)])
def test_join_equals_brute_force(spark, monkeypatch, tile, leaf, members):
    for name, value in (("TILE", tile), ("FAMILY_TILE", tile), ("LEAF", leaf), ("MEMBERS", members)):
        monkeypatch.setattr(ngram_join, name, value)
    texts = near(250) + TEXTS + ["a b", "A  b", "a b c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df).collect()}
    assert got == dict(enumerate(linked(texts)))


@pytest.mark.parametrize(("n", "share"), [(5, 80), (2, 50), (9, 95)])
def test_join_of_any_shingles_and_share(spark, n, share):
    texts = near(150) + TEXTS
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df, words=n, share=(share, 100)).collect()}
    assert got == dict(enumerate(linked(texts, n, share)))


def test_trees_lose_no_pair():
    rng = np.random.default_rng(6)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 2**63, rng.integers(5, 200), dtype=np.uint64)
        for _ in range(8):
            kept = base[rng.random(len(base)) > rng.choice([0, 0.02, 0.1, 0.2])]
            sets.append(np.unique(np.append(kept, rng.integers(0, 2**63, rng.integers(0, 4), dtype=np.uint64))))
    n = np.array([len(s) for s in sets])
    sig = np.stack([np.frombuffer(ngram_join.signature(s), np.uint64) for s in sets])
    comp = np.arange(len(sets))
    want = {
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if ngram_join.links(len(np.intersect1d(sets[i], sets[j])), n[i], n[j])
    }
    def family(pairs):
        of = list(range(len(sets)))
        for a, b in pairs:
            of = [of[a] if x == of[b] else x for x in of]
        return of

    for side in (np.zeros(len(n), int), comp % 2):
        found = ngram_join.block_pairs(comp, n, comp, sig, side)
        of = family(found)
        assert len(found) < len(sets)
        assert all(of[a] == of[b] for a, b in want if not side.any() or side[a] != side[b])
        assert len(set(of)) > 20  # unlike sets stay apart
        got = family(ngram_join.family_links(comp, comp, sets, side))
        true = family(p for p in want if not side.any() or side[p[0]] != side[p[1]])
        assert all((got[a] == got[b]) == (true[a] == true[b]) for a in comp for b in comp[:a])
    exact = ngram_join.overlaps(sets[:40], sets[30:])
    assert all(exact[i, j] == len(np.intersect1d(sets[i], sets[30 + j])) for i in range(40) for j in range(0, 60, 7))


def test_one_of_each_group_stays(spark, strained):
    texts = near(120, seed=8)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, bare string")
    want = {c for _, c in linked(texts)}
    assert {r.doc_id for r in ngram_join.one_of_each(df).collect()} == want
    kept = ngram_join.one_of_each(strained)
    assert kept.columns == strained.columns
    # "a" and "A" are one, the repeated row goes, texts without words stay
    assert kept.count() == strained.count() - 2
    assert ngram_join.one_of_each(strained.limit(0)).count() == 0


def test_fingerprints_of_edited_texts(spark, small):
    docs = {k: v or "" for k, v in loaded(spark, small).items()}
    got = {r.doc_id: r for r in fingerprints.op3_fingerprints(spark, small).collect()}
    keys = sorted(docs)

    def parts(x):
        return {x[i : i + 8] for i in range(0, len(x), 8)}

    by_text = defaultdict(set)
    for k, after in zip(keys, keys[1:] + keys[:1]):
        text, q = docs[k], len(docs[k]) // 4
        edited = text[: len(text) - q] + docs[after][:q]
        assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[k].n_chars == len(text)
        for a, b, near_ in ((got[k].fingerprint, got[k].edited_fingerprint, got[k].near_edited), (got[k].fingerprint, got[after].fingerprint, got[k].near_next)):
            a, b = parts(a), parts(b)
            assert near_ == pytest.approx(len(a & b) / len(a | b) if a | b else 1)
        by_text[text].add(got[k].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    long = [r for r in got.values() if r.n_chars > 500]
    assert min(r.near_edited for r in long) > 0.1 and np.mean([r.near_edited for r in long]) > 0.4
    assert np.mean([r.near_next for r in long]) < 0.02


def test_closed_syncmers(spark):
    from pyspark.sql import functions as F

    rng = random.Random(7)
    text = " ".join(f"w{rng.randrange(9)}" for _ in range(200))
    df = spark.createDataFrame([(text,)], "t string")
    h = F.transform(F.split("t", " "), lambda x: F.xxhash64(x))
    (units, got) = df.select(h.alias("h"), fingerprints._syncmers(h, 8, 2).alias("s")).first()
    pairs = df.select(F.transform(F.sequence(F.lit(0), F.lit(198)), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1)))).first()[0]
    chosen = [i for i in range(193) if min(pairs[i : i + 7]) in (pairs[i], pairs[i + 6])]
    assert len(got) == len(chosen) < 193


def test_one_word_more_keeps_a_fingerprint(spark):
    from pyspark.sql import functions as F

    rows = [(n, " ".join(f"w{n}x{i}" for i in range(n))) for n in (20, 126, 127, 128, 400)]
    df = spark.createDataFrame(rows, "n long, t string").withColumn("more", F.concat("t", F.lit(" more")))
    near_ = fingerprints.likeness(fingerprints.anchors(F.col("t")), fingerprints.anchors(F.col("more")))
    assert min(r.near_ for r in df.select(near_.alias("near_")).collect()) > 0.9


def test_fingerprints_of_strained_texts(spark, strained):
    rows = fingerprints.fingerprints(strained).collect()
    assert len(rows) == strained.count()
    assert all((r.n_chars == 0) == (len(r.anchors) == 0) or not (r.edited or "").strip() for r in rows if r.doc_id != 2)
    assert fingerprints.fingerprints(strained.limit(0)).count() == 0
    assert fingerprints.fingerprints(strained.limit(1)).count() == 1


def brute_bits(model, rows, lang, text):
    """Code length by the definition, symbol by symbol."""
    blank, counts = int(model.symbol[32]), defaultdict(Counter)
    for _, t in (r for r in rows if r[0] == lang):
        x = [blank] * model.order + [int(model.symbol[b]) for b in t]
        for i in range(model.order, len(x)):
            for o in range(model.order + 1):
                counts[tuple(x[i - o : i])][x[i]] += 1
    total, x = 0.0, [blank] * model.order + [int(model.symbol[b]) for b in text]
    for i in range(model.order, len(x)):
        p = dict.fromkeys(range(model.n_symbols), 1 / model.n_symbols)
        for o in range(model.order + 1):
            c = counts[tuple(x[i - o : i])]
            n, kinds, left = sum(c.values()), len(c), sum(p[y] for y in p if y not in c)
            if n:
                kinds = kinds if left > 0 else 0
                p = {y: c[y] / (n + kinds) if y in c else kinds / (n + kinds) * p[y] / left for y in p}
        assert sum(p.values()) == pytest.approx(1)
        total -= math.log2(p[x[i]])
    return total


def test_code_lengths_equal_the_definition():
    rows = [("a", b"abracadabra abra"), ("b", b"hello world"), ("a", b"xx")]
    model = language_id.train(rows)
    texts = [b"abra world", b"z", b"hello abracadabra", b"qq"]
    starts = np.cumsum([0, *map(len, texts[:-1])])
    got = model.total_bits(np.frombuffer(b"".join(texts), np.uint8), starts)
    for i, t in enumerate(texts):
        for j, lang in enumerate(model.languages):
            assert got[i, j] == pytest.approx(brute_bits(model, rows, lang, t), abs=1e-3)


def test_blocks_of_one_text_add_up(monkeypatch):
    model = language_id.train([("a", b"abracadabra abra"), ("b", "\u043f\u0440\u0438\u0432\u0435\u0442".encode())])
    texts = [b"abra " * 7, b"x", "\u043f\u0440\u0438 abra".encode() * 5]
    data, starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts[:-1])])
    whole = model.total_bits(data, starts)
    for cells in (2, 6, 14, 46):
        monkeypatch.setattr(language_id, "BLOCK_CELLS", cells)
        assert np.allclose(model.total_bits(data, starts), whole)


ALIKE = {
    "ru": ["это был что который и не он", "ещё были дома когда они пришли", "что они не были этой"],
    "uk": ["це був що який і не він", "ще були вдома коли вони прийшли", "що вони не були цієї"],
    "zh": ["我们今天去学校学习中文", "他们在家里看书的时候", "我们在学校看书"],
    "ja": ["今日は学校に行きます。", "彼は家で本を読んでいました", "今日は家で本を読みます"],
}


def test_languages_of_one_script_are_told_apart():
    model = language_id.train([(k, x.encode()) for k, v in ALIKE.items() for x in v[:2] * 20])
    texts = [v[2] for v in ALIKE.values()]
    assert language_id.judge(model, pa.array(texts))[0] == list(ALIKE)


def test_scripts_that_were_not_learned_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs)
    texts = [x for v in ALIKE.values() for x in v] + ["η γλώσσα είναι", "اللغة العربية", "हिन्दी भाषा", "a😀😁" * 30]
    other = spark.createDataFrame([(x * 20,) for x in texts], "text string")
    assert language_id.language_filter(other, model).count() == 0
    assert language_id.language_filter(docs, model).count() >= 0.99 * docs.filter("text RLIKE '[a-z]'").count()


def test_long_documents_are_learned_from(spark):
    rows = [(i, "the cat sat on the mat and then it ran " * 4, "en") for i in range(40)]
    rows += [(100 + i, "привет мир " * 4000, "ru") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, most=1 << 14)
    assert model.languages == ["en", "ru"]
    assert len(language_id.judge(model, pa.array(["x" * 10]))[0]) == 1
    assert language_id.judge(model, pa.array(["мир привет"]))[0] == ["ru"]


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = language_id.op8_language_id(spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.99 * len(held)


def test_language_of_strained_texts(spark, strained):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit(docs)
    got = language_id.predict(strained, model)[0].collect()
    assert len(got) == strained.count()
    assert all(r.lang_pred == "und" and r._score == 0 for r in got if not any(map(str.isalpha, r.text or "")))
    assert language_id.language_filter(strained, model).columns == strained.columns
    assert language_id.predict(strained.limit(0), model)[0].count() == 0
    none = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.predict(strained, none)[0].collect()} == {"und"}


def test_classifier_on_its_held_out_fold(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = cotraining.op6_quality_classifier(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(labels[r.doc_id], r) for r in rows if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    good, bad = [r.score for y, r in held if y == 1], [r.score for y, r in held if y == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.85
    assert np.mean([r.keep for y, r in held if y == 1]) > 0.95


def test_classifier_edges(spark, strained):
    docs = strained.select("doc_id", "text", "lang", "source", "n_chars")
    labels = docs.selectExpr("doc_id", "1 AS label")
    assert cotraining.fit(docs, labels) is None
    assert {(r.score, r.keep) for r in cotraining.scores(docs, None).collect()} == {(None, True)}
    rng = np.random.default_rng(9)
    dims = (cotraining.TRIGRAMS + cotraining.RATIOS, cotraining.LANGUAGES + cotraining.SOURCES + 2)
    y = np.arange(80) % 2
    views = [rng.normal(size=(80, d)).astype(np.float32) + y[:, None] for d in dims]
    model = cotraining.cotrain(views, y, np.arange(80) % 4 > 1, views)
    rows = cotraining.scores(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 and not r.keep for r in rows if r.doc_id in (0, 1, 2))


def test_classifier_learns_a_rare_class(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(cotraining, "MOST_LABELLED", 100)
    bad = F.col("id") % 500 < 3
    text = F.when(bad, F.concat(F.lit("$$$ 1234 #### "), F.col("id"))).otherwise(F.concat(F.lit("the cat sat on a mat "), F.col("id")))
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length(text).cast("long").alias("n_chars"))
    labels = spark.range(12000).filter("id % 100 <> 0").select(F.col("id").alias("doc_id"), (~bad).cast("int").alias("label"))
    model = cotraining.fit(docs, labels)
    assert model is not None
    got = {r.doc_id: r.keep for r in cotraining.scores(docs, model).collect()}
    assert all(got[i] == (i % 500 >= 3) for i in got)


def test_surest_of_all_unlabelled_documents(spark):
    docs = spark.createDataFrame([(i, f"word {i} " * 3, "en", "s", 9) for i in range(300)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = docs.filter("doc_id % 10 <> 0").selectExpr("doc_id", "1 AS label")
    weights = [np.append(np.zeros(d), 9.0) for d in (cotraining.TRIGRAMS + cotraining.RATIOS, cotraining.LANGUAGES + cotraining.SOURCES + 2)]
    # copies of one row count once, and no row is chosen twice for one view
    surest = cotraining._surest(docs.unionAll(docs), labels)
    first, second = (surest(weights, {1: 20, 0: 20}) for _ in range(2))
    assert [(o, label, len(x)) for o, label, x in first] == [(1, 1, 20), (0, 1, 20)]
    assert [(o, label, len(x)) for o, label, x in second] == [(1, 1, 10), (0, 1, 10)]


def test_copies_under_many_ids_take_one_place(spark):
    rows = [(i, "the same words again", "en", "s", 20) for i in range(250)]
    rows += [(1000 + i, f"other words {i} " * 2, "en", "s", 30) for i in range(7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    labels = spark.createDataFrame([(-1, 1)], "doc_id long, label int")
    weights = [np.append(np.zeros(d), 9.0) for d in (cotraining.TRIGRAMS + cotraining.RATIOS, cotraining.LANGUAGES + cotraining.SOURCES + 2)]
    found = cotraining._surest(docs, labels)(weights, {1: 20, 0: 20})
    assert [(o, label, len(x)) for o, label, x in found] == [(1, 1, 8), (0, 1, 8)]
    text = next(x for o, _, x in found if o == 0)
    assert len(np.unique(text, axis=0)) == 8


def test_one_row_of_a_repeated_label_is_learned_from(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", "x"), (2, None, "y")] * 3, "doc_id long, text string, lang string")
    assert sorted(map(tuple, cotraining.once(df).collect())) == [(1, "a", "x"), (2, None, "y")]


def test_classifier_takes_an_empty_table(spark, strained):
    docs = strained.limit(0).select("doc_id", "text", "lang", "source", "n_chars")
    model = cotraining.fit(docs, docs.selectExpr("doc_id", "1 AS label"))
    assert model is None and cotraining.scores(docs, model).count() == 0


def test_components_of_any_shape(spark):
    rng = random.Random(10)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(30)]
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.cls: r.comp for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(find(a) == got.get(a, a) for a in parent)
