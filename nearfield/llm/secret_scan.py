"""Secret scan: spans that look like credentials, and who else in the corpus has the same value.

Three fixed kinds are always reported: assignments, access keys and hex strings. A fourth, strings
that mix letters and digits, is common in harmless text. Its values are counted over the whole
corpus first. A value that several owners use in texts that differ, or that very many repositories hold
whoever owns them, is a copied example and is left out; one that stays with its owner, or with the
mirrored copies of a single text, looks live and is reported. A repository is a document id of an owner.
The same counts mark every fixed span as live or copied.

Only built-in expressions run. Patterns look at text that can hold a match at all; the corpus-wide
counts shuffle 64-bit hashes of values, never text, and combine before the shuffle.

Null text reads as empty: no spans, the digest of the empty string. A null owner counts as one
owner of its own. Repeated rows are scanned alike and count as one repository.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import bind, documents, filtered, query, stored, unused

ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# whole runs, so that the bound on the length can stand in the pattern
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
GENERIC = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "generic")

#: A value that more owners use than this, in texts that differ, is a copied example,
MAX_OWNERS = 1
#: and so is one that more repositories hold than this.
MAX_REPOSITORIES = 100
BLOCK = 256


def _running(lengths: Column) -> Column:
    """Sums of the elements up to each, in blocks so that the work stays near linear."""

    def within(part, start):
        return F.aggregate(
            part,
            F.struct(start.alias("at"), F.array().cast("array<long>").alias("all")),
            lambda a, x: bind(
                a["at"] + x, lambda e: F.struct(e.alias("at"), F.concat(a["all"], F.array(e)).alias("all"))
            ),
        )["all"]

    def over(x):
        blocks = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int"))
        sums = F.transform(
            blocks,
            lambda b: F.aggregate(F.slice(x, b * BLOCK + 1, BLOCK), F.lit(0).cast("long"), lambda a, y: a + y),
        )
        return bind(
            sums,
            lambda s: F.flatten(
                F.transform(
                    blocks,
                    lambda b: within(
                        F.slice(x, b * BLOCK + 1, BLOCK),
                        F.aggregate(F.slice(s, 1, b), F.lit(0).cast("long"), lambda a, y: a + y),
                    ),
                )
            ),
        )

    return bind(lengths, over)


def _matches(text: Column, pattern: str, kind: int, may: Column, value, ok) -> Column:
    """Spans of the matches that pass ``ok``, as structs in order of their start."""
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:bigint>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def spans(m):
        ends = _running(F.zip_with(gaps, m, lambda g, x: (F.length(g) + F.coalesce(F.length(x), F.lit(0))).cast("long")))
        return F.transform(
            F.filter(F.arrays_zip(m.alias("m"), ends.alias("e")), lambda x: x["m"].isNotNull() & ok(x["m"])),
            lambda x: F.struct(
                (x["e"] - F.length(x["m"])).alias("start"),
                F.lit(kind).alias("kind"),
                x["e"].alias("end"),
                F.xxhash64(value(x["m"])).alias("value"),
            ),
        )

    return F.when(may & text.rlike(pattern), bind(found, spans)).otherwise(none)


def _whole(m: Column) -> Column:
    return m


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds, by start and kind."""
    value = lambda m: F.regexp_extract(m, ASSIGN, 2)
    return F.sort_array(
        F.concat(
            _matches(text, ASSIGN, 0, F.contains(text, F.lit(":")) | F.contains(text, F.lit("=")), value, lambda m: F.length(value(m)) >= 6),
            _matches(text, ACCESS, 1, F.contains(text, F.lit("AKIA")), _whole, lambda m: F.lit(True)),
            _matches(text, HEX, 2, F.lit(True), _whole, lambda m: F.lit(True)),
        )
    )


def generic_spans(text: Column) -> Column:
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    return _matches(text, GENERIC, 3, F.lit(True), _whole, mixed)


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def scanned(docs: DataFrame, doc_id="doc_id", text="text", owner="source") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, content, owner, base, extra``.

    ``content`` tells texts under one id apart; ``extra`` holds generic spans that are not within a
    fixed one. Those that go beyond one stay, so that a mask covers the union.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.xxhash64(whole).alias("content"),
        F.xxhash64(F.col(f"`{owner}`").cast("string")).alias("owner"),
        base_spans(whole).alias("base"),
        generic_spans(whole).alias("extra"),
    )
    apart = F.filter(
        "extra",
        lambda x: ~F.exists("base", lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"])),
    )
    return df.withColumn("extra", apart)


def ownership(spans: DataFrame) -> DataFrame:
    """Per hash of a value: how many repositories and owners have it, and whether their texts differ."""
    lo, hi = F.min("lo").alias("lo"), F.max("hi").alias("hi")
    return (
        spans.groupBy("value", "owner", "doc_id")
        .agg(F.min("content").alias("lo"), F.max("content").alias("hi"))
        .groupBy("value", "owner")
        .agg(F.count("*").alias("n_repositories"), lo, hi)
        .groupBy("value")
        .agg(F.sum("n_repositories").alias("n_repositories"), F.count("*").alias("n_owners"), lo, hi)
        .select("value", "n_owners", "n_repositories", (F.col("lo") < F.col("hi")).alias("differ"))
    )


def judged(rows: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Per id and content with spans: ``of, of_content, told``, each span with its verdict and counts."""
    spans = rows.filter((F.size("base") > 0) | (F.size("extra") > 0)).select(
        "doc_id", "content", "owner", F.explode(F.concat("base", "extra")).alias("span")
    )
    spans = spans.select("doc_id", "content", "owner", "span", F.col("span.value").alias("value"))
    copied = ((F.col("n_owners") > max_owners) & F.col("differ")) | (F.col("n_repositories") > max_repositories)
    live = ownership(spans).select("value", (~copied).alias("live"), "n_owners", "n_repositories")
    # the value's verdict returns to its documents; one value may be in a third of them, and the
    # join has its rows on the one side only, so that Spark can split them
    return (
        spans.join(live, "value")
        .groupBy(F.col("doc_id").alias("of"), F.col("content").alias("of_content"))
        .agg(F.collect_set(F.struct("span", "live", "n_owners", "n_repositories")).alias("told"))
    )


def _added(told: Column) -> Column:
    """The generic spans that look live."""
    return F.transform(F.filter(told, lambda t: (t["span"]["kind"] == 3) & t["live"]), lambda t: t["span"])


def secret_scan(
    docs: DataFrame, doc_id="doc_id", text="text", owner="source", max_owners=MAX_OWNERS, max_repositories=MAX_REPOSITORIES
):
    """Per row: counts of the fixed kinds, all spans, and how many of them look live or copied.

    ``counts`` has owners and repositories of the value of each of ``spans``, in the same order.
    """
    rows = stored(scanned(docs, doc_id, text, owner))
    told = judged(rows, max_owners, max_repositories)
    # each row has its spans once, whatever others share its id
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("content") == F.col("of_content"))
    df = rows.join(told, same, "left").select("doc_id", "base", "told")
    added = _added(F.col("told"))
    every = F.sort_array(F.concat("base", F.coalesce(added, F.filter("base", lambda x: F.lit(False)))))
    listed = F.sort_array(F.filter("told", lambda t: (t["span"]["kind"] < 3) | t["live"]))
    counts = F.transform(listed, lambda t: F.concat_ws(":", t["n_owners"], t["n_repositories"]))
    kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    fixed = lambda live: F.coalesce(
        F.size(F.filter("told", lambda t: (t["span"]["kind"] < 3) & (t["live"] == live))), F.lit(0)
    ).cast("long")
    return df.select(
        "doc_id",
        kind(0).alias("n_assign"),
        kind(1).alias("n_access"),
        kind(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(every).alias("spans"),
        fixed(True).alias("n_live"),
        fixed(False).alias("n_copied"),
        F.coalesce(F.array_join(counts, ","), F.lit("")).alias("counts"),
    )


def redact(docs: DataFrame, doc_id="doc_id", text="text", owner="source", n_chars="n_chars", mask="[secret]"):
    """The documents with every span replaced; rows without spans are as they were.

    Overlapping spans become one mask. A length that was known is counted anew. Columns are those of
    ``docs``; null texts stay null.
    """
    content, told, spans = unused(docs, "content", "told", "spans")
    rows = scanned(docs, doc_id, text, owner)
    rows = filtered(rows, (F.size("base") > 0) | (F.size("extra") > 0))
    some = judged(stored(rows)).select(
        F.col("of").alias("_of"),
        F.col("of_content").alias("_of_content"),
        F.sort_array(
            F.concat(
                _added(F.col("told")),
                F.transform(F.filter("told", lambda t: t["span"]["kind"] < 3), lambda t: t["span"]),
            )
        ).alias(spans),
    )
    whole = F.col(f"`{text}`")
    key = F.xxhash64(F.coalesce(whole, F.lit("")))
    df = docs.withColumn(content, key).join(
        some, F.col(f"`{doc_id}`").eqNullSafe(F.col("_of")) & (F.col(content) == F.col("_of_content")), "left"
    )
    none = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    masked = F.aggregate(
        F.col(spans),
        none,
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= a["at"],
                F.concat(a["out"], F.substring(whole, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mask)),
            )
            .otherwise(a["out"])
            .alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring(whole, (a["at"] + 1).cast("int"), F.length(whole))),
    )
    found = F.size(F.coalesce(F.col(spans), F.array())) > 0
    df = df.withColumn(told, F.when(found, masked).otherwise(whole))
    new = {text: F.col(told)}
    if n_chars in docs.columns:
        length = F.when(found & F.col(n_chars).isNotNull(), F.length(told)).otherwise(F.col(n_chars))
        new[n_chars] = length.cast(docs.schema[n_chars].dataType)
    return df.select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


@query()
def op5_secret_scan(spark, sf_dir):
    return secret_scan(documents(spark, sf_dir))
