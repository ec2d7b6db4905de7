"""Document fingerprints of closed syncmers, in built-in expressions.

A text is read in units: words, or pieces of ``UNIT`` characters of longer ones. Of every run of
``k`` units (a k-mer) the hashes of its shorter runs of ``s`` units (s-mers) are compared; the k-mer
is an anchor if the least of them lies at its first or last place. Whether a k-mer is an anchor
depends on its own units alone, so two texts that share a passage share its anchors wherever it
stands. A fingerprint lists the anchors in text order, eight hexadecimal digits each; likeness is the
share of common ones among all anchors of both. Texts of every length have the same one scale, so a
small edit changes few anchors whatever the number of units; a text without any anchor has the hash
of all its units as its only one.

Null text reads as empty: an empty fingerprint, alike to another empty one (1) and to nothing else
(0). In the order of documents null ids come first, and rows with the same id and text share one
place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearfield.llm.common import bind, documents, query, stored

UNIT = 16
#: Units of a k-mer and of its s-mers.
SCALE = (3, 1)


def _syncmers(h: Column, k: int, s: int) -> Column:
    """Hashes of the closed syncmers among the k-mers of hashed units, in order."""
    inner = k - s + 1

    def anchors(m):
        def closed(i):
            edge = F.least(F.get(m, i), F.get(m, i + (inner - 1)))
            rest = [F.get(m, i + j) for j in range(1, inner - 1)]
            return edge <= (F.least(*rest) if len(rest) > 1 else rest[0])

        places = F.filter(F.sequence(F.lit(0), F.size(m) - inner), closed)
        covering = [*range(0, inner, s)]
        return F.transform(
            places, lambda i: F.shiftright(F.xxhash64(*(F.get(m, i + j) for j in covering)), 32).cast("int")
        )

    runs = F.sequence(F.lit(0), F.size(h) - s)
    smers = h if s == 1 else F.transform(runs, lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(s))))
    none = F.array().cast("array<int>")
    return F.when(F.size(h) >= k, bind(smers, anchors)).otherwise(none)


def anchors(text: Column) -> Column:
    """Distinct anchors of a text that is not null, in the order in which they first occur."""
    units = F.regexp_extract_all(text, F.lit(rf"[^\x20\x09-\x0D]{{1,{UNIT}}}"), F.lit(0))
    none = F.array().cast("array<int>")

    def of(h):
        whole = F.array(F.shiftright(F.xxhash64(h), 32).cast("int"))
        return bind(
            F.array_distinct(_syncmers(h, *SCALE)),
            lambda a: F.when(F.size(a) > 0, a).when(F.size(h) > 0, whole).otherwise(none),
        )

    return bind(F.transform(units, lambda x: F.xxhash64(x)), of)


def fingerprint(a: Column) -> Column:
    """Anchors as text."""
    return F.array_join(
        F.transform(a, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(0xFFFFFFFF))), 8, "0")), ""
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of common anchors among all of two."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def neighbours(docs: DataFrame) -> DataFrame:
    """Per place in the order of ``doc_id, content``: the places after and before it.

    Only ids, hashes and lengths are sorted. The ends of the sorted partitions, one row each, are
    all that is brought together.
    """
    keys = docs.groupBy("doc_id", "content").agg(F.min("n_chars").alias("n_chars"))
    keys = stored(keys.repartitionByRange("doc_id", "content").withColumn("part", F.spark_partition_id()))
    place = F.struct("doc_id", "content", "n_chars")
    ends = keys.groupBy("part").agg(F.min(place).alias("head"), F.max(place).alias("tail"))
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "part",
        F.coalesce(F.lead("head").over(order), F.first("head").over(whole)).alias("head"),
        F.coalesce(F.lag("tail").over(order), F.last("tail").over(whole)).alias("tail"),
    )
    within = Window.partitionBy("part").orderBy("doc_id", "content")
    return (
        keys.select("*", F.lead(place).over(within).alias("next"), F.lag(place).over(within).alias("last"))
        .join(F.broadcast(ends), "part")
        .select(
            "doc_id",
            F.xxhash64("doc_id").alias("place"),
            F.col("content").alias("place_content"),
            F.coalesce("next", "head").alias("next"),
            F.coalesce("last", "tail").alias("last"),
        )
    )


def fingerprints(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """Per row: its text and edited text with their anchors, and the anchors of the next document.

    The edited text has the last quarter replaced by as much from the start of the next document.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("content")
    )
    order = stored(neighbours(rows.select("doc_id", "content", F.length("text").alias("n_chars"))))

    # both joins and the grouping between them are on these two, and the id comes with the place:
    # so both uses of the texts need the same columns, and one shuffle serves them; it goes without
    # anchors, which are larger than short texts and are found on either side of it
    here = (F.col("key") == F.col("place")) & (F.col("content") == F.col("place_content"))
    rows = rows.select(F.xxhash64("doc_id").alias("key"), "content", "text")
    rows = rows.join(order, here).withColumn("anchors", anchors(F.col("text"))).drop("place", "place_content")
    # what the document before needs from this one: the start of its text, and its anchors
    given = (
        rows.select(
            F.xxhash64("last.doc_id").alias("place"),
            F.col("last.content").alias("place_content"),
            F.expr("substring(text, 1, CAST(floor(last.n_chars / 4) AS INT))").alias("start"),
            F.col("anchors").alias("next_anchors"),
        )
        .groupBy("place", "place_content")
        .agg(F.first("start").alias("start"), F.first("next_anchors").alias("next_anchors"))
    )
    rows = rows.join(given, here, "left")
    n = F.length("text")
    edited = F.concat(F.expr("substring(text, 1, length(text) - CAST(floor(length(text) / 4) AS INT))"), "start")
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "anchors", "next_anchors", edited.alias("edited"))
    return rows.withColumn("edited_anchors", anchors(F.col("edited")))


@query()
def op3_fingerprints(spark, sf_dir):
    rows = fingerprints(documents(spark, sf_dir))
    a, b, c = F.col("anchors"), F.col("edited_anchors"), F.col("next_anchors")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(a).alias("fingerprint"),
        fingerprint(b).alias("edited_fingerprint"),
        likeness(a, b).alias("near_edited"),
        likeness(a, c).alias("near_next"),
    )
