"""Quality rules: a table of thresholds that becomes one Spark projection.

Measures are built-in expressions over the words and lines of a whole text; every rule of the
table bounds one of them. Nothing is shuffled and no user function runs.

A text of null, or without a word, has no words: all counts are 0 and it fails. A null bound is
open. Repeated rows are judged alike; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import GAP, documents, filtered, query, unused, words

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"

#: Frequent words of the languages that the rules are meant for.
STOP_WORDS = (
    "the of and to in is that was for it with as on be at by this from are or an a not "
    "le la les de des du et un une que qui en est dans pour par sur pas au ce il elle "
    "der die das und ist den dem von zu mit ein eine nicht auf für im sich "
    "el los las y se del con no es por su una lo como más o"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure`` per ``per`` has to lie within the bounds, both included."""

    name: str
    measure: str
    per: str | None
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("mean word length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.2),
    Rule("words with a letter", "n_letter_words", "n_words", 0.6, None),
    Rule("stop words", "n_stop_words", "n_words", 0.01, None),
    Rule("different words", "n_unique_words", "n_words", 0.02, None),
    Rule("capitals", "n_capitals", "word_chars", None, 0.4),
    Rule("repeated lines", "n_dup_lines", "n_lines", None, 0.5),
)


def measured(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """The rows with the measures in further columns; the columns' names by measure.

    Arrays are columns of their own between the steps, each used more than once by the next, so
    that the optimizer leaves them there instead of computing them anew inside a lambda.
    """
    own = list(docs.columns)
    w, h, g, lines, ends = unused(docs, "words", "hashes", "windows", "lines", "starts")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    names += ("n_letter_words", "n_stop_words", "n_unique_words", "n_capitals", "n_lines")
    to = dict(zip(names, unused(docs, *names), strict=True))
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in own]

    df = docs.select(
        *kept,
        words(F.col(f"`{text}`")).alias(w),
        F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(lines),
    )
    df = df.select(
        *kept,
        w,
        F.size(w).cast("long").alias(to["n_words"]),
        F.length(F.array_join(w, "")).cast("long").alias(to["word_chars"]),
        F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias(to["n_symbols"]),
        F.size(lines).cast("long").alias(to["n_lines"]),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias(to["n_dup_lines"]),
        F.transform(w, lambda x: F.xxhash64(x)).alias(h),
    )
    stops = [form for x in STOP_WORDS for form in dict.fromkeys((x, x.capitalize(), x.upper()))]
    many = F.size(h) >= WINDOW
    df = df.select(
        *kept,
        *(to[n] for n in names[:4]),
        to["n_lines"],
        F.size(F.array_distinct(h)).cast("long").alias(to["n_unique_words"]),
        F.size(F.filter(w, lambda x: x.isin(stops))).cast("long").alias(to["n_stop_words"]),
        F.regexp_count(F.array_join(w, " "), F.lit(r"(?<![^ ])[^ \p{L}]*\p{L}"))
        .cast("long")
        .alias(to["n_letter_words"]),
        F.regexp_count(whole, F.lit(r"\p{Lu}")).cast("long").alias(to["n_capitals"]),
        F.when(
            many,
            F.transform(
                F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)),
                lambda i: F.xxhash64(F.slice(h, i, WINDOW)),
            ),
        ).alias(g),
    )
    # where some window of words comes back: starts of all windows that do, ascending
    again = F.size(F.array_distinct(g)) < F.size(g)
    pairs = F.sort_array(F.arrays_zip(F.col(g).alias("g"), F.sequence(F.lit(0), F.size(g) - 1).alias("i")))
    df = df.select(
        *kept,
        *(to[n] for n in names if n != "n_repeat_words"),
        F.when(again, pairs).alias(ends),
    )
    return _covered(df, kept, [to[n] for n in names if n != "n_repeat_words"], ends, to["n_repeat_words"]), to


def _covered(df, kept, done, pairs, out) -> DataFrame:
    """Adds how many words lie in windows that come back."""

    def key(i):
        return F.get(F.col(pairs), i)["g"]

    n = F.size(pairs)
    starts = F.sort_array(
        F.transform(
            F.filter(
                F.sequence(F.lit(0), n - 1),
                lambda i: (key(i) == key(i - 1)) | (key(i) == key(i + 1)),
            ),
            lambda i: F.get(F.col(pairs), i)["i"],
        )
    )
    df = df.select(
        *kept,
        *done,
        F.when(F.col(pairs).isNotNull() & (n > 0), starts).alias(pairs),
    )
    reach = F.aggregate(
        F.col(pairs),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + (s + WINDOW) - F.greatest(s, a["end"])).cast("long").alias("n"),
            (s + WINDOW).cast("int").alias("end"),
        ),
    )["n"]
    return df.select(
        *kept,
        *done,
        F.coalesce(reach, F.lit(0)).cast("long").alias(out),
    )


def failed(columns: dict[str, str]) -> Column:
    """The fixed base: too short, or too much of it repeated."""
    n, again = F.col(columns["n_words"]), F.col(columns["n_repeat_words"])
    return (n < 20) | (100 * again > 30 * n)


def passes(columns: dict[str, str], rules: Sequence[Rule] = RULES) -> Column:
    """One condition for the whole table of rules."""
    ok = F.lit(True)
    for rule in rules:
        value = F.col(columns[rule.measure]).cast("double")
        if rule.per:
            value = F.try_divide(value, F.col(columns[rule.per]).cast("double"))
        if rule.least is not None:
            ok = ok & F.coalesce(value >= rule.least, F.lit(False))
        if rule.most is not None:
            ok = ok & F.coalesce(value <= rule.most, F.lit(False))
    return ok


def judged(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES):
    """The rows with measures, ``base_failed`` and ``kept``; the names of these columns."""
    df, names = measured(docs, text)
    base, kept = unused(df, "base_failed", "kept")
    df = df.withColumn(base, failed(names))
    df = df.withColumn(kept, ~F.col(base) & passes(names, rules))
    return df, names | {"base_failed": base, "kept": kept}


def quality_filter(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    df, names = judged(docs, text, rules)
    return filtered(df, F.col(names["kept"])).select(*(F.col(f"`{c}`") for c in docs.columns))


def _rule_sql(rule: Rule) -> str:
    value = f"{rule.measure} / {rule.per}" if rule.per else rule.measure
    bounds = [f"{value} >= {rule.least}"] if rule.least is not None else []
    bounds += [f"{value} <= {rule.most}"] if rule.most is not None else []
    return " AND ".join(f"coalesce({x}, false)" for x in bounds)


SQL = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - {WINDOW - 2}),
    lambda i: {{'i': i, 's': array_to_string(w[i:i + {WINDOW - 1}], ' ')}}), recursive := true) FROM texts),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM again) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(t, '{SYMBOLS}')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
    len(list_filter(w, lambda x: list_contains({[f for x in STOP_WORDS for f in dict.fromkeys((x, x.capitalize(), x.upper()))]}, x))) AS n_stop_words,
    len(list_distinct(w)) AS n_unique_words, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_capitals,
    len(l) AS n_lines, coalesce(n, 0) AS n_repeat_words
  FROM texts LEFT JOIN covered USING (doc_id)),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND {" AND ".join(map(_rule_sql, RULES))} AS kept FROM failed
"""


@query(SQL)
def op4_quality_rules(spark, sf_dir):
    df, _ = judged(documents(spark, sf_dir).select("doc_id", "text"))
    return df.drop("text")
