"""Op 3, quality rules: a table of thresholds compiled into one projection.

Method: every rule compares a ratio of measures of the text (length, symbols, stop words, lines)
with a bound. `compile_rules` turns the table into one boolean expression, so a text is measured
and judged in a single projection of built-in expressions: no user functions, no shuffle.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, table


class Threshold(NamedTuple):
    """`low <= scale * measure / of <= high`, in whole numbers; an open side is None. With
    `least_words`, shorter texts are not judged by this rule."""

    name: str
    measure: str
    of: str
    scale: int
    low: int | None
    high: int | None
    least_words: int = 0


# Bounds in the range of published web-text filters. Ratios are compared as whole numbers
# (scale * measure against bound * of), so no rounding decides.
THRESHOLDS = [
    Threshold("length", "n_words", "one", 1, 50, 100_000),
    Threshold("word_length", "word_chars", "n_words", 10, 25, 100),
    Threshold("symbols", "n_symbols", "n_words", 100, None, 30),
    Threshold("stop_words", "n_stop_words", "n_words", 100, 2, None),
    Threshold("duplicate_lines", "n_dup_lines", "n_lines", 100, None, 30),
]

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "for", "with", "was",
    "der", "die", "das", "und", "den", "von", "mit", "ist", "nicht", "ein",
    "le", "la", "les", "des", "et", "une", "est", "dans", "que", "pour",
    "el", "los", "las", "y", "en", "un", "por", "con", "del", "se",
]


# Each form of a stop word that a text may hold: lower case, capitalised, all upper case.
STOP_FORMS = sorted({f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())})


def single_spaced(text: Column) -> Column:
    """The words of a text with one space between them."""
    flat = F.replace(text, F.lit("\n"), F.lit(" "))
    irregular = [flat.contains(c) for c in ("  ", "\t", "\r", "\x0b", "\x0c")]
    irregular += [flat.startswith(" "), flat.endswith(" ")]
    return F.when(
        reduce(Column.__or__, irregular),
        F.btrim(F.regexp_replace(text, f"[{SPACES}]+", " "), F.lit(" ")),
    ).otherwise(flat)


def measures(texts: DataFrame, text: str = "text") -> DataFrame:
    """`texts` with the measures of the rules as long columns, in a few narrow projections."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(f"[^{SPACES}]"))
    symbols = F.regexp_replace(whole, r"[^#*$%&|<>]+", "")
    split = texts.select(
        "*",
        F.filter(F.split(single_spaced(whole), " "), lambda w: w != "").alias("_words"),
        lines.alias("_lines"),
        F.length(symbols).cast("long").alias("n_symbols"),
    )
    counted = split.select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size(F.filter("_words", lambda w: w.isin(STOP_FORMS))).cast("long").alias("n_stop_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    return (
        _repeated(counted).drop("_words", "_lines", "_hashes").withColumn("one", F.lit(1))
    )


# Bits of a number that hold a run's place; the others hold a part of its hash.
PLACE_BITS = 20


def _repeated(texts: DataFrame) -> DataFrame:
    """`n_repeat_words`: words covered by runs of three that the text holds twice or more.

    Most texts repeat nothing, which the number of distinct hashes of runs tells. In the others,
    numbers of hash bits and place are sorted; neighbours with the same hash bits are the same
    run, which their words confirm. Where they are not, or places do not fit, the runs themselves
    are sorted.
    """
    places = (1 << PLACE_BITS) - 1

    def run_hash(h: Column, i: Column) -> Column:
        return F.xxhash64(h, F.get(F.col("_hashes"), i + 1), F.get(F.col("_hashes"), i + 2))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit(places)).cast("int")

    def alike(x: Column, other: Column) -> Column:
        return F.coalesce(
            F.shiftright(x, PLACE_BITS) == F.shiftright(other, PLACE_BITS), F.lit(False)
        )

    def after(array: str, i: Column) -> Column:
        return F.get(F.col(array), i + 1)

    def before(array: str, i: Column) -> Column:
        return F.when(i > 0, F.get(F.col(array), i - 1))

    def differ(x: Column, other: Column) -> Column:
        word = [
            F.get(F.col("_words"), place(x) + k) != F.get(F.col("_words"), place(other) + k)
            for k in range(3)
        ]
        return reduce(Column.__or__, word)

    def repeats(x: Column, i: Column) -> Column:
        return alike(x, after("_packed", i)) | alike(x, before("_packed", i))

    def misled(x: Column, i: Column) -> Column:
        return alike(x, after("_packed", i)) & differ(x, after("_packed", i))

    def run(h: Column, i: Column) -> Column:
        return F.struct(F.concat_ws(" ", F.slice(F.col("_words"), i + 1, 3)).alias("run"), i.alias("at"))

    def run_repeats(x: Column, i: Column) -> Column:
        def same(other: Column) -> Column:
            return F.coalesce(other["run"] == x["run"], F.lit(False))

        return same(after("_ordered", i)) | same(before("_ordered", i))

    runs = F.when(
        F.size("_hashes") > 2,
        F.transform(F.slice("_hashes", F.lit(1), F.size("_hashes") - 2), run_hash),
    )
    packed = F.transform(
        "_runs", lambda h, i: h.bitwiseAND(F.lit(~places)).bitwiseOR(i.cast("long"))
    )
    some = texts.withColumn("_runs", runs).withColumn(
        "_packed",
        F.when(
            F.size(F.array_distinct("_runs")) < F.size("_runs"),
            F.when(F.size("_runs") <= places, F.sort_array(packed)).otherwise(F.array()),
        ),
    )
    confirmed = some.withColumn(
        "_ordered",
        F.when(
            (F.size("_packed") == 0) | F.exists(F.filter("_packed", misled), lambda x: F.lit(True)),
            F.sort_array(F.transform("_runs", run)),
        ),
    )
    at = confirmed.withColumn(
        "_at",
        F.when(
            F.col("_ordered").isNull(), F.transform(F.filter("_packed", repeats), place)
        ).otherwise(F.transform(F.filter("_ordered", run_repeats), lambda x: x["at"])),
    )
    covered = F.array_distinct(
        F.flatten(F.transform("_at", lambda at: F.array(at, at + 1, at + 2)))
    )
    return at.withColumn(
        "n_repeat_words", F.coalesce(F.size(covered), F.lit(0)).cast("long")
    ).drop("_runs", "_packed", "_ordered", "_at")


def compile_rules(thresholds: list[Threshold]) -> Column:
    """True where every rule holds. Rules over a measure that is zero hold."""

    def holds(rule: Threshold) -> Column:
        value, of = F.col(rule.measure) * rule.scale, F.col(rule.of)
        bounds = []
        if rule.low is not None:
            bounds.append(value >= rule.low * of)
        if rule.high is not None:
            bounds.append(value <= rule.high * of)
        fits = reduce(Column.__and__, bounds, F.lit(True)) | (of == 0)
        return fits if not rule.least_words else fits | (F.col("n_words") < rule.least_words)

    return reduce(Column.__and__, [holds(rule) for rule in thresholds], F.lit(True))


def judge_quality(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    thresholds: list[Threshold] = THRESHOLDS,
) -> DataFrame:
    """Measures and verdict of every row: `key`, the measures, `base_failed` and `kept`.

    The base rule fails texts of under 50 words, and texts more than half of whose words stand in
    repeated runs of three. `kept` needs the base rule and every threshold. Null and empty texts
    have no words and fail. Rows are kept as they are, repeated ones too; other columns of
    `documents` are not read.
    """
    texts = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measures(texts, "_text").select(
        F.col("_key").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_stop_words",
        "n_lines",
        failed.alias("base_failed"),
        (~failed & compile_rules(thresholds)).alias("kept"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))


_STOPS = ", ".join(f"'{w}'" for w in STOP_FORMS)

SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT r, doc_id, text,
         list_filter(regexp_split_to_array(text, '[{SPACES}]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{SPACES}]')) AS lines
  FROM texts
), runs AS (
  SELECT r, i, words[i:i + 2] AS run
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM runs) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT place) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM repeated) GROUP BY r
), measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(words, lambda w: w IN ({_STOPS}))) AS BIGINT) AS n_stop_words,
         CAST(len(lines) AS BIGINT) AS n_lines
  FROM split LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT *, NOT base_failed AND n_words BETWEEN 50 AND 100000
       AND 10 * word_chars BETWEEN 25 * n_words AND 100 * n_words
       AND 100 * n_symbols <= 30 * n_words
       AND 100 * n_stop_words >= 2 * n_words
       AND 100 * n_dup_lines <= 30 * n_lines AS kept
FROM judged
"""
