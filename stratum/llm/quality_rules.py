"""Quality rules with adaptive thresholds (operator 3).

Each document's counts become ratios in thousandths.  For each language and
source a quantile sketch of every ratio is kept: counts by bucket, with
buckets of ten thousandths (of a hundred from 1,000 on, growing by a
thousandth part each from 91,100 on, without a last one), so a sketch is
bounded by the logarithm of its greatest ratio, sketches merge by adding
counts, and the result does not depend on how rows are dealt.  A ratio's fence is the median plus ``SPREAD`` times the
distance from the median to the upper quartile (for word lengths also to the
lower one), and at least the floor of the ratio away.  Sketches of fewer than
``MIN_ROWS`` documents are replaced by their language's, then by the sketch
of all rows.  Documents are joined to the fences of their group; one outside
a fence is rejected.

Rows: a null text has no words; a null language or source is a group of its
own; a null or repeated ``doc_id`` is kept, each row by itself; an empty
table gives no rows; other columns pass through ``kept_documents`` untouched.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.stage import staged

SPREAD = 8
MIN_ROWS = 100
MIN_WORDS = 50

#: Ratio -> (numerator, denominator, least distance of a fence from the median, in thousandths)
RATIOS = {
    "symbols": ("n_symbols", "n_words", 150),
    "dup_lines": ("n_dup_lines", "n_lines", 300),
    "repeats": ("n_repeat_words", "n_words", 250),
    "capitals": ("n_capitals", "word_chars", 200),
    "word_length": ("word_chars", "n_words", 3000),
}

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
_WHITE = b" \t\n\x0b\x0c\r"
_CAPITALS = bytes(range(0x41, 0x5B))
_SYMBOLS = b"#*$%&|<>"


def text_counts(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for a whole text."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    lines = Counter(line for line in data.split(b"\n") if line.strip(_WHITE))
    grams = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(grams)) < len(grams):
        seen, end = Counter(grams), 0
        for i, g in enumerate(grams):
            if seen[g] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return (n, len(text) - (len(data) - len(data.translate(None, _WHITE))), len(data) - len(data.translate(None, _SYMBOLS)),
            sum(lines.values()) - len(lines), repeated, sum(lines.values()), len(data) - len(data.translate(None, _CAPITALS)))


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def counts_of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for part in texts:
        yield pd.DataFrame([text_counts(t) for t in part], columns=list(COUNTS), dtype="int64")


# else Spark copies it into a filter on the counts, and each task counts twice, in two Python workers that stay
counts_of = counts_of.asNondeterministic()


def ratio(name: str) -> Column:
    """In thousandths, rounded down; 0 if there is nothing to divide by."""
    top, bottom, _ = RATIOS[name]
    return F.when(F.col(bottom) > 0, F.floor(1000 * F.col(top) / F.col(bottom))).otherwise(0).cast("long")


#: Buckets up to ``EVEN`` are of even width and end before ``EVEN_END`` thousandths; each one after it is wider by the factor ``GROWTH``.
EVEN, EVEN_END, GROWTH = 1000, 91_100, 1.001


def _bucket(v: Column) -> Column:
    return F.when(v < 1000, F.floor(v / 10)).when(v < EVEN_END, 100 + F.floor((v - 1000) / 100)).otherwise(
        EVEN + 1 + F.floor(F.log(v / EVEN_END) / math.log(GROWTH))).cast("int")


def _value(bucket: Column) -> Column:
    """The upper end of a bucket."""
    return F.when(bucket < 100, 10 * bucket + 9).when(bucket <= EVEN, 1000 + 100 * (bucket - 100) + 99).otherwise(
        F.ceil(EVEN_END * F.pow(F.lit(GROWTH), bucket - EVEN)) - 1).cast("long")


def fences(counted: DataFrame) -> DataFrame:
    """``lang, source`` and each ratio's ``_low`` and ``_high`` limit, from documents with ``COUNTS``."""
    long = counted.where("n_words > 0").select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(n).alias("ratio"), _bucket(ratio(n)).alias("bucket")) for n in RATIOS])).alias("x")).select("lang", "source", "x.*")
    # ``every`` is the one key of the sketch of all rows
    sketch = staged(long.groupBy("lang", "source", "ratio", "bucket").agg(F.count("*").alias("n"), F.lit(0).alias("every")), "sketches")
    groups = sketch.select("lang", "source", "every").distinct()
    levels = []
    for keys in (("lang", "source"), ("lang",), ("every",)):
        merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
        w = Window.partitionBy(*keys, "ratio")
        ranked = merged.withColumn("all", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("bucket")))
        quantile = {q: F.min(F.when(F.col("upto") >= F.col("all") * q, _value(F.col("bucket")))) for q in (0.25, 0.5, 0.75)}
        limits = ranked.groupBy(*keys, "ratio").agg(F.max("all").alias("rows"), quantile[0.25].alias("q1"), quantile[0.5].alias("q2"), quantile[0.75].alias("q3"))
        floor = F.coalesce(*[F.when(F.col("ratio") == n, F.lit(r[2])) for n, r in RATIOS.items()])
        limits = limits.select(*keys, "rows", "ratio", (F.col("q2") + F.greatest(SPREAD * (F.col("q3") - F.col("q2")), floor)).alias("high"),
                               (F.col("q2") - F.greatest(SPREAD * (F.col("q2") - F.col("q1")), floor)).alias("low"))
        wide = limits.groupBy(*keys).agg(F.max("rows").alias("rows"), *[
            F.max(F.when(F.col("ratio") == n, F.col(end))).alias(f"{n}_{end}") for n in RATIOS for end in ("high", "low")])
        levels.append(wide)
    names = [f"{n}_{end}" for n in RATIOS for end in ("high", "low")]
    exact, by_lang, overall = (d.select(*[F.col(c).alias(f"{c}_{i}") for c in d.columns]) for i, d in enumerate(levels))
    out = groups.join(exact, F.col("lang").eqNullSafe(F.col("lang_0")) & F.col("source").eqNullSafe(F.col("source_0")))
    out = out.join(by_lang, F.col("lang").eqNullSafe(F.col("lang_1"))).join(overall, F.col("every") == F.col("every_2"))
    return out.select("lang", "source", *[
        F.when(F.col("rows_0") >= MIN_ROWS, F.col(f"{c}_0")).when(F.col("rows_1") >= MIN_ROWS, F.col(f"{c}_1")).otherwise(F.col(f"{c}_2")).alias(c) for c in names])


def _verdicts(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """``counted`` with ``base_failed`` and ``kept``."""
    limits = limits.select(F.col("lang").alias("__l"), F.col("source").alias("__s"), *[F.col(c).alias(f"__{c}") for c in limits.columns[2:]])
    joined = counted.join(limits, counted["lang"].eqNullSafe(F.col("__l")) & counted["source"].eqNullSafe(F.col("__s")), "left")
    outside = F.lit(False)
    for n in RATIOS:
        outside = outside | (ratio(n) > F.col(f"__{n}_high"))
    outside = outside | (ratio("word_length") < F.col("__word_length_low"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & ~F.coalesce(outside, F.lit(False))).drop(
        *[c for c in limits.columns])


def _counted(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "lang", "source", counts_of(F.col("text").cast("string")).alias("m")).select("doc_id", "lang", "source", "m.*")


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """A row for each document: its counts, ``base_failed`` and ``kept``."""
    counted = staged(_counted(docs), "counts")
    out = _verdicts(counted, staged(fences(counted), "fences"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns."""
    limits = staged(fences(staged(_counted(docs), "counts")), "fences")
    rows = docs.select(F.struct(*docs.columns).alias("__doc"), "lang", "source", counts_of(F.col("text").cast("string")).alias("__m"))
    return _verdicts(rows.select("__doc", "lang", "source", "__m.*"), limits).where("kept").select("__doc.*")
