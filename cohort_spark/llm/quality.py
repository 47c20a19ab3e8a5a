"""Quality rules with cutoffs learned per language and source.

Texts are measured in integers.  Each (language, source) keeps, for every measure, a quantile sketch: counts in log-linear
buckets whose edges are at most 1/16 of the value apart.  Sketches are merged by adding counts, so those of a
language, or of everything, come from the same rows; a source with few texts uses the merged sketch of its language.
A cutoff lies beyond the upper (or below the lower) quantile by a multiple of the distance between the quantile and the median.
The cutoffs are joined to the measured texts, which are filtered by them.  All of it is DataFrame work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohort_spark.llm.store import kept

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent
LEAST_TEXTS = 200
FINE = 4  # bits below the leading one that tell buckets apart


@dataclass(frozen=True)
class Measure:
    """``per`` parts of a thousand of what; ``quantile`` and ``reach`` place the cutoff, ``slack`` is the least distance."""

    name: str
    value: str
    quantile: float
    reach: int
    slack: int
    upper: bool = True


MEASURES = (
    Measure("symbols", "1000 * n_symbols div greatest(word_chars, 1)", 0.75, 4, 50),
    Measure("word_length", "100 * word_chars div greatest(n_words, 1)", 0.75, 4, 200),
    Measure("short_words", "100 * word_chars div greatest(n_words, 1)", 0.25, 4, 200, upper=False),
    Measure("repeats", "1000 * n_repeat_words div greatest(n_words, 1)", 0.75, 4, 300),
    Measure("dup_lines", "1000 * n_dup_lines div greatest(n_lines, 1)", 0.75, 4, 500),
)


def _pairs(column: str, f) -> Column:
    """``f`` of each two neighbours of an array."""
    c = F.col(column)
    n = F.greatest(F.size(c) - 1, F.lit(0))
    return F.zip_with(F.slice(c, 1, n), F.slice(c, 2, n), f)


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words); null texts are empty.

    A word is repeated if it lies in a window of three words found twice or more in its text.  The windows' hashes, with
    the place in their low bits, are sorted; neighbours of equal hash whose words are equal too are found twice.  Each place covers
    the words up to the next one, three at most.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", "lang", "source", text.alias("t"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD))
    places = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(F.size("w")))) - 1
    word = lambda i: F.element_at("w", i)

    def hashed(i: Column) -> Column:
        return F.xxhash64(word(i), word(i + 1), word(i + 2)).bitwiseAND(F.col("high")).bitwiseOR(i.cast("bigint"))

    windows = F.when(F.size("w") > 2, F.sort_array(F.transform(F.sequence(F.lit(1), F.size("w") - 2), hashed)))
    counted = words.withColumn("high", F.bitwise_not(places)).select(
        "doc_id",
        "lang",
        "source",
        "w",
        F.bitwise_not("high").alias("low"),
        F.size("w").cast("bigint").alias("n_words"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
        F.coalesce(windows, F.expr("cast(array() as array<bigint>)")).alias("s"),
    )
    near = F.filter(_pairs("s", lambda a, b: F.when(a.bitwiseXOR(b) <= F.col("low"), F.struct(a.alias("a"), b.alias("b")))), lambda x: x.isNotNull())
    near = counted.withColumn("near", F.transform(near, lambda x: F.struct(*[x[c].bitwiseAND(F.col("low")).cast("int").alias(c) for c in "ab"])))
    same = lambda x: (word(x["a"]) == word(x["b"])) & (word(x["a"] + 1) == word(x["b"] + 1)) & (word(x["a"] + 2) == word(x["b"] + 2))
    equal = F.transform(F.filter("near", same), lambda x: F.array(x["a"], x["b"]))
    placed = near.withColumn("p", F.sort_array(F.array_distinct(F.flatten(equal))))
    covered = F.aggregate(_pairs("p", lambda a, b: F.least(F.lit(3), b - a)), F.lit(3), lambda acc, x: acc + x)
    return placed.select(
        "doc_id",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("p") == 0, F.lit(0)).otherwise(covered).cast("bigint").alias("n_repeat_words"),
    )


def bucket(value: Column) -> Column:
    """The lower edge of the bucket of a non-negative integer: its leading ``FINE + 1`` bits."""
    shift = F.greatest(F.length(F.bin(value)) - (FINE + 1), F.lit(0))
    return F.expr("0").cast("bigint") + F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(measured: DataFrame) -> DataFrame:
    """Counts per (lang, source, measure, bucket): the mergeable quantile sketches."""
    values = F.array(*[F.struct(F.lit(m.name).alias("measure"), F.expr(m.value).cast("bigint").alias("value")) for m in MEASURES])
    long = measured.where("n_words > 0").select("lang", "source", F.explode(values).alias("x"))
    return long.groupBy("lang", "source", F.col("x.measure").alias("measure"), bucket(F.col("x.value")).alias("bucket")).agg(
        F.count("*").alias("n")
    )


def quantile_cutoffs(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., measure, texts, cutoff) from sketches merged over everything but ``keys``."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = W.partitionBy(*keys, "measure")
    running = merged.select(
        *keys,
        "measure",
        "bucket",
        F.sum("n").over(group.orderBy("bucket")).alias("upto"),
        F.sum("n").over(group).alias("texts"),
    )
    def of(f) -> Column:
        return F.coalesce(*[F.when(F.col("measure") == m.name, f(m)) for m in MEASURES])

    def at(part: Column) -> Column:
        return F.min(F.when(F.col("upto") >= part * F.col("texts"), F.col("bucket")))

    found = running.groupBy(*keys, "measure").agg(
        F.max("texts").alias("texts"),
        at(F.lit(0.5)).alias("median"),
        at(of(lambda m: F.lit(m.quantile))).alias("edge"),
    )
    apart = F.abs(F.col("edge") - F.col("median"))
    reach = F.greatest(of(lambda m: F.lit(m.reach)) * apart, of(lambda m: F.lit(m.slack)))
    cutoff = of(lambda m: F.col("edge") + reach if m.upper else F.col("edge") - reach)
    return found.select(*keys, "measure", "texts", cutoff.cast("bigint").alias("cutoff"))


def cutoffs(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): a cutoff per measure, from the narrowest merge that has ``LEAST_TEXTS`` texts."""
    own = quantile_cutoffs(sketch, ["lang", "source"]).withColumnsRenamed({"texts": "n1", "cutoff": "c1"})
    lang = quantile_cutoffs(sketch, ["lang"]).select(
        F.col("lang").alias("l2"), F.col("measure").alias("m2"), F.col("texts").alias("n2"), F.col("cutoff").alias("c2")
    )
    every = quantile_cutoffs(sketch, []).select(F.col("measure").alias("m3"), F.col("cutoff").alias("c3"))
    both = own.join(lang, F.col("lang").eqNullSafe(F.col("l2")) & (F.col("measure") == F.col("m2")))
    both = both.join(every, F.col("measure") == F.col("m3"))
    cutoff = F.when(F.col("n1") >= LEAST_TEXTS, F.col("c1")).when(F.col("n2") >= LEAST_TEXTS, F.col("c2")).otherwise(F.col("c3"))
    return both.groupBy("lang", "source").agg(*[F.max(F.when(F.col("measure") == m.name, cutoff)).alias(f"{m.name}_cut") for m in MEASURES])


def judge(docs: DataFrame) -> DataFrame:
    """Measures and verdicts per row of ``docs`` (doc_id, text, lang, source; other columns are ignored).

    ``base_failed``: fewer than 50 words, or more than half of them repeated.  ``kept``: not that, and within all cutoffs of
    the text's language and source; null languages and sources are groups like any other.  Null and empty texts fail.
    An empty table gives no rows.
    """
    measured = kept(measure(docs))
    cuts = cutoffs(kept(sketches(measured))).withColumnsRenamed({"lang": "__lang", "source": "__source"})
    joined = measured.join(cuts, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left")
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    within = F.lit(True)
    for m in MEASURES:
        value, cut = F.expr(m.value), F.col(f"{m.name}_cut")
        within = within & ((value <= cut) if m.upper else (value >= cut))
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & F.coalesce(within, F.lit(False))).alias("kept"),
        *[f"{m.name}_cut" for m in MEASURES],
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that fail; rows are matched by id and text."""
    marked = docs.withColumn("__hash", F.xxhash64("text"))
    good = judge(marked.withColumn("doc_id", F.struct("doc_id", "__hash"))).where("kept").select("doc_id.*").distinct()
    good = good.withColumnsRenamed({"doc_id": "__id", "__hash": "__good"})
    return marked.join(good, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__good")), "left_semi").drop("__hash")
