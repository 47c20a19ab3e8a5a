"""Secrets in texts: fixed patterns, and strings that look random to a pair of character models.

The models are first-order Markov chains over characters, one of random strings and one of ordinary identifiers.  A
candidate is a run of at least ``CANDIDATE`` characters of the key alphabet; it is a secret if the log-likelihood ratio of
the two models, per transition, reaches ``RATIO``.  Both are trained on labelled strings of the corpus itself: values that
the fixed patterns find are random, other long words are ordinary.  All of it is DataFrame work; the model is a table of
128 * 128 integers (thousandths of a nat) that reaches the scan as a constant.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns and least lengths of the base rules.
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6

KINDS = ["assign", "access", "hex", "random"]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = 20
RATIO = 700
ORDINARY = r"[A-Za-z0-9+/_=-]{8,}"
RANDOM_TOKEN = r"[A-Za-z0-9+/_=-]{%d,}" % CANDIDATE


def _placed(text: Column, pattern: str, kind: int, value: Column | None = None) -> Column:
    """(start, kind, end) of all matches; ``value`` (one entry per match) must have the least length of an assignment.

    The text between matches and the matches themselves alternate, so a start is a sum of lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    lengths = F.transform(found, lambda m: F.length(m))
    values = lengths if value is None else F.transform(value, lambda v: F.length(v))
    parts = F.arrays_zip(F.transform(between, lambda b: F.length(b)).alias("b"), lengths.alias("m"), values.alias("v"))
    none = F.expr("cast(array() as array<struct<start: bigint, kind: int, end: bigint>>)")
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["b"]
        end = start + part["m"]
        span = F.struct(start.cast("bigint").alias("start"), F.lit(kind).alias("kind"), end.cast("bigint").alias("end"))
        keep = part["m"].isNotNull() & ((part["v"] >= ASSIGN_LEAST) if value is not None else F.lit(True))
        out = F.when(keep, F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(F.coalesce(end, start).cast("bigint").alias("at"), out.alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(parts, zero, step)["out"]).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, each kind leftmost and without overlap, in order of start and kind."""
    value = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1))
    kinds = [_placed(text, ASSIGN, 0, value), _placed(text, ACCESS, 1), _placed(text, HEX, 2)]
    return F.sort_array(F.concat(*kinds))


def labelled_strings(docs: DataFrame) -> DataFrame:
    """(string, random) of all documents: values of the fixed patterns, and other words of 8 characters and more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    secret = F.concat(
        F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)), lambda v: F.length(v) >= ASSIGN_LEAST),
        F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    )
    rest = text
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    both = docs.select(F.array_distinct(secret).alias("s"), F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0)).alias("o"))
    return both.select(F.explode("s").alias("string"), F.lit(True).alias("random")).unionByName(
        both.select(F.explode("o").alias("string"), F.lit(False).alias("random"))
    )


def train(strings: DataFrame) -> list[int]:
    """The table of log-likelihood ratios: entry ``128 * a + b`` is for character ``b`` after ``a``.

    Transitions are counted in Spark; at most one row per pair of characters and label reaches the driver.  Random
    strings are half a uniform chain, so alphabets that the strings lack count as random too; ordinary ones are smoothed.
    """
    pairs = strings.select("random", F.explode(F.transform(F.sequence(F.lit(1), F.length("string") - 1), lambda i: F.substring("string", i, 2))).alias("pair"))
    counts = {(r["pair"], r["random"]): r["n"] for r in pairs.groupBy("pair", "random").agg(F.count("*").alias("n")).collect()}
    rows = {label: {a: sum(counts.get((a + b, label), 0) for b in ALPHABET) for a in ALPHABET} for label in (True, False)}
    uniform, table = 1 / len(ALPHABET), [0] * (128 * 128)
    for a in ALPHABET:
        for b in ALPHABET:
            seen = counts.get((a + b, True), 0) / rows[True][a] if rows[True][a] else uniform
            random = 0.5 * uniform + 0.5 * seen
            ordinary = (counts.get((a + b, False), 0) + 1) / (rows[False][a] + len(ALPHABET))
            table[128 * ord(a) + ord(b)] = round(1000 * math.log(random / ordinary))
    return table


def model_spans(text: Column, base: Column, table: list[int], ratio: int = RATIO) -> Column:
    """Spans of candidates that the models take for random and that touch no base span."""
    model = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")

    def random(span: Column) -> Column:
        token = F.substring(text, span["start"].cast("int") + 1, (span["end"] - span["start"]).cast("int"))
        codes = F.transform(F.split(token, ""), lambda c: F.ascii(c))
        pairs = F.zip_with(codes, F.slice(codes, 2, F.greatest(F.size(codes), F.lit(1))), lambda a, b: a * 128 + b + 1)
        total = F.aggregate(F.filter(pairs, lambda p: p.isNotNull()), F.lit(0), lambda acc, p: acc + F.element_at(model, p))
        return total >= ratio * (F.size(codes) - 1)

    free = F.filter(_placed(text, RANDOM_TOKEN, 3), lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.filter(free, random)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def scan(docs: DataFrame, table: list[int] | None = None) -> DataFrame:
    """``docs`` with ``base`` and ``found``: spans (start, kind, end) of the fixed patterns, and those with the models' added.

    Positions are code points, ends exclusive; ``kind`` is a place in ``KINDS``.  Null and empty texts have no spans;
    columns named ``base`` or ``found`` are replaced.  Without a ``table`` the models are fitted on ``docs``.
    """
    table = table if table is not None else train(labelled_strings(docs))
    text = F.coalesce(F.col("text"), F.lit(""))
    with_base = docs.drop("base", "found").withColumn("base", base_spans(text))
    return with_base.withColumn("found", F.sort_array(F.concat(F.col("base"), model_spans(text, F.col("base"), table))))


def report(docs: DataFrame, table: list[int] | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans) per row of ``docs``."""
    spans = scan(docs.select("doc_id", "text"), table)

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    counts = [count(kind) for kind in range(len(KINDS))]
    return spans.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def mask(docs: DataFrame, mark: str = "[SECRET]", table: list[int] | None = None) -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark``; all other columns as they were."""
    table = table if table is not None else train(labelled_strings(docs))
    found = scan(docs.select(F.struct("*").alias("row"), "text"), table)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring("text", (state["at"] + 1).cast("int"), F.greatest(span["start"] - state["at"], F.lit(0)).cast("int"))
        out = F.when(span["start"] >= state["at"], F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    done = F.aggregate("found", start, step)
    rest = F.substring("text", (done["at"] + 1).cast("int"), F.length("text"))
    masked = F.when(F.size("found") > 0, F.concat(done["out"], rest))
    found = found.withColumn("text", F.coalesce(masked, F.col("text")))
    return found.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
