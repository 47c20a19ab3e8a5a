"""Text summaries of entities: header line and one line per variable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.numeric import two_decimals
from cohort_spark.operators.reshape import melt
from cohort_spark.plans.chunks import CHUNK_HOURS, CHUNK_ROWS, attach, chunks, number_rows

# The variables a summary mentions, its wording and the trend marks.
SUMMARY_VARIABLES = ["HCO3", "HCT", "HR", "Mg", "Na", "Temp", "BUN", "FiO2", "GCS", "K"]
HEADER_STATISTICAL = ("Patient is a ", "-year-old ", ". Over the first 48 hours:")
HEADER_TREND = ("Patient is a ", "-year-old ", ", weights ", " kg. Over the first 48 hours:")
LINE_STATISTICAL = ("- ", " ranged from ", " to ", ", avg: ", ", last: ")
LINE_TREND = ("- ", " ranged from ", " to ", ", shows a trend of ", ". avg: ", ", last: ")
RISING, FALLING, FLAT, MIXED, UNKNOWN = "↑", "↓", "→", "~", "unknown"
FLAT_STEP = 0.1
FEWEST_FOR_TREND = 3


def trend_mark(n: Column, first: Column, second: Column, third: Column) -> Column:
    """Trend of the means of three thirds; a missing mean compares false."""
    rising = F.coalesce((first < second) & (second < third), F.lit(False))
    falling = F.coalesce((first > second) & (second > third), F.lit(False))
    flat = (F.abs(first - second) < FLAT_STEP) & (F.abs(second - third) < FLAT_STEP)
    return (
        F.when(n < 2, UNKNOWN)
        .when(rising, RISING)
        .when(falling, FALLING)
        .when(F.coalesce(flat, F.lit(False)), FLAT)
        .otherwise(MIXED)
    )


def trend_labels(
    df: DataFrame,
    cols: Sequence[str],
    entity: str = "entity_id",
    ts: str = "ts",
    chunk_hours: float | None = CHUNK_HOURS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Per entity and variable: readings, range, mean, last value and the trend over thirds of the readings.

    Thirds are cut by position among the non-null readings, at n div 3 and 2n div 3.
    """
    long = melt(df, [entity, ts], cols).where(F.col("value").isNotNull())
    placed = number_rows(long, [entity, "variable"], [ts], "__at", chunks(chunk_hours, chunk_rows), total="n")
    stats = long.groupBy(entity, "variable").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.avg("value").alias("mean"),
        F.max_by("value", ts).alias("last"),
    )
    place, n = F.col("__at") - 1, F.col("n")
    one, two = F.floor(n / 3), F.floor(2 * n / 3)
    thirds = placed.groupBy(entity, "variable").agg(
        F.avg(F.when(place < one, F.col("value"))).alias("m1"),
        F.avg(F.when((place >= one) & (place < two), F.col("value"))).alias("m2"),
        F.avg(F.when(place >= two, F.col("value"))).alias("m3"),
    )
    joined = attach(stats, thirds, [entity, "variable"])
    return joined.select(
        entity, "variable", "n", "low", "high", "mean", "last", trend_mark(n, F.col("m1"), F.col("m2"), F.col("m3")).alias("trend")
    )


def _sentence(words: Sequence[str], values: Sequence[Column]) -> Column:
    """Words and values in turn, a word first."""
    parts = []
    for i, word in enumerate(words):
        parts.append(F.lit(word))
        if i < len(values):
            parts.append(values[i])
    return F.concat(*parts)


MISSING = "unknown"


def _plain_number(x: Column) -> Column:
    """A float as text with at least one decimal, never with an exponent."""
    x = x.cast("double")
    exponent = x.cast("string").contains("E")
    plain = F.regexp_replace(x.try_cast("decimal(38,10)").cast("string"), "(\\.[0-9]+?)0+$", "$1")
    return F.when(exponent, F.coalesce(plain, F.format_string("%.1f", x))).otherwise(x.cast("string"))


def entity_summaries(
    df: DataFrame,
    cols: Sequence[str] = SUMMARY_VARIABLES,
    age: str = "Age",
    gender: str = "Gender",
    weight: str = "Weight",
    entity: str = "entity_id",
    ts: str = "ts",
    true_mean: bool = False,
    chunk_hours: float | None = CHUNK_HOURS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Both texts of every entity: ``summary_statistical`` and ``summary_trend``.

    "avg" states the last value, as established readers of these texts expect; ``true_mean`` states the mean.
    Variables without readings are left out, from the trend text also those with fewer than three.
    """
    cols = [c for c in cols if c in df.columns]
    heads = df.groupBy(entity).agg(F.min_by(F.struct(age, gender, weight), ts).alias("h"))
    stats = trend_labels(df, cols, entity, ts, chunk_hours, chunk_rows)
    number = [two_decimals(F.col(c)) for c in ("low", "high")]
    average, last = two_decimals(F.col("mean" if true_mean else "last")), two_decimals(F.col("last"))
    place = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("variable"))
    lines = stats.select(
        entity,
        place.alias("place"),
        _sentence(LINE_STATISTICAL, [F.col("variable"), *number, average, last]).alias("plain"),
        F.when(
            F.col("n") >= FEWEST_FOR_TREND,
            _sentence(LINE_TREND, [F.col("variable"), *number, F.col("trend"), average, last]),
        ).alias("trend"),
    )
    # at most one line per listed variable
    texts = lines.groupBy(entity).agg(F.array_sort(F.collect_list(F.struct("place", "plain", "trend"))).alias("lines"))
    joined = attach(heads, texts, [entity])
    missing = F.lit(MISSING)  # a header states what isn't known
    years = F.coalesce(F.col(f"h.{age}").cast("int").cast("string"), missing)
    sex = F.when(F.col(f"h.{gender}") == 1, "male").when(F.col(f"h.{gender}").isNotNull(), "female").otherwise(missing)
    plain = _sentence(HEADER_STATISTICAL, [years, sex])
    trend = _sentence(HEADER_TREND, [years, sex, F.coalesce(_plain_number(F.col(f"h.{weight}")), missing)])

    def text(head: Column, field: str) -> Column:
        kept = F.filter(F.transform("lines", lambda x: x[field]), lambda x: x.isNotNull())
        return F.array_join(F.concat(F.array(head), F.coalesce(kept, F.array().cast("array<string>"))), "\n")

    return joined.select(entity, text(plain, "plain").alias("summary_statistical"), text(trend, "trend").alias("summary_trend"))


def patient_summaries(df: DataFrame, labels: DataFrame, entity: str = "entity_id", **options) -> DataFrame:
    """Both texts with the label, null where there is none."""
    return attach(entity_summaries(df, entity=entity, **options), labels, [entity])
