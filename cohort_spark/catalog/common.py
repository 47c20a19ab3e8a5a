"""The roles the given tables play, as frames and as SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.catalog.registry import Tables
from cohort_spark.functions.numeric import half_up, nudge
from cohort_spark.operators.reshape import discretize, pivot_first

VARIABLES = ["click", "error", "purchase", "signup", "view"]
ORDER = ["ts"]
BASE_TIME = "2024-01-01 00:00:00"


def observations(t: Tables) -> DataFrame:
    """Long readings: entity, time, variable, value and the order in which they were recorded."""
    return t.events.select(
        F.col("user_id").alias("entity_id"), "ts", F.col("event_type").alias("variable"), "value", "event_id"
    )


def minute_panel(t: Tables) -> DataFrame:
    return pivot_first(observations(t), ["entity_id", "ts"], VARIABLES, "event_id")


def hourly_panel(t: Tables) -> DataFrame:
    """One row per entity and hour, so no entity has more rows than the data has hours."""
    return discretize(minute_panel(t), VARIABLES)


def split_of(entity: str = "entity_id"):
    """Three fixed splits by entity."""
    return F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col(entity) % 3 + 1).cast("int")).alias("split")


def outcomes(t: Tables) -> DataFrame:
    return t.labels.select(F.col("doc_id").alias("entity_id"), F.col("quality").alias("label"))


def statics(t: Tables) -> DataFrame:
    """Per-customer values with -1 where the balance counts as missing."""
    return t.customer.select(
        F.col("c_custkey").alias("entity_id"),
        F.when(F.col("c_acctbal") < 0, F.lit(-1.0)).otherwise(F.col("c_acctbal")).alias("balance"),
        F.col("c_nationkey").cast("double").alias("nation"),
    )


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    return df.select(*[half_up(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- the same in SQL ------------------------------------------------------------------------------------------

VARIABLES_SQL = ", ".join(f"'{v}'" for v in VARIABLES)


def cols_sql(template: str, cols: Sequence[str] = VARIABLES) -> str:
    """``template`` once per column, ``{c}`` standing for the name."""
    return ", ".join(template.format(c=c) for c in cols)


def round_sql(expr: str, digits: int = 6) -> str:
    return f"round({expr} + {nudge(digits)!r}::double, {digits}) + 0.0"


OBS_SQL = """obs as (
  select user_id as entity_id, ts, event_type as variable, value, event_id from events)"""

MINUTE_SQL = f"""{OBS_SQL}, minutes as (
  select entity_id, ts, {cols_sql("arg_min(value, event_id) filter (where variable = '{c}') as {c}")}
  from obs where variable in ({VARIABLES_SQL}) and value is not null group by entity_id, ts)"""

CEIL_SQL = (
    "case when ts > date_trunc('hour', ts) then date_trunc('hour', ts) + interval 1 hour else date_trunc('hour', ts) end"
)

PANEL_SQL = f"""{MINUTE_SQL}, panel as (
  select entity_id, {CEIL_SQL} as ts, {cols_sql("avg({c}) as {c}")} from minutes group by 1, 2)"""

FFILL_SQL = (
    "last_value({c} ignore nulls) over (partition by entity_id order by ts "
    "rows between unbounded preceding and current row) as {c}"
)

FILLED_SQL = f"""{PANEL_SQL}, filled as (select entity_id, ts, {cols_sql(FFILL_SQL)} from panel)"""

OUTCOMES_SQL = "outcomes as (select doc_id as entity_id, quality as label from labels)"

STATICS_SQL = """statics as (
  select c_custkey as entity_id, case when c_acctbal < 0 then -1.0::double else c_acctbal end as balance,
         c_nationkey::double as nation from customer)"""

SPLIT_SQL = "case entity_id % 3 when 0 then 'a' when 1 then 'b' else 'c' end"
