"""Queries: data-quality rules, profiles and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohort_spark.catalog.common import (
    FILLED_SQL, OBS_SQL, ORDER, PANEL_SQL, STATICS_SQL, VARIABLES, cols_sql, hourly_panel, observations, round_sql,
    rounded, statics,
)
from cohort_spark.catalog.registry import query
from cohort_spark.operators import quality
from cohort_spark.operators.impute import forward_fill
from cohort_spark.operators.reshape import melt
from cohort_spark.plans.chunks import Chunks, number_rows


@query("sentinel_to_null", f"with {STATICS_SQL} select entity_id, nullif(balance, -1) as balance, nation from statics")
def _(t):
    return quality.sentinel_to_null(statics(t), ["balance"])


MARKED_SQL = f"""{OBS_SQL}, marked as (
  select event_id, entity_id, ts, variable,
    case when value < 0.02 or event_id = min(event_id) over (partition by entity_id) and entity_id % 2 = 0
         then -1.0::double else value end as value from obs)"""


def marked(t):
    """Readings with -1 in the first row of every second entity and in all very small readings."""
    rows = observations(t)
    first = rows.groupBy("entity_id").agg(F.min("event_id").alias("first_id"))
    mark = (F.col("value") < 0.02) | ((F.col("event_id") == F.col("first_id")) & (F.col("entity_id") % 2 == 0))
    joined = rows.join(first, "entity_id")
    return joined.withColumn("value", F.when(mark, F.lit(-1.0)).otherwise(F.col("value"))).drop("first_id")


@query(
    "sentinel_violations",
    f"""with {MARKED_SQL}, numbered as (
      select *, row_number() over (partition by entity_id order by ts, event_id) as rn from marked)
    select entity_id, bool_and(rn = 1 or value <> -1) as value_first_only from numbered
    group by entity_id having not bool_and(rn = 1 or value <> -1)""",
)
def _(t):
    return quality.sentinel_violations(marked(t), ["value"], ["ts", "event_id"])


@query(
    "null_out_of_range",
    "select l_orderkey, l_linenumber, case when l_quantity >= 10 and l_quantity < 30 then l_quantity end as l_quantity from lineitem",
)
def _(t):
    frame = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return quality.clean(frame, {"l_quantity": [("null_out_of_range", 10, 30)]})


@query(
    "recode_values",
    """select l_orderkey, l_linenumber, case when l_tax = 0.07 then 0.7 else nullif(l_tax, 0) end::double as l_tax
    from lineitem""",
)
def _(t):
    frame = t.lineitem.select("l_orderkey", "l_linenumber", "l_tax")
    return quality.clean(frame, {"l_tax": [("null_if_equals", 0), ("recode_value", 0.07, 0.7)]})


@query(
    "unit_correction",
    """select event_id, case when value between 65 and 80 then value / 10 when value between 100 and 800
    then value / 100 else value end as value from events""",
)
def _(t):
    frame = t.events.select("event_id", "value")
    return quality.clean(frame, {"value": [("unit_correction", [(65, 80, 10), (100, 800, 100)])]})


@query("null_below", "select event_id, case when value >= 20 then value end as value from events")
def _(t):
    return quality.clean(t.events.select("event_id", "value"), {"value": [("null_below", 20)]})


CLEAN_RULES = {
    "click": [("null_if_equals", 0)],
    "error": [("null_out_of_range", 1, 300)],
    "purchase": [("unit_correction", [(65, 80, 10), (100, 800, 100)])],
    "view": [("null_below", 2)],
}


@query(
    "clean_panel",
    f"""with {PANEL_SQL} select entity_id, ts, {round_sql("nullif(click, 0)")} as click,
    {round_sql("case when error >= 1 and error < 300 then error end")} as error,
    {round_sql("case when purchase between 65 and 80 then purchase / 10 when purchase between 100 and 800 then purchase / 100 else purchase end")} as purchase,
    {round_sql("signup")} as signup, {round_sql("case when view >= 2 then view end")} as view from panel""",
)
def _(t):
    return rounded(quality.clean(hourly_panel(t), CLEAN_RULES), VARIABLES)


@query(
    "null_profile",
    f"""with {PANEL_SQL}, counts as (
      select "column", count(*) - count(value) as nulls, count(*) as n
      from (select * from panel unpivot include nulls (value for "column" in ({", ".join(VARIABLES)}))) group by 1)
    select "column", nulls, {round_sql("nulls::double / n", 9)} as missing_rate from counts""",
)
def _(t):
    return rounded(quality.null_profile(hourly_panel(t), VARIABLES), ["missing_rate"], 9)


@query(
    "domain_check",
    """select 'quality' as "column", count(*) filter (where quality not in (0, 1)) as outside,
      bool_and(quality in (0, 1)) as in_domain from labels
    union all select 'toxic', count(*) filter (where toxic not in (1)), bool_and(toxic in (1)) from labels""",
)
def _(t):
    return quality.domain_check(t.labels, {"quality": [0, 1], "toxic": [1]})


@query(
    "varying_entities",
    """select o_custkey as entity_id, min(o_orderstatus) as low, max(o_orderstatus) as high from orders
    group by 1 having min(o_orderstatus) <> max(o_orderstatus)""",
)
def _(t):
    frame = t.orders.select(F.col("o_custkey").alias("entity_id"), "o_orderstatus")
    return quality.varying_entities(frame, "o_orderstatus")


@query("negative_rows", "select * from customer where c_acctbal < 0 or c_nationkey < 0")
def _(t):
    return quality.negative_rows(t.customer, ["c_acctbal", "c_nationkey"])


@query("singleton_entities", "select o_custkey as entity_id, count(*) as n from orders group by 1 having count(*) = 1")
def _(t):
    return quality.singleton_entities(t.orders.select(F.col("o_custkey").alias("entity_id")))


@query(
    "entities_in",
    "select event_id, user_id as entity_id, ts from events where user_id in (select c_custkey from customer where c_acctbal < 0)",
)
def _(t):
    rows = t.events.select("event_id", F.col("user_id").alias("entity_id"), "ts")
    wanted = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("entity_id"))
    return quality.entities_in(rows, wanted)


@query(
    "null_by_offender_set",
    f"""with {OBS_SQL}, {STATICS_SQL} select event_id, entity_id,
    case when entity_id in (select entity_id from statics where balance < 1000) then null else value end as value
    from obs""",
)
def _(t):
    rows = observations(t).select("event_id", "entity_id", "value")
    return quality.null_by_offender_set(rows, statics(t), F.col("balance") < 1000, "value")


@query("extreme_records", f"with {OBS_SQL} select * from obs where variable = 'error' and value > 200 or value < 0.05")
def _(t):
    return quality.extreme_records(
        observations(t), ((F.col("variable") == "error") & (F.col("value") > 200)) | (F.col("value") < 0.05)
    )


@query(
    "history_of_extremes",
    f"""with {OBS_SQL} select * from obs
    where entity_id in (select entity_id from obs where variable = 'error' and value > 300)""",
)
def _(t):
    return quality.history_of_extremes(observations(t), (F.col("variable") == "error") & (F.col("value") > 300))


def filled_panel(t):
    return forward_fill(hourly_panel(t), VARIABLES, ORDER, chunk_hours=None)


@query(
    "drop_null_rows",
    f"""with {FILLED_SQL} select entity_id, ts, {cols_sql(round_sql('{c}') + ' as {c}')} from filled
    where {" and ".join(f"{v} is not null" for v in VARIABLES)}""",
)
def _(t):
    return rounded(quality.drop_null_rows(filled_panel(t)), VARIABLES)


@query(
    "drop_null_rows_subset",
    f"""with {PANEL_SQL} select entity_id, ts, {round_sql("click")} as click from panel where click is not null""",
)
def _(t):
    panel = hourly_panel(t).select("entity_id", "ts", "click")
    return rounded(quality.drop_null_rows(panel, ["click"]), ["click"])


@query(
    "last_rows",
    f"""with {PANEL_SQL} select entity_id, ts, {cols_sql(round_sql('{c}') + ' as {c}')} from panel
    qualify row_number() over (partition by entity_id order by ts desc) = 1""",
)
def _(t):
    return rounded(quality.last_rows(hourly_panel(t), ORDER), VARIABLES)


@query(
    "first_rows",
    f"""with {OBS_SQL} select * from obs
    qualify row_number() over (partition by entity_id order by ts, event_id) = 1""",
)
def _(t):
    return quality.last_rows(observations(t), ["ts", "event_id"], last=False)


@query(
    "entities_with_null_last_row",
    f"""with {PANEL_SQL}, tail as (select * from panel
      qualify row_number() over (partition by entity_id order by ts desc) = 1)
    select entity_id, ts, {cols_sql(round_sql('{c}') + ' as {c}')} from tail where click is null or view is null""",
)
def _(t):
    return rounded(quality.entities_with_null_last_row(hourly_panel(t), ["click", "view"], ORDER), VARIABLES)


@query(
    "reconcile_cells",
    f"""with {PANEL_SQL}, w as (select {" + ".join(f"count({v})" for v in VARIABLES)} as wide_cells from panel),
    l as (select count(*) as long_rows from panel unpivot (value for variable in ({", ".join(VARIABLES)})))
    select wide_cells, long_rows, wide_cells = long_rows as equal from w, l""",
)
def _(t):
    panel = hourly_panel(t)
    long = quality.drop_null_rows(melt(panel, ["entity_id", "ts"], VARIABLES), ["value"])
    return quality.reconcile_cells(panel, long, VARIABLES)


@query(
    "number_rows",
    f"""with {OBS_SQL} select event_id, row_number() over (partition by entity_id order by ts, event_id) as at from obs""",
)
def _(t):
    rows = observations(t).select("entity_id", "ts", "event_id")
    numbered = number_rows(rows, ["entity_id"], ["ts", "event_id"], "at", Chunks(rows=500))
    return numbered.select("event_id", "at")
