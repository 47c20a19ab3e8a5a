"""Queries: time, reshape, column and join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohort_spark.catalog.common import (
    BASE_TIME, CEIL_SQL, FILLED_SQL, MINUTE_SQL, OBS_SQL, ORDER, OUTCOMES_SQL, PANEL_SQL, SPLIT_SQL, STATICS_SQL,
    VARIABLES, cols_sql, hourly_panel, minute_panel, observations, outcomes, round_sql, rounded, split_of, statics,
)
from cohort_spark.catalog.registry import query
from cohort_spark.functions.numeric import half_up, sigmoid, softmax_positive
from cohort_spark.functions.time import ceil_to_hour, elapsed_to_timestamp, normalize_time
from cohort_spark.operators import relate, reshape
from cohort_spark.operators.aggregate import aggregate_by_rules
from cohort_spark.operators.impute import forward_fill

FEATURE_RULES = {"click": "last", "error": "max", "purchase": "sum", "signup": "mean", "view": "min"}
FEATURES_SQL = f"""{FILLED_SQL}, features as (
  select entity_id,
    arg_max(click, ts) filter (where click is not null) as click, max(error) as error,
    coalesce(sum(purchase), 0) as purchase, avg(signup) as signup, min(view) as view
  from filled group by entity_id)"""


def entity_features(t):
    # an hourly panel bounds the rows per entity by the hours of the data, so plain windows are safe
    filled = forward_fill(hourly_panel(t), VARIABLES, ORDER, chunk_hours=None)
    features = aggregate_by_rules(filled, FEATURE_RULES, ORDER)
    return relate.attach_labels(features, outcomes(t))


@query(
    "entity_features",
    f"""with {FEATURES_SQL}, {OUTCOMES_SQL}
    select entity_id, {cols_sql(round_sql("f.{c}") + " as {c}")}, label
    from features f left join outcomes using (entity_id)""",
)
def _(t):
    return rounded(entity_features(t), VARIABLES)


@query(
    "elapsed_to_timestamp",
    """select event_id, timestamp '2024-01-01' + to_minutes(
         (event_id % 72)::bigint * 60 + (event_id % 60)::bigint) as at from events""",
)
def _(t):
    clock = F.concat_ws(":", (F.col("event_id") % 72).cast("string"), F.lpad((F.col("event_id") % 60).cast("string"), 2, "0"))
    return t.events.select("event_id", elapsed_to_timestamp(clock, BASE_TIME).alias("at"))


@query("ceil_to_hour", f"select event_id, {CEIL_SQL} as hour from events")
def _(t):
    return t.events.select("event_id", ceil_to_hour(F.col("ts")).alias("hour"))


@query(
    "normalize_time",
    f"select event_id, {round_sql('date_diff(' + chr(39) + 'microsecond' + chr(39) + ', timestamp ' + chr(39) + BASE_TIME + chr(39) + ', ts) / 1e6 / (720 * 3600.0)', 9)} as t from events",
)
def _(t):
    return t.events.select("event_id", half_up(normalize_time(F.col("ts"), BASE_TIME, 720), 9).alias("t"))


@query("pivot_first", f"with {MINUTE_SQL} select * from minutes")
def _(t):
    return minute_panel(t)


@query(
    "pivot_first_daily",
    f"""with {OBS_SQL} select entity_id, date_trunc('day', ts)::timestamp as day,
      {cols_sql("arg_min(value, event_id) filter (where variable = '{c}') as {c}")} from obs group by 1, 2""",
)
def _(t):
    daily = observations(t).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    return reshape.pivot_first(daily, ["entity_id", "day"], VARIABLES, "event_id")


@query("discretize", f"with {PANEL_SQL} select entity_id, ts, {cols_sql(round_sql('{c}') + ' as {c}')} from panel")
def _(t):
    return rounded(hourly_panel(t), VARIABLES)


@query(
    "melt",
    f"""with {PANEL_SQL} select entity_id, ts, variable, {round_sql("value")} as value from panel
    unpivot include nulls (value for variable in ({", ".join(VARIABLES)}))""",
)
def _(t):
    return rounded(reshape.melt(hourly_panel(t), ["entity_id", "ts"], VARIABLES), ["value"])


@query(
    "feature_index",
    f"""select event_id, (list_position([{", ".join(f"'{v}'" for v in VARIABLES)}], event_type) - 1)::int as z,
    value from events""",
)
def _(t):
    return reshape.index_features(
        t.events.select("event_id", "event_type", "value"), VARIABLES, "event_type", "z"
    )


@query(
    "reorder_columns",
    f"""with {PANEL_SQL}, {STATICS_SQL} select entity_id, ts, nation, balance,
    {cols_sql(round_sql('p.{c}') + ' as {c}')} from panel p left join statics using (entity_id)""",
)
def _(t):
    joined = relate.map_static(rounded(hourly_panel(t), VARIABLES), statics(t), ["balance", "nation"])
    return reshape.reorder_columns(joined, ["entity_id", "ts"], ["nation", "balance"])


@query(
    "recast_columns",
    """select l_orderkey::int as l_orderkey, l_linenumber, l_quantity::int as l_quantity,
    (l_returnflag = 'R')::int::varchar as returned, l_shipdate::timestamp as l_shipdate from lineitem""",
)
def _(t):
    frame = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        "l_shipdate", "l_tax",
    )
    casts = {"l_orderkey": "int", "l_quantity": "int", "returned": "string", "l_shipdate": "timestamp_ntz"}
    return reshape.recast(frame, casts, drop=["l_tax"])


@query(
    "concat_columns",
    f"""select l_orderkey, l_linenumber, {round_sql("l_quantity / 50")} as quantity, {round_sql("l_tax * 10")} as tax,
    {round_sql("l_extendedprice / 1000")} as price from lineitem""",
)
def _(t):
    left = {"quantity": half_up(F.col("l_quantity") / 50), "tax": half_up(F.col("l_tax") * 10)}
    right = {"price": half_up(F.col("l_extendedprice") / 1000)}
    return reshape.concat_columns(t.lineitem, left, right, keep=["l_orderkey", "l_linenumber"])


@query(
    "split_xy",
    f"""with {FEATURES_SQL}, {OUTCOMES_SQL} select entity_id, {round_sql("click")} as click,
    {round_sql("view")} as view, label from features left join outcomes using (entity_id)""",
)
def _(t):
    x, y = reshape.split_xy(entity_features(t), ["click", "view"], "label", ["entity_id"])
    return rounded(x, ["click", "view"]).join(y, "entity_id")


HOURS_SQL = f"""{PANEL_SQL}, paired as (
  select entity_id, ts, lag(ts) over (partition by entity_id order by ts) as before from panel),
spans as (
  select entity_id, before + interval 1 hour as a, ts - interval 1 hour as b from paired
  where date_diff('microsecond', before, ts) >= 7200000000
  union all
  select entity_id, max(ts) + interval 1 hour, min(ts) + interval 720 hour from panel group by entity_id
  having date_diff('microsecond', max(ts), min(ts) + interval 720 hour) >= 3600000000),
added as (
  select entity_id, unnest(generate_series(a, b, interval 1 hour)) as ts from spans)"""


@query(
    "fill_missing_hours",
    f"""with {HOURS_SQL}
    select entity_id, ts, {cols_sql(round_sql('{c}') + ' as {c}')} from panel
    union all select entity_id, ts, {cols_sql('null::double as {c}')} from added""",
)
def _(t):
    return rounded(reshape.fill_missing_hours(hourly_panel(t), 720), VARIABLES)


@query(
    "binned_counts",
    """select ceil((p_retailprice - 2.5) / 5) * 5 as bin, count(*) as n from part
    where p_retailprice is not null group by 1""",
)
def _(t):
    return reshape.binned_counts(t.part, "p_retailprice", 5)


@query(
    "probabilities",
    f"""select vec_id, {round_sql("1 / (1 + exp(-embedding[1]::double))", 9)} as one_logit,
    {round_sql("exp(embedding[2]::double) / (exp(embedding[1]::double) + exp(embedding[2]::double))", 9)} as two_logits
    from embeddings""",
)
def _(t):
    a, b = F.col("embedding")[0].cast("double"), F.col("embedding")[1].cast("double")
    return t.embeddings.select(
        "vec_id",
        half_up(sigmoid(a), 9).alias("one_logit"),
        half_up(softmax_positive([a, b]), 9).alias("two_logits"),
    )


# ---- joins ------------------------------------------------------------------------------------------------------


@query(
    "left_join_labels",
    f"""with {PANEL_SQL}, {OUTCOMES_SQL} select entity_id, ts, {round_sql("click")} as click, label
    from panel left join outcomes using (entity_id)""",
)
def _(t):
    panel = rounded(hourly_panel(t).select("entity_id", "ts", "click"), ["click"])
    return relate.attach_labels(panel, outcomes(t))


@query(
    "inner_join_labels",
    f"""with {PANEL_SQL}, {OUTCOMES_SQL} select entity_id, ts, {round_sql("view")} as view, label
    from panel join outcomes using (entity_id)""",
)
def _(t):
    panel = rounded(hourly_panel(t).select("entity_id", "ts", "view"), ["view"])
    return relate.attach_labels(panel, outcomes(t), "inner")


@query(
    "map_static",
    f"""with {OBS_SQL}, {STATICS_SQL} select event_id, entity_id, variable, value, balance, nation
    from obs left join statics using (entity_id)""",
)
def _(t):
    rows = observations(t).select("event_id", "entity_id", "variable", "value")
    return relate.map_static(rows, statics(t), ["balance", "nation"])


@query(
    "unlabelled_entities",
    f"""with {OBS_SQL}, {OUTCOMES_SQL} select distinct entity_id from obs
    where entity_id not in (select entity_id from outcomes)""",
)
def _(t):
    return relate.unlabelled(observations(t).select("entity_id").distinct(), outcomes(t))


@query(
    "sequence_label_pairs",
    f"""with {PANEL_SQL}, {OUTCOMES_SQL} select entity_id, count(*) as steps, max(label) as label
    from panel join outcomes using (entity_id) group by entity_id""",
)
def _(t):
    steps = hourly_panel(t).groupBy("entity_id").agg(F.count(F.lit(1)).alias("steps"))
    return relate.attach_labels(steps, outcomes(t), "inner")


@query(
    "union_entities",
    """select c_custkey as entity_id, c_acctbal as balance, null::int as size from customer
    union all select p_partkey, null, p_size from part""",
)
def _(t):
    return relate.union_entities(
        [
            t.customer.select(F.col("c_custkey").alias("entity_id"), F.col("c_acctbal").alias("balance")),
            t.part.select(F.col("p_partkey").alias("entity_id"), F.col("p_size").alias("size")),
        ]
    )


@query(
    "expand_settings",
    """select doc_id, mode, shots from documents, (values ('binary'), ('score')) m(mode), (values (0), (3)) s(shots)""",
)
def _(t):
    return relate.expand_settings(t.documents.select("doc_id"), {"mode": ["binary", "score"], "shots": [0, 3]})


@query(
    "splits",
    f"""with {OBS_SQL} select entity_id, {SPLIT_SQL} as split, count(*) as n from obs group by all""",
)
def _(t):
    return observations(t).groupBy("entity_id", split_of()).agg(F.count(F.lit(1)).alias("n"))
