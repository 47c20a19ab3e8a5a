"""Queries: imputation, scaling, per-entity aggregates, lags and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohort_spark.catalog.common import (
    FFILL_SQL, FILLED_SQL, OBS_SQL, ORDER, PANEL_SQL, SPLIT_SQL, STATICS_SQL, VARIABLES, cols_sql, hourly_panel,
    observations, outcomes, round_sql, rounded, split_of,
)
from cohort_spark.catalog.registry import query
from cohort_spark.operators import aggregate, impute, scale
from cohort_spark.operators.knn import knn_impute

WHOLE = cols_sql(round_sql("{c}") + " as {c}")


@query(
    "static_view",
    f"""with {PANEL_SQL} select entity_id,
    {cols_sql(round_sql("arg_min({c}, ts) filter (where {c} is not null)") + " as {c}")} from panel group by entity_id""",
)
def _(t):
    return rounded(impute.static_view(hourly_panel(t), VARIABLES, ORDER), VARIABLES)


FLAG_SQL = f"""{PANEL_SQL}, flags as (
  select entity_id, ts, case when error > 100 then 1 when error is not null then 0 end as flag from panel)"""


def flags(t):
    return hourly_panel(t).select(
        "entity_id", "ts", F.when(F.col("error") > 100, 1).when(F.col("error").isNotNull(), 0).alias("flag")
    )


@query(
    "any_flag_to_static",
    f"""with {FLAG_SQL} select entity_id, ts,
    max(coalesce((flag = 1)::int, 0)) over (partition by entity_id) as flag from flags""",
)
def _(t):
    return impute.any_flag_to_static(flags(t), "flag")


@query(
    "any_flag_fills_nulls",
    f"""with {FLAG_SQL} select entity_id, ts, coalesce(flag,
    max(coalesce((flag = 1)::int, 0)) over (partition by entity_id)) as flag from flags""",
)
def _(t):
    return impute.any_flag_to_static(flags(t), "flag", only_nulls=True)


@query("forward_fill", f"with {FILLED_SQL} select entity_id, ts, {WHOLE} from filled")
def _(t):
    return rounded(impute.forward_fill(hourly_panel(t), VARIABLES, ORDER, chunk_hours=None), VARIABLES)


@query("forward_fill_chunked", f"with {FILLED_SQL} select entity_id, ts, {WHOLE} from filled")
def _(t):
    return rounded(impute.forward_fill(hourly_panel(t), VARIABLES, ORDER, chunk_rows=200), VARIABLES)


EVENT_FILL_SQL = FFILL_SQL.replace("order by ts", "order by ts, event_id")


@query(
    "forward_fill_events",
    f"""with {OBS_SQL}, wide as (select event_id, entity_id, ts,
      {cols_sql("case when variable = '{c}' then value end as {c}")} from obs)
    select event_id, entity_id, ts, {cols_sql(EVENT_FILL_SQL)} from wide""",
)
def _(t):
    wide = observations(t).select(
        "event_id", "entity_id", "ts", *[F.when(F.col("variable") == v, F.col("value")).alias(v) for v in VARIABLES]
    )
    return impute.forward_fill(wide, VARIABLES, ["ts", "event_id"], chunk_rows=500)


def _known_sql(c: str) -> str:
    known = f"case when {c} is not null then ts end"
    back = "over (partition by entity_id order by ts rows between unbounded preceding and current row)"
    ahead = "over (partition by entity_id order by ts rows between current row and unbounded following)"
    return (
        f"last_value({c} ignore nulls) {back} as {c}_pv, last_value({known} ignore nulls) {back} as {c}_pt, "
        f"first_value({c} ignore nulls) {ahead} as {c}_nv, first_value({known} ignore nulls) {ahead} as {c}_nt"
    )


def _linear_sql(c: str) -> str:
    return round_sql(
        f"coalesce({c}, case when {c}_pv is null then {c}_nv when {c}_nv is null then {c}_pv else {c}_pv + "
        f"({c}_nv - {c}_pv) * date_diff('second', {c}_pt, ts) / date_diff('second', {c}_pt, {c}_nt) end)"
    )


INTERPOLATED_SQL = f"""with {PANEL_SQL}, known as (select *, {", ".join(_known_sql(c) for c in VARIABLES)} from panel)
select entity_id, ts, {", ".join(f"{_linear_sql(c)} as {c}" for c in VARIABLES)} from known"""


@query("interpolate_time", INTERPOLATED_SQL)
def _(t):
    return rounded(impute.interpolate_time(hourly_panel(t), VARIABLES, chunk_hours=None), VARIABLES)


@query("interpolate_time_chunked", INTERPOLATED_SQL)
def _(t):
    return rounded(impute.interpolate_time(hourly_panel(t), VARIABLES, chunk_rows=200), VARIABLES)


GLOBAL_COLS = VARIABLES


def _global_sql(c: str) -> str:
    return f"""knots_{c} as (select ts, arg_min({c}, entity_id) as lo, arg_max({c}, entity_id) as hi from panel
      where {c} is not null group by ts),
    fill_{c} as (
      select a.ts, case when k.hi is not null then k.hi when p.ts is null then n.lo when n.ts is null then p.hi
        else p.hi + (n.lo - p.hi) * date_diff('second', p.ts, a.ts) / date_diff('second', p.ts, n.ts) end as v
      from (select distinct ts from panel) a left join knots_{c} k on k.ts = a.ts
      asof left join knots_{c} p on a.ts >= p.ts asof left join knots_{c} n on a.ts <= n.ts)"""


@query(
    "interpolate_time_global",
    f"""with {PANEL_SQL}, {", ".join(_global_sql(c) for c in GLOBAL_COLS)}
    select entity_id, ts, {", ".join(f"{round_sql(f'coalesce({c}, fill_{c}.v)')} as {c}" for c in GLOBAL_COLS)}
    from panel {" ".join(f"join fill_{c} using (ts)" for c in GLOBAL_COLS)}""",
)
def _(t):
    panel = hourly_panel(t).select("entity_id", "ts", *GLOBAL_COLS)
    return rounded(impute.interpolate_time(panel, GLOBAL_COLS, scope="global", chunk_rows=200), GLOBAL_COLS)


FIN_SQL = "case when {c} = 'inf'::double or {c} = '-inf'::double then null else {c} end"
LIMITS_SQL = f"""{PANEL_SQL}, spiked as (
  select entity_id, ts, case when click > 200 then 'inf'::double when click < 0.5 then '-inf'::double else click end
    as click, view, null::double as signup from panel),
fit as (select {cols_sql("max(" + FIN_SQL + ") as {c}_hi, min(" + FIN_SQL + ") as {c}_lo, quantile_cont(" + FIN_SQL + ", 0.5) as {c}_mid", ["click", "view", "signup"])}
  from spiked)"""


@query(
    "impute_features",
    f"""with {LIMITS_SQL} select entity_id, ts, {cols_sql(round_sql("coalesce(case when {c} = 'inf'::double then {c}_hi when {c} = '-inf'::double then {c}_lo else {c} end, {c}_mid, 0)") + " as {c}", ["click", "view", "signup"])}
    from spiked, fit""",
)
def _(t):
    inf = F.lit(float("inf"))
    click = F.when(F.col("click") > 200, inf).when(F.col("click") < 0.5, -inf).otherwise(F.col("click"))
    spiked = hourly_panel(t).select(
        "entity_id", "ts", click.alias("click"), "view", F.lit(None).cast("double").alias("signup")
    )
    cols = ["click", "view", "signup"]
    return rounded(impute.impute_features(spiked, cols), cols)


# ---- scaling ----------------------------------------------------------------------------------------------------

SCALED = VARIABLES
FIT_SQL = f"""{PANEL_SQL}, train as (select * from panel where {SPLIT_SQL} = 'a'),
fit as (select {cols_sql("avg({c}) as {c}_mean, stddev_pop({c}) as {c}_sd, min({c}) as {c}_min, max({c}) as {c}_max, quantile_cont({c}, 0.25) as {c}_q1, quantile_cont({c}, 0.5) as {c}_q2, quantile_cont({c}, 0.75) as {c}_q3")} from train)"""


def panel_and_train(t):
    panel = hourly_panel(t)
    return panel, panel.where(split_of() == "a")


@query(
    "standard_scale",
    f"""with {FIT_SQL} select entity_id, ts, {cols_sql(round_sql("({c} - {c}_mean) / {c}_sd") + " as {c}", SCALED)}
    from panel, fit""",
)
def _(t):
    panel, train = panel_and_train(t)
    return rounded(scale.standard_scale(panel.select("entity_id", "ts", *SCALED), train, SCALED), SCALED)


@query(
    "robust_scale",
    f"""with {FIT_SQL} select entity_id, ts,
    {cols_sql(round_sql("({c} - {c}_q2) / ({c}_q3 - {c}_q1)") + " as {c}", SCALED)} from panel, fit""",
)
def _(t):
    panel, train = panel_and_train(t)
    return rounded(scale.robust_scale(panel.select("entity_id", "ts", *SCALED), train, SCALED), SCALED)


@query(
    "minmax_scale",
    f"""with {FIT_SQL} select entity_id, ts,
    {cols_sql(round_sql("({c} - {c}_min) / ({c}_max - {c}_min)") + " as {c}", SCALED)} from panel, fit""",
)
def _(t):
    panel, train = panel_and_train(t)
    return rounded(scale.minmax_scale(panel.select("entity_id", "ts", *SCALED), train, SCALED), SCALED)


@query(
    "scale_mixed",
    f"""with {FIT_SQL} select entity_id, ts,
    {cols_sql(round_sql("({c} - {c}_mean) / {c}_sd") + " as {c}", ["click", "error"])},
    {cols_sql(round_sql("({c} - {c}_q2) / ({c}_q3 - {c}_q1)") + " as {c}", ["purchase", "signup", "view"])}
    from panel, fit""",
)
def _(t):
    panel, train = panel_and_train(t)
    return rounded(scale.scale_mixed(panel, train, normal=["click", "error"]), VARIABLES)


@query(
    "scale_basic",
    f"""with {FIT_SQL} select entity_id, ts,
    {cols_sql(round_sql("({c} - {c}_min) / ({c}_max - {c}_min)") + " as {c}")} from panel, fit""",
)
def _(t):
    panel, train = panel_and_train(t)
    return rounded(scale.scale_basic(panel, train), VARIABLES)


@query(
    "minmax_scale_by_split",
    f"""with {PANEL_SQL}, parted as (select *, {SPLIT_SQL} as split from panel)
    select entity_id, ts, split, {cols_sql(round_sql("({c} - min({c}) over s) / (max({c}) over s - min({c}) over s)") + " as {c}", SCALED)}
    from parted window s as (partition by split)""",
)
def _(t):
    panel = hourly_panel(t).select("entity_id", "ts", split_of(), *SCALED)
    return rounded(scale.minmax_scale_by_split(panel, SCALED, ["a", "b", "c"]), SCALED)


# ---- aggregates ---------------------------------------------------------------------------------------------------

RULES = {"click": "last", "error": "max", "purchase": "sum", "signup": "mean", "view": "min"}
LAST_SQL = "arg_max({c}, ts) filter (where {c} is not null)"
RULES_SQL = f"""{LAST_SQL.format(c="click")} as click, max(error) as error, coalesce(sum(purchase), 0) as purchase,
  avg(signup) as signup, min(view) as view"""


@query(
    "aggregate_by_rules",
    f"""with {PANEL_SQL}, agg as (select entity_id, {RULES_SQL} from panel group by entity_id)
    select entity_id, {WHOLE} from agg""",
)
def _(t):
    return rounded(aggregate.aggregate_by_rules(hourly_panel(t), RULES, ORDER), VARIABLES)


LAGS_SQL = cols_sql("lag({c}, 1) over w as {c}_lag1, lag({c}, 2) over w as {c}_lag2", SCALED)
LAG_COLS = [f"{c}_lag{k}" for c in SCALED for k in (1, 2)]


@query(
    "aggregate_with_lags",
    f"""with {FILLED_SQL}, lagged as (select *, {LAGS_SQL} from filled window w as (partition by entity_id order by ts)),
    agg as (select entity_id, {RULES_SQL}, {cols_sql(LAST_SQL + " as {c}", LAG_COLS)} from lagged group by entity_id)
    select entity_id, {cols_sql(round_sql("{c}") + " as {c}", [*VARIABLES, *LAG_COLS])} from agg""",
)
def _(t):
    filled = impute.forward_fill(hourly_panel(t), VARIABLES, ORDER, chunk_hours=None)
    lagged = aggregate.lag_features(filled, SCALED, ORDER, chunk_hours=None)
    rules = aggregate.extend_rules(RULES, lagged.columns)
    return rounded(aggregate.aggregate_by_rules(lagged, rules, ORDER), [*VARIABLES, *LAG_COLS])


@query("label_per_entity", "select o_custkey as entity_id, max((o_orderstatus = 'F')::int) as label from orders group by 1")
def _(t):
    frame = t.orders.select(
        F.col("o_custkey").alias("entity_id"), (F.col("o_orderstatus") == "F").cast("int").alias("label")
    )
    return aggregate.label_per_entity(frame, "label")


LAGGED_SQL = f"""with {FILLED_SQL} select entity_id, ts,
{cols_sql(round_sql("lag({c}, 1) over w") + " as {c}_lag1, " + round_sql("lag({c}, 2) over w") + " as {c}_lag2", SCALED)}
from filled window w as (partition by entity_id order by ts)"""


def lagged_panel(t, **cut):
    filled = impute.forward_fill(hourly_panel(t).select("entity_id", "ts", *SCALED), SCALED, ORDER, chunk_hours=None)
    lagged = aggregate.lag_features(filled, SCALED, ORDER, **cut)
    return rounded(lagged.drop(*SCALED), LAG_COLS)


@query("lag_features", LAGGED_SQL)
def _(t):
    return lagged_panel(t, chunk_hours=None)


@query("lag_features_chunked", LAGGED_SQL)
def _(t):
    return lagged_panel(t, chunk_rows=200)


ACF_SQL = f"""{OBS_SQL}, pairs as (
  select entity_id, variable, value, lag(value) over (partition by entity_id, variable order by ts, event_id) as before
  from obs where value is not null),
per_entity as (select entity_id, variable, covar_pop(value, before) as c, stddev_pop(value) * stddev_pop(before) as s
  from pairs where before is not null group by all),
acf as (select variable, avg(c / s) as acf, count(*) as entities from per_entity where s > 0 group by variable)"""


def event_acf(t):
    wide = observations(t).select(
        "event_id", "entity_id", "ts", *[F.when(F.col("variable") == v, F.col("value")).alias(v) for v in VARIABLES]
    )
    return aggregate.autocorrelations(wide, VARIABLES, ["ts", "event_id"], chunk_rows=500)


@query("avg_autocorrelation", f"with {ACF_SQL} select variable, {round_sql('acf')} as acf, entities from acf")
def _(t):
    return rounded(event_acf(t), ["acf"])


@query(
    "select_by_threshold",
    f"with {ACF_SQL} select variable, {round_sql('acf')} as acf, entities from acf where abs(acf) >= 0.08",
)
def _(t):
    return rounded(aggregate.select_by_threshold(event_acf(t), 0.08), ["acf"])


@query("sorted_head", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("sample_rows", "select * from part order by md5('42:' || p_partkey), p_partkey limit 100")
def _(t):
    return aggregate.sample_rows(t.part, 100, 42, "p_partkey")


@query(
    "sample_entities",
    f"""with {OBS_SQL}, chosen as (select entity_id from (select distinct entity_id from obs)
      order by md5('42:' || entity_id), entity_id limit 20)
    select * from obs where entity_id in (select entity_id from chosen)""",
)
def _(t):
    return aggregate.sample_entities(observations(t), 20, 42)


@query(
    "best_config",
    f"""with scores as (select p_brand, p_type, avg(p_retailprice) as price from part group by all)
    select p_brand, p_type, {round_sql("price")} as price from scores order by price desc, p_brand, p_type limit 1""",
)
def _(t):
    scores = t.part.groupBy("p_brand", "p_type").agg(F.avg("p_retailprice").alias("price"))
    return rounded(aggregate.best_config(scores, ["p_brand", "p_type"], "price"), ["price"])


# ---- nearest neighbours ---------------------------------------------------------------------------------------------

KNN_COLS = ["balance", "nation", "spent"]
KNN_STATICS_SQL = f"""{STATICS_SQL}, spending as (
  select o_custkey as entity_id, avg(o_totalprice) as spent from orders group by 1),
people as (
  select entity_id, {SPLIT_SQL} as split, round(nullif(balance, -1), 6) as balance,
    case when entity_id % 7 = 3 then null else nation end as nation, round(spent, 6) as spent
  from statics left join spending using (entity_id))"""


def people(t):
    """Customers with gaps in balance, nation and average order value."""
    spending = t.orders.groupBy(F.col("o_custkey").alias("entity_id")).agg(F.round(F.avg("o_totalprice"), 6).alias("spent"))
    base = t.customer.select(
        F.col("c_custkey").alias("entity_id"),
        split_of("c_custkey"),
        F.round(F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")), 6).alias("balance"),
        F.when(F.col("c_custkey") % 7 != 3, F.col("c_nationkey").cast("double")).alias("nation"),
    )
    return base.join(spending, "entity_id", "left")


def _donor_terms() -> str:
    return " + ".join(f"coalesce((a.{c} - b.{c}) * (a.{c} - b.{c}), 0)" for c in KNN_COLS)


def _donor_shared() -> str:
    return " + ".join(f"(a.{c} is not null and b.{c} is not null)::int" for c in KNN_COLS)


def _fill_sql(c: str) -> str:
    return f"""fill_{c} as (
      select entity_id, avg(v) as v from (
        select a.entity_id, b.{c} as v, row_number() over (partition by a.entity_id
            order by 3.0::double / ({_donor_shared()}) * ({_donor_terms()}), b.entity_id) as rn
        from people a join people b on a.split = b.split
        where a.{c} is null and b.{c} is not null and ({_donor_shared()}) > 0)
      where rn <= 10 group by entity_id),
    mean_{c} as (select split, avg({c}) as v from people group by split)"""


@query(
    "knn_impute",
    f"""with {KNN_STATICS_SQL}, {", ".join(_fill_sql(c) for c in KNN_COLS)}
    select entity_id, split, {", ".join(f"{round_sql(f'coalesce(p.{c}, fill_{c}.v, mean_{c}.v)')} as {c}" for c in KNN_COLS)}
    from people p {" ".join(f"left join fill_{c} using (entity_id) left join mean_{c} using (split)" for c in KNN_COLS)}""",
)
def _(t):
    return rounded(knn_impute(people(t), KNN_COLS, split="split"), KNN_COLS)
