"""Queries: exploratory statistics, series features, metrics, silhouette."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from cohort_spark.catalog.common import (
    ORDER, PANEL_SQL, VARIABLES, cols_sql, hourly_panel, round_sql, rounded,
)
from cohort_spark.catalog.registry import query
from cohort_spark.operators import explore, features, metrics
from cohort_spark.operators.impute import impute_features
from cohort_spark.operators.silhouette import silhouette, silhouette_squared

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _stats_sql(c: str) -> str:
    return f"""select '{c}' as variable, min({c})::double as min, quantile_cont({c}, 0.25) as q1,
      quantile_cont({c}, 0.5) as median, avg({c}) as mean, quantile_cont({c}, 0.75) as q3, max({c})::double as max,
      count(*) - count({c}) as nulls"""


STAT_COLS = ["min", "q1", "median", "mean", "q3", "max"]


@query(
    "summary_stats",
    f"""with s as ({" union all ".join(_stats_sql(c) + " from lineitem" for c in NUMBERS)})
    select variable, {cols_sql(round_sql("{c}") + " as {c}", STAT_COLS)}, nulls from s""",
)
def _(t):
    return rounded(explore.summary_stats(t.lineitem.select(*NUMBERS), NUMBERS), STAT_COLS)


@query(
    "summary_stats_panel",
    f"""with {PANEL_SQL}, s as ({" union all ".join(_stats_sql(c) + " from panel" for c in VARIABLES)})
    select variable, {cols_sql(round_sql("{c}") + " as {c}", STAT_COLS)}, nulls from s""",
)
def _(t):
    return rounded(explore.summary_stats(hourly_panel(t), VARIABLES), STAT_COLS)


@query("frequency_table", "select quality, count(*) as n from documents left join labels using (doc_id) group by 1")
def _(t):
    return explore.frequency_table(t.documents.select("doc_id").join(t.labels, "doc_id", "left"), "quality")


@query("frequency_table_known", "select event_type, count(*) as n from events where event_type is not null group by 1")
def _(t):
    return explore.frequency_table(t.events, "event_type", use_na=False)


@query(
    "histogram",
    "select event_type, ceil((value - 2.5) / 5) * 5 + 0.0 as bin, count(*) as n from events where value is not null group by all",
)
def _(t):
    from cohort_spark.operators.reshape import binned_counts

    return binned_counts(t.events, "value", 5, ["event_type"])


def _kde_sql(source: str, x: str, by: str, cut: float) -> str:
    group = f"group by {by}" if by else ""
    pick, using = (f"{by}, ", f"join fit using ({by})") if by else ("", ", fit")

    def same(other: str) -> str:
        return f"and {other}.{by} = p.{by}" if by else ""

    return f"""with counts as (select {pick}{x}::double as x, count(*) as w from {source} where {x} is not null group by all),
    moments as (select {pick}count(*) as n, stddev_samp({x}) as sd, min({x}) as lo, max({x}) as hi,
      (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)) / 1.34 as iqr from {source} {group}),
    widths as (select *, 0.9::double * least(sd, iqr) * pow(n, -0.2) as bw from moments),
    fit as (select {pick}n, bw, lo - {cut} * bw as lo, hi + {cut} * bw as hi from widths),
    placed as (select {pick}w, (x - (lo - 4 * bw)) / ((hi - lo + 8 * bw) / 511) as place from counts {using}),
    bins as (select {pick}bin, sum(w) as w from (
      select {pick}floor(place)::int as bin, w * (1 - (place - floor(place))) as w from placed
      union all select {pick}floor(place)::int + 1, w * (place - floor(place)) from placed) group by all),
    heights as (select {pick}knot, sum(w * exp(-pow((knot - bin) * (hi - lo + 8 * bw) / 511 / bw, 2) / 2) / (n * bw * {math.sqrt(2 * math.pi)!r})) as y
      from bins {using}, (select unnest(range(512))::int as knot) group by all),
    points as (select {pick}point, lo + (hi - lo) * point / 511 as position,
      ((hi - lo) * point / 511 + 4 * bw) / ((hi - lo + 8 * bw) / 511) as place from fit, (select unnest(range(512))::int as point))
    select {pick.replace(by, f"p.{by}") if by else ""}point, {round_sql("position")} as position, {round_sql("a.y + (b.y - a.y) * (place - floor(place))", 9)} as density
    from points p join heights a on a.knot = floor(place)::int {same("a")} join heights b on b.knot = floor(place)::int + 1 {same("b")}"""


@query(
    "kde",
    f"""with counts as (select p_retailprice::double as x, count(*) as w from part where p_retailprice is not null group by all),
    moments as (select count(*) as n, stddev_samp(p_retailprice) as sd, min(p_retailprice) as lo, max(p_retailprice) as hi,
      (quantile_cont(p_retailprice, 0.75) - quantile_cont(p_retailprice, 0.25)) / 1.34 as iqr from part),
    fit as (select *, 0.9::double * least(sd, iqr) * pow(n, -0.2) as bw from moments),
    grid as (select *, lo + (hi - lo) * point / 511 as position from counts, fit, (select unnest(range(512))::int as point))
    select point, {round_sql("max(position)")} as position,
      {round_sql(f"sum(w * exp(-pow((position - x) / bw, 2) / 2) / (n * bw * {math.sqrt(2 * math.pi)!r}))", 9)} as density
    from grid group by all""",
)
def _(t):
    return rounded(rounded(explore.kde(t.part, "p_retailprice", exact=True), ["position"]), ["density"], 9)


@query("kde_by_group", _kde_sql("customer", "c_acctbal", "c_mktsegment", 3.0))
def _(t):
    curves = explore.kde(t.customer, "c_acctbal", ["c_mktsegment"], cut=3)
    return rounded(rounded(curves, ["position"]), ["density"], 9)


DECILES = [i / 10 for i in range(11)]


@query(
    "quantiles",
    " union all ".join(
        f"select {p}::double as prob, {round_sql(f'quantile_cont(l_extendedprice, {p})')} as value from lineitem"
        for p in DECILES
    ),
)
def _(t):
    return rounded(explore.quantiles(t.lineitem, "l_extendedprice", DECILES), ["value"])


BOX = ["q1", "median", "q3", "low_whisker", "high_whisker"]


@query(
    "box_stats",
    f"""with q as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
      quantile_cont(value, 0.75) as q3 from events group by 1),
    b as (select event_type, q1, median, q3,
      min(value) filter (where value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as low_whisker,
      max(value) filter (where value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as high_whisker,
      count(*) filter (where value not between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as outliers,
      count(*) as n from events join q using (event_type) group by all)
    select event_type, {cols_sql(round_sql("{c}") + " as {c}", BOX)}, outliers, n from b""",
)
def _(t):
    return rounded(explore.box_stats(t.events, "value", ["event_type"]), BOX)


TABLE_SQL = """seen as (select o_orderpriority, o_orderstatus, count(*) as observed from orders group by all),
cells as (select o_orderpriority, o_orderstatus, coalesce(observed, 0) as observed
  from (select distinct o_orderpriority from seen) cross join (select distinct o_orderstatus from seen)
  left join seen using (o_orderpriority, o_orderstatus)),
totals as (select *, sum(observed) over (partition by o_orderpriority)::double as r,
  sum(observed) over (partition by o_orderstatus)::double as c, sum(observed) over ()::double as n from cells)"""


@query(
    "contingency",
    f"""with {TABLE_SQL} select o_orderpriority, o_orderstatus, observed, {round_sql("r * c / n")} as expected,
    {round_sql("(observed - r * c / n) / sqrt(r * c / n * (1 - r / n) * (1 - c / n))")} as std_residual from totals""",
)
def _(t):
    return rounded(explore.contingency(t.orders, "o_orderpriority", "o_orderstatus"), ["expected", "std_residual"])


CHI_SQL = f"""{TABLE_SQL}, chi as (select sum(pow(observed - r * c / n, 2) / (r * c / n)) as statistic,
  ((count(distinct o_orderpriority) - 1) * (count(distinct o_orderstatus) - 1))::bigint as df, max(n)::bigint as n,
  least(count(distinct o_orderpriority), count(distinct o_orderstatus)) - 1 as k from totals)"""


@query(
    "chi_square",
    f"""with {CHI_SQL} select {round_sql("statistic")} as statistic, df, n,
    {round_sql("sqrt(statistic / (n * k))")} as cramers_v from chi""",
)
def _(t):
    return rounded(explore.chi_square(t.orders, "o_orderpriority", "o_orderstatus"), ["statistic", "cramers_v"])


@query("cramers_v", f"with {CHI_SQL} select {round_sql('sqrt(statistic / (n * k))')} as cramers_v from chi")
def _(t):
    return rounded(explore.cramers_v(t.orders, "o_orderpriority", "o_orderstatus"), ["cramers_v"])


# an even number of degrees of freedom (here 4 * 2): the tail is a finite sum
CHI_P_SQL = "(select sum(exp(i * ln(statistic / 2) - statistic / 2 - lgamma(i + 1))) from range(0, df // 2) as terms(i))"


@query(
    "chi_square_p",
    f"""with {CHI_SQL} select {round_sql("statistic")} as statistic, df, n,
    {round_sql("sqrt(statistic / (n * k))")} as cramers_v, {round_sql(CHI_P_SQL)} as p from chi""",
)
def _(t):
    test = explore.chi_square(t.orders, "o_orderpriority", "o_orderstatus")
    p = explore.chi_square_p(F.col("statistic"), F.col("df").cast("double"))
    return rounded(test.withColumn("p", p), ["statistic", "cramers_v", "p"])


WELCH_SQL = """g as (select user_id % 2 as g, avg(value) as m, var_samp(value) as v, count(*) as n
  from events where value is not null group by 1),
pair as (select a.m as mean_first, b.m as mean_second, a.v / a.n as va, b.v / b.n as vb, a.n as na, b.n as nb
  from g a, g b where a.g = 0 and b.g = 1)"""


@query(
    "welch_t",
    f"""with {WELCH_SQL} select {round_sql("mean_first")} as mean_first, {round_sql("mean_second")} as mean_second,
    {round_sql("(mean_first - mean_second) / sqrt(va + vb)")} as t,
    {round_sql("pow(va + vb, 2) / (va * va / (na - 1) + vb * vb / (nb - 1))")} as df from pair""",
)
def _(t):
    frame = t.events.select((F.col("user_id") % 2).alias("group"), "value")
    return rounded(explore.welch_t(frame, "value", "group"), ["mean_first", "mean_second", "t", "df"])


# the density of t summed at the middle of 20,000 steps between zero and t
T_P_SQL = """1 - 2 * abs(t) / 20000 * (select sum(exp(lgamma((df + 1) / 2) - lgamma(df / 2) - 0.5 * ln(df * pi())
  - (df + 1) / 2 * ln(1 + pow(abs(t) * (i + 0.5) / 20000, 2) / df))) from range(0, 20000) as steps(i))"""


@query(
    "welch_t_p",
    f"""with {WELCH_SQL}, test as (select mean_first, mean_second, (mean_first - mean_second) / sqrt(va + vb) as t,
      pow(va + vb, 2) / (va * va / (na - 1) + vb * vb / (nb - 1)) as df from pair)
    select {round_sql("mean_first")} as mean_first, {round_sql("mean_second")} as mean_second, {round_sql("t")} as t,
    {round_sql("df")} as df, {round_sql(T_P_SQL)} as p from test""",
)
def _(t):
    frame = t.events.select((F.col("user_id") % 2).alias("group"), "value")
    test = explore.welch_t(frame, "value", "group")
    return rounded(test.withColumn("p", explore.t_test_p(F.col("t"), F.col("df"))), ["mean_first", "mean_second", "t", "df", "p"])


# ---- series features ------------------------------------------------------------------------------------------------


def _minimal_sql(c: str) -> str:
    return f"""coalesce(sum({c}), 0) as {c}__sum_values, quantile_cont({c}, 0.5) as {c}__median, avg({c}) as {c}__mean,
      count({c})::double as {c}__length, stddev_pop({c}) as {c}__standard_deviation, var_pop({c}) as {c}__variance,
      sqrt(avg({c} * {c})) as {c}__root_mean_square, max({c}) as {c}__maximum, max(abs({c})) as {c}__absolute_maximum,
      min({c}) as {c}__minimum"""


NAMES = [f"{v}__{f}" for v in VARIABLES for f in features.MINIMAL_FEATURES]
EXTRACTED_SQL = f"""{PANEL_SQL}, extracted as (
  select entity_id, {", ".join(_minimal_sql(v) for v in VARIABLES)} from panel group by entity_id)"""
EXTRACT_SQL = f"with {EXTRACTED_SQL} select entity_id, {cols_sql(round_sql('{c}') + ' as {c}', NAMES)} from extracted"


@query("extract_minimal_features", EXTRACT_SQL)
def _(t):
    return rounded(features.extract_minimal_features(hourly_panel(t), VARIABLES, bounded=True), NAMES)


@query("extract_minimal_features_unbounded", EXTRACT_SQL)
def _(t):
    return rounded(features.extract_minimal_features(hourly_panel(t), VARIABLES), NAMES)


TARGET_SQL = """target as (
  select user_id as entity_id, (max(value) filter (where event_type = 'error') > 150)::int as label
  from events group by user_id)"""


def target(t):
    worst = F.max(F.when(F.col("event_type") == "error", F.col("value")))
    return t.events.groupBy(F.col("user_id").alias("entity_id")).agg((worst > 150).cast("int").alias("label"))


RELEVANT_COLS = NAMES


def relevance_long(t):
    from cohort_spark.operators.relate import attach_labels
    from cohort_spark.operators.reshape import melt

    extracted = features.extract_minimal_features(hourly_panel(t), VARIABLES, bounded=True)
    busy = (F.col("error__length") > 12).cast("double").alias("busy")
    # rounded, so that equal means are equal values whatever order they were summed in
    filled = rounded(impute_features(extracted, RELEVANT_COLS), RELEVANT_COLS).select("entity_id", *RELEVANT_COLS, busy)
    return melt(attach_labels(filled, target(t), "inner"), ["entity_id", "label"], [*RELEVANT_COLS, "busy"], "feature")


def _med_sql(c: str) -> str:
    return f"{round_sql(f'coalesce({c}, (select quantile_cont({c}, 0.5) from extracted))')} as {c}"


LONG_SQL = f"""{EXTRACTED_SQL}, {TARGET_SQL}, filled as (
  select entity_id, {", ".join(_med_sql(c) for c in RELEVANT_COLS)}, (error__length > 12)::int::double as busy from extracted),
long as (select entity_id, label, feature, value from (filled join target using (entity_id))
  unpivot (value for feature in ({", ".join([*RELEVANT_COLS, "busy"])})) where label is not null)"""

RANK_SQL = f"""{LONG_SQL}, ranked as (
  select feature, label, value, rank() over (partition by feature order by value)
    + (count(*) over (partition by feature, value) - 1) / 2.0::double as r from long),
ties as (select feature, sum(k * k * k - k) as ties, count(*) as distinct_values
  from (select feature, count(*)::double as k from long group by feature, value) group by feature),
u as (select feature, sum(r) filter (where label = 1) - count(*) filter (where label = 1) * (count(*) filter (where label = 1) + 1) / 2.0::double as u,
  count(*) filter (where label = 1) as positives, count(*) filter (where label = 0) as negatives, count(*) as n from ranked group by feature)"""


@query(
    "rank_sums",
    f"""with {RANK_SQL} select feature, u, {round_sql('''sign(u - positives * negatives / 2.0) *
      greatest(abs(u - positives * negatives / 2.0) - 0.5, 0) /
      sqrt(positives * negatives / 12.0::double * (n + 1 - ties / (n * (n - 1.0::double))))''')} as z,
    distinct_values, positives, negatives, n from u join ties using (feature)""",
)
def _(t):
    return rounded(features.rank_sums(relevance_long(t)), ["z"]).drop("low_pos", "low_neg")


@query(
    "two_by_two",
    f"""with {LONG_SQL}, two as (select feature, min(value) as lo, max(value) as hi from long group by 1
      having count(distinct value) = 2)
    select feature, count(*) filter (where value = hi and label = 1) as high_pos,
      count(*) filter (where value = hi and label = 0) as high_neg,
      count(*) filter (where value = lo and label = 1) as low_pos,
      count(*) filter (where value = lo and label = 0) as low_neg from long join two using (feature) group by 1""",
)
def _(t):
    return features.two_by_two(relevance_long(t))


def extracted_and_target(t):
    extracted = features.extract_minimal_features(hourly_panel(t), VARIABLES, bounded=True)
    return rounded(impute_features(extracted, NAMES), NAMES), target(t)


# Two-sided tails: the normal one by a series of positive terms, Fisher's by the chances of all tables that are no likelier.
NORMAL_SQL = """case when x = 0 then 1 else greatest(0, 1 - 2 / sqrt(pi()) * exp(-x * x) * (
  select sum(exp(2 * i * ln(2) + (2 * i + 1) * ln(x) + lgamma(i + 1) - lgamma(2 * i + 2))) from range(0, 400) as terms(i))) end"""
TABLE_CHANCE_SQL = """lgamma(rows + 1) - lgamma({k} + 1) - lgamma(rows - {k} + 1) + lgamma(n - rows + 1) - lgamma(cols - {k} + 1)
  - lgamma(n - rows - cols + {k} + 1)"""
RELEVANCE_SQL = f"""{RANK_SQL}, ends as (select feature, min(value) as low from long group by feature),
lows as (select feature, count(*) filter (where label = 1) as low_pos, count(*) filter (where label = 0) as low_neg
  from long join ends using (feature) where value = low group by feature),
tested as (
  select feature, distinct_values, n, positives as cols, n - low_pos - low_neg as rows, positives - low_pos as seen,
    coalesce(abs(sign(u - positives * negatives / 2.0) * greatest(abs(u - positives * negatives / 2.0) - 0.5, 0) /
      sqrt(nullif(greatest(positives * negatives / 12.0::double * (n + 1 - ties / (n * (n - 1.0::double))), 0), 0))), 0) / sqrt(2) as x
  from u join ties using (feature) join lows using (feature) where distinct_values > 1 and feature <> 'busy'),
binary_p as (
  select feature, least(1, sum(exp(chance)) filter (where chance <= observed + 1e-7) / sum(exp(chance))) as p
  from (select feature, {TABLE_CHANCE_SQL.format(k="k")} as chance, {TABLE_CHANCE_SQL.format(k="seen")} as observed
    from (select *, unnest(range(greatest(0, rows + cols - n), least(rows, cols) + 1)) as k from tested where distinct_values = 2))
  group by feature),
p_values as (
  select feature, case when distinct_values = 2 then 'binary' else 'real' end as kind, coalesce(b.p, {NORMAL_SQL}) as p
  from tested left join binary_p b using (feature))"""


@query("feature_relevance", f"with {RELEVANCE_SQL} select feature, kind, {round_sql('p')} as p from p_values")
def _(t):
    extracted, labels = extracted_and_target(t)
    return rounded(features.feature_relevance(extracted, labels, NAMES), ["p"])


P_SQL = """p as (select 'b' || p_brand || p_type as feature, avg(p_retailprice) / 30000 - 0.03 as p from part group by 1),
ranked as (select feature, p, row_number() over (order by p, feature)::int as rank, count(*) over () as m from p),
bounded as (select *, sum(1.0::double / rank) over () as h from ranked),
cut as (select max(rank) as last from bounded where p <= rank * 0.05::double / (m * h))"""


@query("select_relevant", f"with {P_SQL} select feature, {round_sql('p', 9)} as p, rank from ranked, cut where rank <= last")
def _(t):
    p = t.part.groupBy(F.concat(F.lit("b"), "p_brand", "p_type").alias("feature")).agg(
        (F.avg("p_retailprice") / 30000 - 0.03).alias("p")
    )
    return rounded(features.select_relevant(p), ["p"], 9)


@query(
    "selected_features",
    f"""with {RELEVANCE_SQL}, p as (select feature, {round_sql("p", 9)} as p from p_values), {P_SQL[P_SQL.index("ranked as"):].replace("ranked", "placed")}
    select feature, rank from placed, cut where rank <= last""",
)
def _(t):
    extracted, labels = extracted_and_target(t)
    p_values = rounded(features.feature_relevance(extracted, labels, NAMES), ["p"], 9)  # equal ones are told apart by name
    return features.select_relevant(p_values, 0.05).select("feature", "rank")


@query(
    "align_features",
    f"""with {EXTRACTED_SQL} select entity_id, {round_sql("view__mean")} as view__mean,
    {round_sql("click__maximum")} as click__maximum, null::double as absent__mean from extracted""",
)
def _(t):
    extracted = features.extract_minimal_features(hourly_panel(t), ["click", "view"], bounded=True)
    aligned = features.align_features(extracted, ["view__mean", "click__maximum", "absent__mean"])
    return rounded(aligned, ["view__mean", "click__maximum"])


# ---- metrics ----------------------------------------------------------------------------------------------------------

SCORED_SQL = """scored as (select l_shipmode, score, label from (
  select l_returnflag as l_shipmode, l_quantity + round(l_discount * 20) as score, (l_tax > 0.05)::int as label from lineitem))"""


def scored(t):
    """Line items as scored rows in three groups; scores have many ties."""
    return t.lineitem.select(
        F.col("l_returnflag").alias("l_shipmode"),
        (F.col("l_quantity") + F.round(F.col("l_discount") * 20)).alias("score"),
        (F.col("l_tax") > 0.05).cast("int").alias("label"),
    )


def _auroc_sql(by: str) -> str:
    part = f"partition by {by}" if by else ""
    also = f"{by}, " if by else ""
    return f"""ranks as (select *, rank() over ({part} order by score) + (count(*) over (partition by {also}score) - 1) / 2.0::double as r
      from scored),
    roc as (select {also}(sum(r) filter (where label = 1) - p * (p + 1) / 2.0::double) / (p * nn) as auroc, n from (
      select *, sum(label) over ({part})::double as p, sum(1 - label) over ({part})::double as nn, count(*) over ({part}) as n from ranks)
      group by {also}p, nn, n),
    points as (select {also}score, sum(label)::double as tp, count(*)::double as k from scored group by {also}score),
    curve as (select {also}tp, sum(tp) over ({part} order by score desc) as ctp, sum(k) over ({part} order by score desc) as ck,
      sum(tp) over ({part}) as p from points),
    ap as (select {also}sum(tp / p * ctp / ck) as average_precision from curve {f"group by {by}" if by else ""})"""


def metrics_sql(by: str, digits: int = 6) -> str:
    """Rows, log loss of probabilities, AUROC and average precision of ``scored`` per group."""
    also, using = (f"{by}, ", f"using ({by})") if by else ("", "on true")
    kept = "least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16)"
    return f"""{_auroc_sql(by)},
    losses as (select {also}avg(-(label * ln({kept}) + (1 - label) * ln(1 - {kept}))) as log_loss from scored {f"group by {by}" if by else ""})
    select {also}n, {cols_sql(round_sql("{c}", digits) + " as {c}", ["log_loss", "auroc", "average_precision"])}
    from roc join ap {using} join losses {using}"""


@query("auroc", f"with {SCORED_SQL}, {_auroc_sql('')} select {round_sql('auroc')} as auroc from roc")
def _(t):
    return rounded(metrics.auroc(scored(t)), ["auroc"])


@query(
    "average_precision",
    f"with {SCORED_SQL}, {_auroc_sql('')} select {round_sql('average_precision')} as average_precision from ap",
)
def _(t):
    return rounded(metrics.average_precision(scored(t)), ["average_precision"])


@query("accuracy", f"select {round_sql('avg((quality = toxic)::int)')} as accuracy from labels")
def _(t):
    return rounded(metrics.accuracy(t.labels, "quality", "toxic"), ["accuracy"])


LOSS_SQL = "greatest(z, 0) - z * y + ln(1 + exp(-abs(z)))"


@query(
    "log_loss",
    f"""select {round_sql(f"avg({LOSS_SQL})")} as log_loss
    from (select (l_quantity - 25) / 10 as z, (l_tax > 0.05)::int as y from lineitem)""",
)
def _(t):
    frame = t.lineitem.select(((F.col("l_quantity") - 25) / 10).alias("z"), (F.col("l_tax") > 0.05).cast("int").alias("y"))
    return rounded(metrics.log_loss(frame, "z", "y", from_logit=True), ["log_loss"])


@query(
    "evaluate",
    f"""with {SCORED_SQL}, {_auroc_sql('l_shipmode')},
    loss as (select l_shipmode, avg({LOSS_SQL.replace("z", "score").replace("y", "label")}) as log_loss from scored group by 1)
    select l_shipmode, n, {cols_sql(round_sql("{c}") + " as {c}", ["log_loss", "auroc", "average_precision"])}
    from roc join ap using (l_shipmode) join loss using (l_shipmode)""",
)
def _(t):
    table = metrics.evaluate(scored(t), by=["l_shipmode"], from_logit=True)
    return rounded(table, ["log_loss", "auroc", "average_precision"])


@query(
    "evaluate_overall",
    f"""with {SCORED_SQL}, {_auroc_sql('')}, loss as (select avg({LOSS_SQL.replace("z", "score").replace("y", "label")}) as log_loss from scored)
    select n, {cols_sql(round_sql("{c}") + " as {c}", ["log_loss", "auroc", "average_precision"])} from roc, ap, loss""",
)
def _(t):
    return rounded(metrics.evaluate(scored(t), from_logit=True), ["log_loss", "auroc", "average_precision"])


PAIRS_SQL = """with pts as (select vec_id, label, embedding::double[] as x from embeddings),
sums as (select a.vec_id, a.label, b.label as other, sum({d}) as total, count(*) as n from pts a, pts b group by all),
each as (select vec_id, max(case when label = other then total / nullif(n - 1, 0) end) as a,
  min(case when label <> other then total / n end) as b from sums group by vec_id)
select {out} as silhouette from each"""
SQUARE = "list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
SILHOUETTE = round_sql("avg(case when a is null then 0 else coalesce((b - a) / nullif(greatest(a, b), 0), 0) end)")


@query("silhouette", PAIRS_SQL.format(d=f"sqrt({SQUARE})", out=SILHOUETTE))
def _(t):
    return rounded(silhouette(t.embeddings), ["silhouette"])


@query("silhouette_squared", PAIRS_SQL.format(d=SQUARE, out=SILHOUETTE))
def _(t):
    return rounded(silhouette_squared(t.embeddings), ["silhouette"])
