"""Queries: models, searches, probes and representations, reported as rounded metrics."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohort_spark.catalog.common import (
    FILLED_SQL, ORDER, SPLIT_SQL, VARIABLES, cols_sql, hourly_panel, round_sql, rounded, split_of,
)
from cohort_spark.catalog.filling import RULES, RULES_SQL
from cohort_spark.catalog.fits import chance_sql, fit_sql
from cohort_spark.catalog.registry import query
from cohort_spark.catalog.statistics import TARGET_SQL, metrics_sql, target
from cohort_spark.operators import models, sequences, vectors
from cohort_spark.operators.aggregate import aggregate_by_rules
from cohort_spark.operators.clients import StatisticsEmbedder
from cohort_spark.operators.impute import forward_fill, impute_features
from cohort_spark.operators.metrics import evaluate
from cohort_spark.operators.relate import attach_labels
from cohort_spark.operators.scale import standard_scale
from cohort_spark.session import shared_folder

METRICS = ["log_loss", "auroc", "average_precision"]


def entity_table(t):
    """Scaled features, label and split per entity; read many times by a fit, so it is written once."""
    filled = forward_fill(hourly_panel(t), VARIABLES, ORDER, chunk_hours=None)
    table = impute_features(aggregate_by_rules(filled, RULES, ORDER), VARIABLES)
    table = standard_scale(table, table.where(split_of() == "a"), VARIABLES)
    # rounded, so that the sums an optimiser sees do not depend on the order of rows
    labelled = attach_labels(rounded(table, VARIABLES, 9), target(t), "inner").where("label is not null")
    shared_folder(t.spark)
    return models.to_features(labelled.withColumn("split", split_of()), VARIABLES, ["entity_id", "label", "split"]).checkpoint()


# The same table in SQL: ``x`` holds the features and a one.
ENTITIES_SQL = f"""{FILLED_SQL}, {TARGET_SQL}, agg as (select entity_id, {RULES_SQL} from filled group by entity_id),
whole as (select entity_id, {cols_sql("coalesce({c}::double, (select quantile_cont({c}, 0.5) from agg), 0) as {c}")} from agg),
scales as (select {cols_sql("avg({c}) as {c}_at, stddev_pop({c}) as {c}_width")} from whole where {SPLIT_SQL} = 'a'),
entities as (
  select entity_id, label, {SPLIT_SQL} as split,
    [{", ".join(round_sql(f"({c} - {c}_at) / case when {c}_width = 0 then 1 else {c}_width end", 9) for c in VARIABLES)}, 1.0::double] as x
  from whole join target using (entity_id), scales where label is not null)"""
WIDTH = len(VARIABLES) + 1
ONE_MODEL_SQL = "models as (select 0 as m, 1.0::double as c, null::int as pick)"
TRAIN_SQL = "fit_rows as (select x, label as y, 0 as pick from entities where split = 'a')"
OUT_SQL = f"scored as (select split, label, {chance_sql()} as score from entities, fitted where split in ('b', 'c'))"


def fitted_sql(penalty: str) -> str:
    return f"with recursive {ENTITIES_SQL}, {ONE_MODEL_SQL}, {TRAIN_SQL}, {fit_sql(WIDTH, penalty)}"


def searched_sql(penalty: str) -> str:
    """Mean AUROC over the folds of every strength."""
    return f"""with recursive {ENTITIES_SQL},
    fit_rows as (select x, label as y, ((row_number() over (partition by label order by md5('42:' || entity_id), entity_id)) % 5)::int as pick
      from entities where split = 'a'),
    models as (select row_number() over () as m, c, pick from (select unnest({models.LOGISTIC_C!r})::double as c), (select unnest(range(5))::int as pick)),
    {fit_sql(WIDTH, penalty, 3000, "r.pick <> s.pick")},
    scored as (select m, c, y as label, {chance_sql()} as score from fitted join models using (m) join fit_rows using (pick)),
    roc as (select c, m, (sum(r) filter (where label = 1) - p * (p + 1) / 2.0::double) / (p * nn) as auroc from (
      select *, rank() over (partition by m order by score) + (count(*) over (partition by m, score) - 1) / 2.0::double as r,
        sum(label) over (partition by m)::double as p, sum(1 - label) over (partition by m)::double as nn from scored)
      group by c, m, p, nn)
    select c as C, {round_sql("avg(auroc)", 4)} as auroc from roc group by c"""


def splits(table):
    train = table.where("split = 'a'")
    return train, table.where("split = 'b'"), table.where("split = 'c'")


def scored_on(model, valid, test):
    both = valid.unionByName(test)
    scored = models.predict_positive(model, both, ["label", "split"])
    return rounded(evaluate(scored, by=["split"]), METRICS, 4)


@query("logistic_l2", f"{fitted_sql('l2')}, {OUT_SQL}, {metrics_sql('split', 4)}")
def _(t):
    train, valid, test = splits(entity_table(t))
    return scored_on(models.fit_logistic(train), valid, test)


@query("logistic_l1", f"{fitted_sql('l1')}, {OUT_SQL}, {metrics_sql('split', 4)}")
def _(t):
    train, valid, test = splits(entity_table(t))
    return scored_on(models.fit_logistic(train, penalty="l1"), valid, test)


@query("grid_search_logistic", searched_sql("l2"))
def _(t):
    train = models.stratified_folds(entity_table(t).where("split = 'a'"))
    _, scores = models.grid_search_logistic(train)
    return rounded(scores, ["auroc"], 4)


@query("grid_search_logistic_l1", searched_sql("l1"))
def _(t):
    train = models.stratified_folds(entity_table(t).where("split = 'a'"))
    _, scores = models.grid_search_logistic(train, penalty="l1")
    return rounded(scores, ["auroc"], 4)


@query(
    "stratified_folds",
    """with mixed as (select l_orderkey * 10 + l_linenumber as id, l_returnflag as label from lineitem),
    uniq as (select id, min(label) as label from mixed group by id)
    select id, label, ((row_number() over (partition by label order by md5('42:' || id), id)) % 5)::int as fold from uniq""",
)
def _(t):
    rows = t.lineitem.groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")).agg(
        F.min("l_returnflag").alias("label")
    )
    return models.stratified_folds(rows, "id")


@query("random_forest")
def _(t):
    train, valid, test = splits(entity_table(t))
    return scored_on(models.fit_random_forest(train), valid, test)


@query("random_search_forest")
def _(t):
    _, scores = models.random_search_forest(models.stratified_folds(entity_table(t).where("split = 'a'")))
    return rounded(scores, ["auroc"], 4)


@query(
    "predict_positive",
    f"{fitted_sql('l2')} select entity_id, {round_sql(chance_sql(), 4)} as score from entities, fitted where split = 'b'",
)
def _(t):
    train, valid, _ = splits(entity_table(t))
    return rounded(models.predict_positive(models.fit_logistic(train), valid, ["entity_id"]), ["score"], 4)


@query(
    "label_scarcity_sweep",
    f"""with recursive {ENTITIES_SQL},
    fit_rows as (select x, label as y, row_number() over (order by md5('42:' || entity_id), entity_id) as pick from entities where split = 'a'),
    models as (select pick as m, 1.0::double as c, pick from (select unnest([20, 40]) as pick)), {fit_sql(WIDTH, uses="r.pick <= s.pick")},
    scored as (select m::int as sample_size, case split when 'b' then 'valid' else 'test' end as data, label, {chance_sql()} as score
      from entities, fitted where split in ('b', 'c')), {metrics_sql("sample_size, data", 4)}""",
)
def _(t):
    train, valid, test = splits(entity_table(t))
    table = models.label_scarcity_sweep(train, {"valid": valid, "test": test}, [20, 40])
    return rounded(table, METRICS, 4)


def labelled_vectors(t):
    return t.embeddings.select("vec_id", "embedding", (F.col("label") == 0).cast("int").alias("label"))


VECTORS_SQL = "vectors as (select vec_id, list_append(embedding::double[], 1.0::double) as x, (label = 0)::int as label from embeddings)"


@query(
    "linear_probe",
    f"""with recursive {VECTORS_SQL}, {ONE_MODEL_SQL}, fit_rows as (select x, label as y, 0 as pick from vectors where vec_id % 3 <> 0),
    {fit_sql(65)}, scored as (select label, {chance_sql()} as score from vectors, fitted where vec_id % 3 = 0), {metrics_sql("", 4)}""",
)
def _(t):
    rows = labelled_vectors(t)
    table = models.linear_probe(rows.where("vec_id % 3 <> 0"), rows.where("vec_id % 3 = 0"))
    return rounded(table, METRICS, 4)


@query("mlp_classifier")
def _(t):
    rows = models.to_features(labelled_vectors(t), "embedding", ["vec_id", "label"])
    model = models.mlp_classifier(rows.where("vec_id % 3 <> 0"), 64)
    scored = models.predict_positive(model, rows.where("vec_id % 3 = 0"), ["label"])
    return rounded(evaluate(scored), METRICS, 3)


@query("pca_representation")
def _(t):
    rows = models.to_features(t.embeddings, "embedding", ["vec_id"])
    model, codes = models.pca_representation(rows, 8, ["vec_id"])
    return rounded(models.reconstruction_error(model, codes), ["mse"], 6)


@query("extract_embeddings")
def _(t):
    built = sequences.build_sequences(hourly_panel(t), VARIABLES, target(t), pad_to=24, chunk_hours=None)
    flat = built.select("entity_id", "label", "segment", "sequence").where("label is not null")
    features = flat.select(array_to_vector(F.flatten("sequence")).alias("features"))
    encoder = PCA(k=4, inputCol="features", outputCol="code").fit(features)
    coded = vectors.extract_embeddings(flat, encoder, keep=["entity_id", "segment", "label"])
    squares = [F.col("embedding")[i] * F.col("embedding")[i] for i in range(4)]  # a component may have either sign
    return rounded(coded.select("entity_id", "segment", "label", *[s.alias(f"square{i}") for i, s in enumerate(squares)]), [f"square{i}" for i in range(4)], 3)


@query("channel_classifier")
def _(t):
    tokens = vectors.embed_series(hourly_panel(t), VARIABLES, StatisticsEmbedder, chunk_hours=None)
    pooled = vectors.pool_tokens(tokens, ["entity_id", "variable"])
    joined = vectors.concat_channels(pooled, VARIABLES, StatisticsEmbedder.width)
    labelled = attach_labels(joined, target(t), "inner").where("label is not null")
    rows = models.to_features(labelled.withColumn("split", split_of()), "embedding", ["entity_id", "label", "split"])
    model = models.mlp_classifier(rows.where("split <> 'c'"), len(VARIABLES) * StatisticsEmbedder.width)
    return rounded(evaluate(models.predict_positive(model, rows.where("split = 'c'"), ["label"])), METRICS, 3)
