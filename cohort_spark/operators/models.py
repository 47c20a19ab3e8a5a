"""Spark ML models, searches and probes, all scored with the library's own metrics."""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.operators import forest
from cohort_spark.operators.aggregate import sample_rows
from cohort_spark.operators.logistic import LogisticModel, Setting, fit_many, scored_out
from cohort_spark.operators.metrics import auroc, evaluate
from cohort_spark.plans.chunks import number_rows

# The settings searched.
LOGISTIC_C = [0.001, 0.01, 0.1, 1, 10, 100]
FOREST_SPACE = {
    "numTrees": [100, 200],
    "maxDepth": [10, 20],
    "minInstancesPerNode": [1, 2],
    "featureSubsetStrategy": ["sqrt", "log2"],
}


def to_features(df: DataFrame, cols: Sequence[str] | str, keep: Sequence[str]) -> DataFrame:
    """Vector column ``features`` from numeric columns or from one array column."""
    values = F.col(cols) if isinstance(cols, str) else F.array(*[F.col(c).cast("double") for c in cols])
    return df.select(*keep, array_to_vector(values).alias("features"))


def fit_logistic(
    df: DataFrame, label: str = "label", C: float = 1.0, penalty: str = "l2", max_iter: int = 1000, tol: float = 1e-10
) -> LogisticModel:
    """Logistic regression that weighs the summed loss with ``C`` against the penalty.  Features as they are."""
    return fit_many(df, [Setting(C)], label, penalty, max_iter, tol)[0]


def fit_random_forest(df: DataFrame, label: str = "label", trees: int = 100, depth: int = 30, seed: int = 42, **options):
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt",
        seed=seed, **options,
    ).fit(df)


def predict_positive(model, df: DataFrame, keep: Sequence[str], out: str = "score") -> DataFrame:
    """Probability of class 1."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias(out))


def stratified_folds(
    df: DataFrame, key: str = "entity_id", label: str = "label", folds: int = 5, seed: int = 42
) -> DataFrame:
    """Column ``fold``: every class dealt out evenly, in an order that only seed and key decide.

    The order is a hash, so its leading digits cut it into even chunks and no class is numbered in one task.
    """
    mixed = df.withColumn("__order", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
    dealt = number_rows(mixed, [label], ["__order", key], "__at", F.substring("__order", 1, 3))
    return dealt.withColumn("fold", F.pmod(F.col("__at"), F.lit(folds)).cast("int")).drop("__order", "__at")


def _search(df: DataFrame, estimator, grid: list, label: str, folds: int, parallelism: int, names: Sequence[str]):
    """Cross-validated AUROC of every setting, and the model refitted with the best one."""
    judge = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)  # the whole curve
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, foldCol="fold",
        parallelism=parallelism,
    ).fit(df)
    rows = []
    for setting, score in zip(grid, search.avgMetrics):
        by_name = {p.name: v for p, v in setting.items()}
        rows.append((*[str(by_name[n]) for n in names], float(score)))
    schema = ", ".join([*[f"{n} string" for n in names], "auroc double"])
    return search.bestModel, df.sparkSession.createDataFrame(rows, schema)


def grid_search_logistic(
    df: DataFrame, label: str = "label", penalty: str = "l2", C: Sequence[float] = LOGISTIC_C, folds: int = 5, max_iter: int = 1000
) -> tuple[LogisticModel, DataFrame]:
    """Best model and the mean AUROC of every ``C``, on the folds of column ``fold``.

    The models of all strengths and folds, and those of all strengths on all rows, are fitted in the same passes.
    """
    inner = [Setting(float(c), f) for c in C for f in range(folds)]
    outer = [Setting(float(c)) for c in C]
    models = fit_many(df, inner + outer, label, penalty, max_iter)
    scores = auroc(scored_out(df, inner, models[: len(inner)], label), by=["C", "fold"])
    table = scores.groupBy("C").agg(F.avg("auroc").alias("auroc"))
    mean = {r.C: r.auroc for r in table.collect()}  # a row per strength
    known = [c for c in C if mean.get(float(c)) is not None]
    best = max(known, key=lambda c: mean[float(c)], default=C[0])
    return models[len(inner) + list(C).index(best)], table


def random_search_forest(
    df: DataFrame, label: str = "label", space: Mapping[str, Sequence] = FOREST_SPACE, draws: int = 10, folds: int = 5,
    seed: int = 42, parallelism: int = 4,
):
    """Best forest and the score of every setting drawn from the space."""
    estimator = RandomForestClassifier(labelCol=label, featuresCol="features", seed=seed)
    every = list(itertools.product(*space.values()))
    drawn = random.Random(seed).sample(every, min(draws, len(every)))
    grid = [{estimator.getParam(n): v for n, v in zip(space, values)} for values in drawn]
    named = [dict(zip(space, values)) for values in drawn]
    if not all(_shares_passes(s) for s in named):
        return _search(df, estimator, grid, label, folds, parallelism, list(space))
    width = df.select(F.size(vector_to_array("features"))).first()
    settings = [
        forest.Setting(s["numTrees"], s["maxDepth"], s["minInstancesPerNode"], forest.features_per_node(s["featureSubsetStrategy"], width[0] if width else 1))
        for s in named
    ]
    scores = forest.search_scores(df, settings, label, folds, seed)
    best = estimator.copy(grid[scores.index(max(scores))]).fit(df)
    columns = {n: [str(s[n]) for s in named] for n in space}
    return best, df.sparkSession.createDataFrame(pa.table({**columns, "auroc": pa.array(scores, pa.float64())}))


def _shares_passes(setting: Mapping) -> bool:
    """Whether ``forest`` grows what is asked for; all else is left to Spark ML."""
    return (
        setting.keys() == FOREST_SPACE.keys() and setting["numTrees"] > 1 and 0 < setting["maxDepth"] <= 30
        and setting["featureSubsetStrategy"] in ("sqrt", "log2")
    )


def label_scarcity_sweep(
    train: DataFrame, held_out: Mapping[str, DataFrame], sizes: Sequence[int] = (100, 500, 1000), seed: int = 42,
    key: str = "entity_id", label: str = "label", max_iter: int = 1000,
) -> DataFrame:
    """Metrics of models fitted on few labels: a row per number of labels and held-out frame."""
    scored = []
    for size in sizes:
        model = fit_logistic(sample_rows(train, size, seed, key), label, max_iter=max_iter)
        for name, frame in held_out.items():
            part = predict_positive(model, frame, [label])
            scored.append(part.withColumns({"sample_size": F.lit(size), "data": F.lit(name)}))
    every = scored[0]
    for part in scored[1:]:
        every = every.unionByName(part)
    return evaluate(every, label=label, by=["sample_size", "data"])


def linear_probe(
    train: DataFrame, test: DataFrame, vector: str = "embedding", label: str = "label", max_iter: int = 1000
) -> DataFrame:
    """How well a linear model reads the label from the vectors: metrics on the test rows."""
    model = fit_logistic(to_features(train, vector, [label]), label, max_iter=max_iter)
    return evaluate(predict_positive(model, to_features(test, vector, [label]), [label]), label=label)


def pca_representation(df: DataFrame, k: int, keep: Sequence[str]) -> tuple[PCAModel, DataFrame]:
    """A low-dimensional code per row and the fitted model."""
    model = PCA(k=k, inputCol="features", outputCol="code").fit(df)
    return model, model.transform(df).select(*keep, "features", "code")


def reconstruction_error(model: PCAModel, df: DataFrame) -> DataFrame:
    """Mean squared error per element of rebuilding the centred rows from their codes: one row.

    The components are orthonormal, so what a code keeps of a row is the squared length of its centred part.
    """
    squares = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda s, v: s + v * v)
    code = vector_to_array("code")
    sizes = F.size(vector_to_array("features"))
    parts = df.select(squares.alias("sq"), vector_to_array("features").alias("x"), code.alias("c"), sizes.alias("d"))
    kept = F.aggregate("c", F.lit(0.0), lambda s, v: s + v * v)

    totals = parts.agg(
        F.avg("sq").alias("sq"),
        F.avg(kept).alias("kept"),
        F.max("d").alias("d"),
        vector_to_array(Summarizer.mean(array_to_vector("x"))).alias("mx"),
        vector_to_array(Summarizer.mean(array_to_vector("c"))).alias("mc"),
    )

    def square_sum(name: str):
        return F.aggregate(name, F.lit(0.0), lambda s, v: s + v * v)

    spread, explained = F.col("sq") - square_sum("mx"), F.col("kept") - square_sum("mc")
    return totals.select((F.greatest(spread - explained, F.lit(0.0)) / F.col("d")).alias("mse"))


def mlp_classifier(df: DataFrame, width: int, label: str = "label", hidden: int = 64, max_iter: int = 100, seed: int = 42):
    """One hidden layer over vectors of ``width``."""
    return MultilayerPerceptronClassifier(
        labelCol=label, featuresCol="features", layers=[width, hidden, 2], maxIter=max_iter, seed=seed
    ).fit(df)
