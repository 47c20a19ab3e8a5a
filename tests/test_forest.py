"""Forests grown side by side: Spark ML's trees, draws and scores, in few jobs."""

import uuid

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohort_spark.functions import draws
from cohort_spark.operators import forest, models
from cohort_spark.session import shared_folder

NAMES = ["a", "b", "c", "d", "e"]
SPACE = {"numTrees": [4, 6], "maxDepth": [2, 5], "minInstancesPerNode": [1, 2], "featureSubsetStrategy": ["sqrt", "log2"]}


def table(spark, frame, n, folds=3, seed=1, constant=False):
    """Columns with ties, zeros and few values, on three partitions."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 5)), 2)
    x[:, 2] = 7 if constant else rng.integers(0, 4, n)
    x[:, 3] = np.where(rng.random(n) < 0.5, 0, x[:, 3])
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) > 0).astype(int)
    data = [(i, *map(float, v), int(k), i % folds) for i, (v, k) in enumerate(zip(x, y))]
    df = frame("id int, a double, b double, c double, d double, e double, label int, fold int", data).repartition(3, "id")
    shared_folder(spark)
    return models.to_features(df, NAMES, ["label", "fold"]).checkpoint()


def grown(df, setting, folds=3):
    rows = df.select(F.monotonically_increasing_id().alias("id"), vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), "fold")
    forests, cuts = forest.grow_forests(rows, [setting], forest._checked(rows, folds), folds, 42)
    return forests[0], cuts[0]


def ours(f, cuts):
    child, vote = f.votes()

    def text(n):
        if child[n] < 0:
            return f"{vote[n]:.12f}"
        return f"({f.feature[n]} <= {float(cuts[f.feature[n]][f.cut[n]])!r}: {text(child[n])}, {text(child[n] + 1)})"

    return [text(t) for t in range(f.setting.trees)]


def theirs(model):
    def text(n):
        if n.getClass().getSimpleName() == "LeafNode":
            a, b = n.impurityStats().stats()
            return f"{b / max(a + b, 1):.12f}"
        return f"({n.split().featureIndex()} <= {n.split().threshold()!r}: {text(n.leftChild())}, {text(n.rightChild())})"

    return [text(t.rootNode()) for t in model._java_obj.trees()]


def spark_forest(df, setting, **options):
    return RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=setting.trees, maxDepth=setting.depth, seed=42,
        minInstancesPerNode=setting.least, featureSubsetStrategy=str(setting.features), **options,
    ).fit(df.where("fold <> 0"))


@pytest.mark.parametrize("setting", [forest.Setting(6, 6, 1, 3), forest.Setting(5, 4, 3, 2), forest.Setting(3, 3, 1, 5)])
def test_trees_are_spark_mls(spark, frame, setting):
    df = table(spark, frame, 300, constant=setting.features == 2)
    assert ours(*grown(df, setting)) == theirs(spark_forest(df, setting))


def test_blocks_of_rows_and_groups_of_nodes_change_no_tree(spark, frame, monkeypatch):
    df, setting = table(spark, frame, 120), forest.Setting(120, 5, 1, 3)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 25)
    monkeypatch.setattr(forest, "GROUP_BYTES", 1 << 20)
    want = theirs(spark_forest(df, setting, maxMemoryInMB=1))
    assert ours(*grown(df, setting)) == want
    assert max(map(len, want)) > 400  # deep enough that a level doesn't fit a group


def test_few_rows(spark, frame):
    df, setting = table(spark, frame, 14, folds=2), forest.Setting(5, 4, 1, 3)
    assert ours(*grown(df, setting, folds=2)) == theirs(spark_forest(df, setting))


def test_a_search_scores_as_cross_validation_does_in_few_jobs(spark, frame):
    df = table(spark, frame, 240)
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    best, scores = models.random_search_forest(df, space=SPACE, draws=6, folds=3)
    found = [tuple(r) for r in scores.collect()]
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 120  # a search of Spark ML runs about ten jobs for each of 18 fits, and as many to score it
    estimator = RandomForestClassifier(labelCol="label", featuresCol="features", seed=42)
    kinds = [int, int, int, str]
    grid = [{estimator.getParam(n): kind(v) for n, kind, v in zip(SPACE, kinds, r)} for r in found]
    model, want = models._search(df, estimator, grid, "label", 3, 4, list(SPACE))
    for a, b in zip(found, want.collect(), strict=True):
        assert a[:4] == tuple(b)[:4] and a[4] == pytest.approx(b.auroc, abs=1e-12)
    assert theirs(best) == theirs(model)


def test_a_fold_of_one_class_scores_as_sparks_curve(spark, frame):
    df = table(spark, frame, 60).withColumn("label", F.when(F.col("fold") == 0, 1).when(F.col("fold") == 1, 0).otherwise(F.col("label")))
    space = {n: v[:1] for n, v in SPACE.items()}
    found = models.random_search_forest(df, space=space, folds=3)[1].first().auroc
    estimator = RandomForestClassifier(labelCol="label", featuresCol="features", seed=42)
    grid = [{estimator.getParam(n): v[0] for n, v in space.items()}]
    assert found == pytest.approx(models._search(df, estimator, grid, "label", 3, 1, list(space))[1].first().auroc, abs=1e-12)


def test_bad_input_is_an_error(spark, frame):
    df = table(spark, frame, 30)
    for bad in (df.withColumn("label", F.lit(2)), df.withColumn("label", F.lit(None).cast("int")), df.withColumn("label", F.lit(0)), df.where("fold = 1"), df.withColumn("fold", F.col("fold") + 1)):
        with pytest.raises(ValueError):
            models.random_search_forest(bad, space=SPACE, draws=1, folds=3)


def test_cuts_of_many_values_are_those_of_a_walk_over_all(spark, frame):
    df = table(spark, frame, 900)
    x, fold = (np.array(v) for v in zip(*[(r.features.toArray(), r.fold) for r in df.collect()]))
    rows = df.select(F.monotonically_increasing_id().alias("id"), vector_to_array("features").alias("x"), "fold")
    got = forest.find_cuts(rows, [int((fold != f).sum()) for f in range(3)])
    for f in range(3):
        for j in range(5):
            values, counts = np.unique(x[fold != f, j] + 0.0, return_counts=True)
            want = forest.walk_cuts(values, counts, counts.cumsum() - counts, int(counts.sum()), 31)
            assert got[f][j].tolist() == want


def test_draws_are_the_jvms(spark):
    jvm = spark.sparkContext._jvm
    law = jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
    law.reseedRandomGenerator(45)
    want = [int(v) for v in jvm.java.util.Arrays.toString(law.sample(3000))[1:-1].split(",")]
    bags = draws.Bags(45)
    assert bags.take(0, 1000).tolist() == want[:1000] and bags.take(500, 2500).tolist() == want[500:]
    source = jvm.java.util.Random(42)
    longs, states = draws.java_longs(draws.java_state(42), 100)
    assert longs.tolist() == [source.nextLong() for _ in range(100)]
    assert draws.java_longs(int(states[59]), 40)[0].tolist() == longs[60:].tolist()
    for size in (3, 4, 40, 200):
        keys = np.random.default_rng(size).permutation(250)[:size].tolist()
        made = jvm.scala.collection.mutable.HashMap()
        for k in keys:
            made.put(k, k)
        walk, order = getattr(jvm.scala.collection.immutable.Map, "from")(made).keysIterator(), []
        while walk.hasNext():
            order.append(walk.next())
        assert draws.map_order(sorted(keys)) == order
