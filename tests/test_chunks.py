"""Chunks of histories: bounded by rows, in order, and without effect on results."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_spark.operators import aggregate, impute
from cohort_spark.operators.summaries import trend_labels
from cohort_spark.plans.chunks import CHUNK, Chunks, number_rows, with_chunks
from cohort_spark.plans.runs import exact_quantiles, value_runs, with_value_chunks
from tests.conftest import rows

EVENTS = "entity_id bigint, ts timestamp_ntz, event_id bigint, x double"


def history(seed=5):
    """A third of all rows are one entity's, most of them within one hour, many of those on one time stamp."""
    rng, start = random.Random(seed), dt.datetime(2024, 1, 1)
    data = []

    def add(entity, seconds):
        data.append((entity, str(start + dt.timedelta(seconds=seconds)), len(data), None if rng.random() < 0.5 else float(rng.randint(0, 9))))

    for _ in range(300):
        add(1, rng.randrange(0, 86400 * 30))
    for _ in range(400):
        add(1, 86400 * 9 + rng.randrange(0, 3600))
    for _ in range(300):
        add(1, 86400 * 20 + 7)  # one time stamp
    for _ in range(2000):
        add(rng.randrange(2, 200), rng.randrange(0, 86400 * 30))
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("size", [10, 50, 400])
def test_chunks_are_bounded_and_in_order(frame, size):
    df = frame(EVENTS, history())
    cut = with_chunks(df, ["entity_id"], ["ts", "event_id"], Chunks(rows=size))
    sizes = cut.groupBy("entity_id", CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] < 2 * size
    assert sizes.where("entity_id = 1").count() >= 1000 // (2 * size)
    assert sizes.where("entity_id > 1").count() == df.where("entity_id > 1").select("entity_id").distinct().count() or size < 50
    ordered = [(r.entity_id, r.ts, r.event_id, r[CHUNK]) for r in cut.collect()]
    for entity in (1, 2, 3):
        place = [c for *_, c in sorted(r for r in ordered if r[0] == entity)]
        assert place == sorted(place)


def test_one_time_stamp_without_a_second_order_is_one_chunk(frame):
    df = frame(EVENTS, history())
    cut = with_chunks(df.where("entity_id = 1"), ["entity_id"], ["ts"], Chunks(rows=100))
    assert cut.groupBy("ts").agg(F.countDistinct(CHUNK).alias("n")).where("n > 1").count() == 0


def test_empty_and_null_times(frame):
    df = frame(EVENTS, [(1, None, 1, 1.0), (1, "2024-01-01 00:00:00", 2, None), (None, "2024-01-01 00:00:00", 3, 1.0)])
    assert with_chunks(df, ["entity_id"], ["ts"], Chunks(rows=1)).where(f"{CHUNK} is null").count() == 0
    assert with_chunks(df.limit(0), ["entity_id"], ["ts", "event_id"], Chunks(rows=1)).count() == 0


@pytest.mark.parametrize("size", [7, 60])
def test_results_are_those_of_plain_windows(frame, size):
    df = frame(EVENTS, history(6))
    order = ["ts", "event_id"]
    key = ("entity_id", "event_id")
    chunked, plain = {"chunk_rows": size}, {"chunk_hours": None}
    assert rows(impute.forward_fill(df, ["x"], order, **chunked), *key) == rows(impute.forward_fill(df, ["x"], order, **plain), *key)
    for lags in ([1], [2, 9]):
        made = [aggregate.lag_features(df, ["x"], order, lags, **how) for how in (chunked, plain)]
        assert rows(made[0], *key) == rows(made[1], *key)
    numbered = [number_rows(df, ["entity_id"], order, "at", cut, total="n").select(*key, "at", "n") for cut in (Chunks(rows=size), None)]
    assert rows(numbered[0], *key) == rows(numbered[1], *key)
    made = [aggregate.autocorrelations(df, ["x"], order, **how).select(F.round("acf", 9), "entities") for how in (chunked, plain)]
    assert rows(made[0]) == rows(made[1])
    apart = df.dropDuplicates(["entity_id", "ts"])
    filled = [impute.interpolate_time(apart, ["x"], **how) for how in (chunked, plain)]
    assert rows(filled[0], *key) == rows(filled[1], *key)
    axes = [impute.interpolate_time(apart, ["x"], scope="global", **how) for how in (chunked, plain)]
    assert rows(axes[0], *key) == rows(axes[1], *key)
    trends = [trend_labels(apart, ["x"], **how) for how in (chunked, plain)]
    assert rows(trends[0], "entity_id") == rows(trends[1], "entity_id")


def test_no_window_task_of_a_query_is_large(spark, frame):
    """The events of a hot entity in a window plan: no partition of the window holds more than its chunks do."""
    start = dt.datetime(2024, 1, 1)
    data = [(1 if i % 3 == 0 else i, str(start + dt.timedelta(minutes=i)), i, None) for i in range(6000)]
    cut = with_chunks(frame(EVENTS, data), ["entity_id"], ["ts", "event_id"], Chunks(rows=100))
    dealt = cut.repartition(64, "entity_id", CHUNK).groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count")).first()[0] < 600  # 94 rows a partition on average, chunks of fewer than 200


def test_the_frame_is_returned_without_a_job(spark, frame):
    df = frame(EVENTS, history())
    df.cache().count()
    group = "chunks-without-a-job"
    spark.sparkContext.setJobGroup(group, group)
    impute.forward_fill(df, ["x"], ["ts", "event_id"], chunk_rows=50)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def values(seed=8):
    rng = random.Random(seed)
    wild = [0.0, -0.0, 1e300, -1e300, float("inf"), float("-inf"), float("nan"), None, 5e-324]
    data = [(rng.choice("aab"), rng.choice([rng.choice(wild), float(rng.randint(0, 40)), rng.random(), 1e9 + rng.random()])) for _ in range(3000)]
    return data + [(None, 3.0), (None, 4.0)]


@pytest.mark.parametrize("size", [1, 40, 1 << 18])
def test_running_totals_and_quantiles(frame, size):
    df = frame("g string, x double", values())
    known = [(g, x) for g, x in values() if x is not None and x == x]
    runs = value_runs(df, "x", {"n": F.lit(1).cast("bigint")}, ["g"], size).collect()
    assert {(r.g, r.x): (r.n, r.n_before, r.n_all) for r in runs} == {
        (g, x): (
            sum(1 for h, y in known if h == g and y == x),
            sum(1 for h, y in known if h == g and y < x),
            sum(1 for h, _ in known if h == g),
        )
        for g, x in set(known)
    }
    finite = df.where("abs(x) < 1e12")
    got = {r.g: (r.a, r.b) for r in exact_quantiles(finite, "x", {"a": 0.5, "b": 0.9}, ["g"], size).collect()}
    for g in ("a", "b"):
        column = [x for h, x in known if h == g and abs(x) < 1e12]
        assert got[g] == pytest.approx(tuple(np.quantile(column, [0.5, 0.9])))
    assert exact_quantiles(df.where("x is null"), "x", {"a": 0.5}, ["g"], size).count() == 0


def test_value_chunks_are_balanced_and_share_one_scan(frame):
    df = frame("g string, x double", [("a", float(i) ** 3) for i in range(4000)])
    counted = df.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    sizes = [r["count"] for r in with_value_chunks(counted, "x", ["n"], 200).groupBy(CHUNK).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 260


def test_quantiles_run_no_job_before_and_count_once(spark, frame, tmp_path):
    df = frame("g string, x double", values())
    df.write.parquet(f"{tmp_path}/x")
    df = spark.read.parquet(f"{tmp_path}/x")
    group = "values-without-a-job"
    spark.sparkContext.setJobGroup(group, group)
    found = exact_quantiles(df, "x", {"a": 0.5}, ["g"], 40)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("FileScan parquet") == 1, final
