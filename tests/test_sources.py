"""Files in and out, and the stream."""

from pyspark.sql import functions as F

from cohort_spark.operators.reshape import discretize
from cohort_spark.sources import observations, stages, tables
from cohort_spark.streaming.hourly import discretize_stream
from tests.conftest import rows

FILES = {
    "132539.txt": "Time,Parameter,Value\n00:00,RecordID,132539\n00:00,Age,54\n00:07,HR,73\n00:07,HR,75\n00:37,HR,77\n24:00,HR,60\n",
    "132540.txt": "Time,Parameter,Value\n00:00,RecordID,132540\n00:00,Age,-1\n47:37,Temp,36.6\n01:00,,5\n",
}


def test_observation_files_become_an_hourly_panel(spark, tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    raw = observations.extract_entity_id(observations.read_observations(spark, f"{tmp_path}/*.txt"))
    assert raw.where("Parameter = 'RecordID'").count() == 0
    assert rows(raw.groupBy("entity_id").count()) == [(132539, 5), (132540, 3)]
    panel = observations.ingest_panel(spark, f"{tmp_path}/*.txt", ["Age", "HR", "Temp"], "2025-03-10 00:00:00")
    got = [(e, str(t), *v) for e, t, *v in rows(panel, "entity_id", "ts")]
    assert got == [
        (132539, "2025-03-10 00:00:00", 54.0, None, None),
        (132539, "2025-03-10 01:00:00", None, 75.0, None),  # mean of the first 73 at 00:07 and 77 at 00:37
        (132539, "2025-03-11 00:00:00", None, 60.0, None),
        (132540, "2025-03-10 00:00:00", -1.0, None, None),
        (132540, "2025-03-12 00:00:00", None, None, 36.6),
    ]


def test_stages_overwrite_one_split_and_prune(spark, frame, tmp_path):
    root = str(tmp_path / "stages")
    df = frame("entity_id bigint, ICUType int", [(1, 2), (2, 3)])
    for split in "abc":
        stages.write_stage(df, root, "final", split)
    stages.write_stage(df.where("entity_id = 1"), root, "final", "b")
    assert rows(stages.load_stage(spark, root, "final").groupBy("split").count()) == [("a", 2), ("b", 1), ("c", 2)]
    final = stages.load_final(spark, root, "b")
    assert final.columns == ["entity_id", "split"] and final.count() == 1
    plan = final._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_text_csv_keeps_lines_quotes_and_nulls(spark, frame, tmp_path):
    df = frame("entity_id bigint, summary string, label int", [(1, 'two\nlines, "quoted"', 1), (2, None, None), (3, "", 0)])
    tables.write_text_csv(df, str(tmp_path / "t"))
    back = tables.read_text_csv(spark, str(tmp_path / "t"), "entity_id bigint, summary string, label int")
    assert rows(back) == rows(df)


def test_outcomes_and_embeddings(spark, frame, tmp_path):
    (tmp_path / "o.txt").write_text("RecordID,SAPS-I,SOFA,Length_of_stay,Survival,In-hospital_death\n7,6,1,5,-1,0\n8,16,8,8,-1,1\n")
    assert rows(tables.load_outcomes(spark, str(tmp_path / "o.txt"))) == [(7, 0), (8, 1)]
    df = frame("vec_id bigint, a float, b float", [(1, 0.5, 2.0), (2, -1.5, 0.25)])
    vecs = df.select("vec_id", F.array("a", "b").alias("embedding"))
    tables.write_embeddings_csv(vecs, str(tmp_path / "v"), 2, ["vec_id"])
    assert rows(tables.read_embeddings_csv(spark, str(tmp_path / "v"), 2, {"vec_id": "bigint"})) == rows(vecs)


def test_stream_gives_the_same_hours(spark, frame, tmp_path):
    data = [(1, f"2024-01-01 0{h}:{m}:00", "HR", float(h * 10 + int(m))) for h in range(5) for m in ("00", "20", "40")]
    df = frame("entity_id bigint, ts timestamp_ntz, variable string, value double", data)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (
        discretize_stream(stream, ["HR"], delay="1 minute").writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "out")), "ts")
    wide = df.select("entity_id", "ts", F.col("value").alias("HR"))
    want = rows(discretize(wide, ["HR"]), "ts")
    assert got and got == want[: len(got)] and len(got) >= len(want) - 2


def test_first_of_equal_times_counts_in_the_stream(spark, frame, tmp_path):
    schema = "entity_id bigint, ts timestamp_ntz, variable string, value double"
    first = [(1, f"2024-01-01 00:{m}:00", "HR", float(m)) for m in ("10", "20", "30")]
    again = [(1, "2024-01-01 00:20:00", "HR", 900.0), (1, "2024-01-01 00:40:00", "HR", None), (1, "2024-01-01 03:00:00", "HR", 1.0)]
    for part, data in enumerate((first, again, [(1, "2024-01-01 09:00:00", "HR", 2.0)])):
        frame(schema, data).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(frame(schema, data).schema).parquet(str(tmp_path / "in"))
        query = (
            discretize_stream(stream, ["HR"], delay="1 hour").writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
        )
        query.awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "out")), "ts")
    assert (got[0][0], str(got[0][1]), got[0][2]) == (1, "2024-01-01 01:00:00", 20.0)
