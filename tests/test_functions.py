import pytest
from pyspark.sql import functions as F

from cohort_spark.functions import answers, numeric, rules, time
from tests.conftest import rows


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_elapsed_clock_runs_past_a_day(frame):
    df = frame("t string", [("00:00",), ("00:07",), ("23:59",), ("24:00",), ("47:37",), (None,)])
    at = time.elapsed_to_timestamp(F.col("t"), "2025-03-10 00:00:00")
    got = [str(x) for x in column(df, at)]
    assert got == [
        "2025-03-10 00:00:00", "2025-03-10 00:07:00", "2025-03-10 23:59:00", "2025-03-11 00:00:00",
        "2025-03-11 23:37:00", "None",
    ]


def test_ceil_to_hour_keeps_full_hours(frame):
    df = frame("ts timestamp_ntz", [("2025-03-10 01:00:00",), ("2025-03-10 01:00:01",), ("2025-03-10 23:07:00",)])
    got = [str(x) for x in column(df, time.ceil_to_hour(F.col("ts")))]
    assert got == ["2025-03-10 01:00:00", "2025-03-10 02:00:00", "2025-03-11 00:00:00"]


def test_normalized_time(frame):
    df = frame("ts timestamp_ntz", [("2025-03-10 00:00:00",), ("2025-03-11 00:00:00",), ("2025-03-12 00:00:00",)])
    assert column(df, time.normalize_time(F.col("ts"), "2025-03-10 00:00:00", 48)) == [0.0, 0.5, 1.0]


@pytest.mark.parametrize(
    "name, values, expected",
    [
        ("pH", [7.4, 65.0, 74.0, 80.0, 650.0, 735.0, 800.0, None], [7.4, 6.5, 7.4, 8.0, 6.5, 7.35, 8.0, None]),
        ("Height", [99.9, 100.0, 299.9, 300.0, -1.0], [None, 100.0, 299.9, None, None]),
        ("Weight", [19.9, 20.0, 300.0], [None, 20.0, None]),
        ("PaO2", [0.0, 7.47, 80.0], [None, 74.7, 80.0]),
        ("Temp", [-17.8, 20.0, None], [None, 20.0, None]),
    ],
)
def test_measurement_rules(frame, name, values, expected):
    df = frame("x double", [(v,) for v in values])
    assert column(df, rules.apply_rules(F.col("x"), rules.MEASUREMENT_RULES[name])) == expected


def test_probabilities(frame):
    df = frame("a double, b double", [(0.0, 0.0), (1.0, 3.0)])
    two = column(df, numeric.softmax_positive([F.col("a"), F.col("b")]))
    assert two[0] == 0.5 and abs(two[1] - 0.8807970779778823) < 1e-12
    with pytest.raises(ValueError):
        numeric.softmax_positive([F.col("a")] * 3)


def test_bins_are_centred_and_close_right(frame):
    df = frame("x double", [(0.0,), (2.5,), (2.6,), (7.5,), (-2.5,)])
    assert column(df, numeric.bin_centre(F.col("x"), 5)) == [0.0, 0.0, 5.0, 5.0, -5.0]


ANSWERS = ["7/10", "Answer: 0", "<think>3\n</think> 1", "unlikely", "no idea", "", "42", "0.5", None]


def test_answers(frame):
    df = frame("id int, x string", list(enumerate(ANSWERS)))
    got = rows(
        df.select(
            "id",
            answers.clean_llm_output(F.col("x")),
            answers.extract_score(F.col("x"), "score"),
            answers.extract_score(F.col("x"), "binary"),
            answers.extract_score(F.col("x"), "binary", strict=True),
        ),
        "id",
    )
    assert [r[1] for r in got] == ["7/10", "0", "1", "unlikely", "no idea", "", "42", "0.5", None]
    assert [r[2] for r in got] == [0.7, 0.1, 0.1, 0.5, 0.5, 0.5, 1.0, 0.1, 0.5]
    assert [r[3] for r in got] == [0.5, 0.0, 1.0, 1.0, 0.0, 0.5, 0.5, 0.5, 0.5]
    assert [r[4] for r in got] == [0.5, 0.0, 1.0, 0.0, 0.0, 0.5, 0.5, 0.5, 0.5]
