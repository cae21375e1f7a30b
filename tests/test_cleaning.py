from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from odoscan.config import Settings
from odoscan.functions.calendar import calendar, gap_category
from odoscan.operators import cleaning, rules, scoring, shaping, summaries
from odoscan.operators.series import steps
from odoscan.config import Track


def stamp(text):
    return datetime.fromisoformat(text)


def column(df, name, key="rec_id"):
    return [r[name] for r in df.orderBy(key).collect()]


def test_markers_numbers_times(spark):
    df = spark.createDataFrame(
        [(1, "-----", "2024-01-01 10:00:00", "0"), (2, "abc", "nonsense", "NaN"), (3, "4.5", None, "7")],
        "rec_id long, total_fuel string, timestamp string, speed_raw string",
    )
    nulls = cleaning.null_markers(df)
    assert column(nulls, "total_fuel") == [None, "abc", "4.5"]
    assert {r.column_name: r.null_count for r in cleaning.null_counts(nulls).collect()}["total_fuel"] == 1
    numbers = cleaning.parse_numbers(nulls)
    assert column(numbers, "total_fuel") == [None, None, 4.5]
    assert column(numbers, "speed_raw") == [0.0, None, 7.0]
    assert column(cleaning.parse_time(numbers), "rec_id") == [1]


def test_ignition(spark):
    df = spark.createDataFrame(
        [(1, None, "0"), (2, None, None), (3, None, "5"), (4, "1", "0"), (5, "0", "9")], "rec_id long, ignition_raw string, speed_raw string"
    )
    assert column(cleaning.fill_ignition(df), "ignition_raw") == [0, 0, 1, 1, 0]


def test_coordinates(spark):
    df = spark.createDataFrame(
        [(1, "4.5,-70.25"), (2, "4.5"), (3, "1,2,3"), (4, "90.01,180"), (5, None), (6, "x,5")], "rec_id long, coordinates string"
    )
    out = cleaning.split_coordinates(df)
    assert column(out, "Latitude") == [4.5, 4.5, 1.0, None, None, None]
    assert column(out, "Longitude") == [-70.25, None, 2.0, 180.0, None, 5.0]


def test_duplicates_keep_first_and_join_nulls(spark):
    t = stamp("2024-01-01")
    df = spark.createDataFrame(
        [(5, "V", t, None, 1.0), (2, "V", t, None, 2.0), (3, "V", t, 1.0, 3.0), (1, "W", t, None, 4.0)],
        "rec_id long, Vehicle_ID string, timestamp timestamp_ntz, total_fuel double, speed_raw double",
    )
    kept = cleaning.drop_duplicates(df)
    assert kept.columns == df.columns
    assert column(kept, "rec_id") == [1, 2, 3] and column(kept, "speed_raw") == [4.0, 2.0, 3.0]


def test_range_edges(spark):
    rows = [(1, 0.0, 0.0), (2, 200.0, 400.0), (3, 200.01, 1.0), (4, 1.0, 400.01), (5, 1.0, -0.01), (6, None, 1.0), (7, 1.0, None)]
    df = spark.createDataFrame(rows, "rec_id long, speed_raw double, total_fuel double")
    assert column(cleaning.filter_ranges(df), "rec_id") == [1, 2]
    assert column(cleaning.filter_ranges(df, keep_nulls=True), "rec_id") == [1, 2, 6, 7]


def test_validation_finds_each_issue(spark):
    t = stamp("2024-01-01")
    df = spark.createDataFrame(
        [(1, "V", t + timedelta(hours=1), None), (2, "V", t, None), (3, "W", None, None)],
        "rec_id long, Vehicle_ID string, timestamp timestamp_ntz, altitude double",
    )
    found = {r.issue: r.occurrences for r in cleaning.validate(df).collect()}
    assert found == {"missing_columns": 1, "empty": 0, "all_null_columns": 1, "null_times": 1, "time_travel": 1}
    empty = {r.issue: r.present for r in cleaning.validate(df.limit(0)).collect()}
    assert empty["empty"] == 1 and empty["time_travel"] == 0


def test_calendar_edges(spark):
    hours = [0, 5, 6, 7, 12, 18, 22, 23]
    times = [stamp("2024-01-06") + timedelta(hours=h) for h in hours]
    times += [stamp("2024-01-07 12:00"), stamp("2024-01-08 13:00")]
    df = spark.createDataFrame(list(enumerate(times)), "rec_id long, timestamp timestamp_ntz")
    out = calendar(df)
    assert column(out, "Is_NightTime") == [1, 1, 0, 0, 0, 0, 1, 1, 0, 0]
    assert column(out, "TimeOfDay") == ["Night"] * 3 + ["Morning"] * 2 + ["Afternoon"] + ["Evening"] * 2 + ["Morning", "Afternoon"]
    assert column(out, "DayOfWeek") == [5] * 8 + [6, 0]
    assert column(out, "IsWeekend") == [1] * 9 + [0]


def test_gap_edges(spark):
    gaps = [None, 0.0, -1.0, 5.0, 5.01, 15.0, 30.0, 60.0, 60.01]
    df = spark.createDataFrame(list(enumerate(gaps)), "rec_id long, Time_Diff double")
    want = [None, None, None, "Very_Short", "Short", "Short", "Medium", "Long", "Very_Long"]
    assert column(gap_category(df), "Time_Diff_Category") == want


def test_steps_on_ties_and_across_clock_changes(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = stamp("2024-03-10 01:30")
        times = [t, t, t + timedelta(hours=1), t + timedelta(hours=2)]
        df = spark.createDataFrame([(i, "V", x, float(i * i)) for i, x in enumerate(times)], "rec_id long, Vehicle_ID string, timestamp timestamp_ntz, total_fuel double")
        out = steps(df, Track())
        assert column(out, "Time_Diff") == [None, 0.0, 60.0, 60.0]
        assert column(out, "Fuel_Rate") == [0.0, 0.0, 3.0 / 60, 5.0 / 60]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_duplicate_columns(spark):
    df = spark.createDataFrame([(1, None, 5.0, "a")], "a int, b double, c double, d string")
    names = ["id", "fuel", "fuel", "place"]
    assert shaping.duplicate_columns(names) == {"fuel": [1, 2]}
    assert shaping.drop_duplicate_columns(df, names).first().asDict() == {"id": 1, "fuel": None, "place": "a"}
    assert shaping.drop_duplicate_columns(df, names, "last").first()["fuel"] == 5.0
    assert shaping.drop_duplicate_columns(df, names, "filled").first()["fuel"] == 5.0


def test_downcast_bounds_are_strict(spark):
    df = spark.createDataFrame([(127, 126, 40000, 1e300), (0, 0, 0, 0.0)], "a long, b long, c long, d double")
    types = dict(shaping.downcast(df).dtypes)
    assert types == {"a": "smallint", "b": "tinyint", "c": "int", "d": "double"}


def test_feature_stats_match_pandas(spark):
    rows = pd.DataFrame({"x": [1.0, 2.0, 2.0, 7.5, None, 3.0], "y": [1.0, None, None, None, None, 2.0]})
    df = spark.createDataFrame(rows).select(*[F.nanvl(c, F.lit(None)).alias(c) for c in rows])
    got = {r.feature: r for r in summaries.feature_stats(df, ["x", "y"], digits=9).collect()}
    assert got["x"]["skewness"] == pytest.approx(rows["x"].skew()) and got["x"]["kurtosis"] == pytest.approx(rows["x"].kurt())
    assert got["x"]["q25"] == rows["x"].quantile(0.25) and got["x"]["unique_count"] == 4 and got["x"]["missing_count"] == 1
    assert got["y"]["skewness"] is None and got["y"]["kurtosis"] is None


def test_scores_without_spread_or_alerts(spark):
    df = spark.createDataFrame([(i, 0.5, -1.0) for i in range(4)], "rec_id long, Priority_Score double, Fuel_Diff double")
    assert column(scoring.priority_bands(df), "Priority") == ["Low"] * 4
    zero = df.withColumn("s", F.lit(0.0))
    assert column(rules.over_maximum(zero, "s"), "s") == [0.0] * 4
    assert scoring.alert_priority(df.withColumns({"Final_Prediction": F.lit(0), "Final_Score": F.lit(0.1)})).count() == 0


def test_rules_without_inputs_never_fire(spark):
    df = spark.createDataFrame([(1, -50.0)], "rec_id long, Fuel_Diff double")
    row = rules.rule_score(df, Settings()).first()
    assert row["Anomaly_Score"] == 0.0 and row["Anomaly_night_loss"] == 0
