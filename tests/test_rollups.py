"""Rollups: weights with gaps, two-step means, change, completion, levels."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from phasewright.functions import calendar as X
from phasewright.functions.stats import wmean
from phasewright.operators import rollups as A
from phasewright.operators import runs as R
from phasewright.operators import travel as V
from phasewright.operators.detectors import subcorridor_view
from tests.conftest import DAY, at, rows

MEASURE = "SignalID string, CallPhase int, Date date, Week int, v double, w int"


def _measure(spark, *data):
    df = spark.createDataFrame([(s, p, d, 0, v, w) for s, p, d, v, w in data], MEASURE)
    return df.withColumn("Week", X.week("Date"))


def _corridors(spark):
    data = [("1", "G1", "Z1", "A"), ("2", "G1", "Z1", "A"), ("3", "G1", "Z1", "B"), ("9", "G1", "Z1", None)]
    return spark.createDataFrame(
        [(*r, f"{r[3]}-0", f"name {r[0]}", f"{r[0]}: name") for r in data],
        "SignalID string, Zone_Group string, Zone string, Corridor string, Subcorridor string, Name string, Description string",
    )


def test_wmean_leaves_missing_values_out_of_the_weights(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", None, 100), ("a", 4.0, 2), ("b", None, 3)], "k string, v double, w int")
    assert rows(df.groupBy("k").agg(wmean("v", "w").alias("m"), F.sum("w").alias("w"))) == [("a", 3.0, 103), ("b", None, 3)]


def test_change_is_from_the_previous_row_present_and_null_after_zero(spark):
    d = [DAY + timedelta(days=i) for i in (0, 1, 5)]
    out = A.period_sum(_measure(spark, ("1", 2, d[0], 10.0, 1), ("1", 2, d[1], 0.0, 1), ("1", 2, d[2], 5.0, 1)), "v", "Date")
    assert rows(out, "Date", "v", "delta") == [(d[0], 10.0, None), (d[1], 0.0, -1.0), (d[2], 5.0, None)]


def test_monthly_unweighted_sums_phases_and_weighted_averages_them(spark):
    df = _measure(spark, ("1", 2, DAY, 10.0, 1), ("1", 2, DAY + timedelta(days=1), 20.0, 1), ("1", 6, DAY, 5.0, 3))
    assert rows(A.monthly_avg(df, "v"), "v") == [(20.0,)]
    assert rows(A.monthly_avg(df, "v", "w"), "v", "w") == [((15.0 * 2 + 5.0 * 3) / 5, 5)]


def test_missing_months_and_weeks_appear(spark):
    far = DAY + timedelta(days=70)
    df = _measure(spark, ("1", 2, DAY, 10.0, 1), ("1", 2, far, 20.0, 1))
    assert rows(A.monthly_avg(df, "v", "w"), "Month", "v") == [(date(2024, 1, 1), 10.0), (date(2024, 2, 1), None), (date(2024, 3, 1), 20.0)]
    weeks = A.weekly_avg(df, "v", "w", peak_only=False)
    assert weeks.count() == 11 and weeks.where("v is null").count() == 9
    assert A.daily_sum(df, "v").count() == 71


def test_one_row_per_first_week_starting_on_a_sunday(spark):
    sunday = date(2023, 12, 31)
    out = A.weekly_sum(_measure(spark, ("1", 2, sunday, 10.0, 1), ("1", 2, sunday + timedelta(days=3), 20.0, 1)), "v")
    assert rows(out, "Date", "v") == [(date(2024, 1, 2), 15.0)]


@pytest.mark.parametrize("day,week", [("2016-12-25", 0), ("2016-12-31", 0), ("2017-01-01", 1), ("2016-12-19", 0), ("2016-12-18", -1), ("2024-01-02", 366)])
def test_week_numbers(spark, day, week):
    assert spark.range(1).select(X.week(F.lit(day).cast("date"))).collect()[0][0] == week


@pytest.mark.parametrize("day", ["1995-03-01", "2016-12-14", "2017-01-02", "2024-02-29"])
def test_tuesday_lies_in_its_week(spark, day):
    d = F.lit(day).cast("date")
    tue = X.tuesday_of_week(X.week(d), F.lit("1990-01-01"))
    dow, same = spark.range(1).select(F.dayofweek(tue), X.week(tue) == X.week(d)).collect()[0]
    assert (dow, same) == (3, True)


def test_period_floors_and_projections(spark):
    one = spark.createDataFrame([(at("13:44:59.5"),)], "t timestamp_ntz")
    got = one.select(X.floor_minutes("t", 15), X.floor_minutes("t", 1440), X.onto_month_start("t"), X.onto_year_start("t"), X.round_to_tuesday(F.lit("2024-01-05"))).collect()[0]
    assert tuple(got) == (at("13:30"), at("0:00"), at("13:44:59.5", date(2024, 1, 1)), at("13:44:59.5", date(2024, 1, 1)), DAY)


def test_corridors_and_zone_groups(spark):
    df = _measure(spark, ("1", 2, DAY, 1.0, 1), ("2", 2, DAY, 4.0, 3), ("3", 2, DAY, 10.0, 4), ("9", 2, DAY, 99.0, 9), ("77", 2, DAY, 99.0, 9))
    out = A.corridor_rollup(df, _corridors(spark), "v", "w", period="Date")
    cors = {r["Corridor"]: (r["Zone_Group"], r["v"], r["w"]) for r in out.collect()}
    assert cors["A"] == ("Z1", 3.25, 4) and cors["B"] == ("Z1", 10.0, 4)
    # The zone group is the weighted mean of its corridors.
    assert cors["G1"] == ("G1", (3.25 * 4 + 10.0 * 4) / 8, 8)


def test_signal_rows_carry_their_corridor_and_its_total(spark):
    df = A.period_avg(_measure(spark, ("1", 2, DAY, 1.0, 1)), "v", "Date", "w")
    cor = A.corridor_by_date(df, _corridors(spark), "v", "w")
    out = A.signal_rows(df, cor, _corridors(spark))
    assert rows(out, "Zone_Group", "Corridor", "Description", "v") == [("A", "1", "1: name", 1.0), ("A", "A", "A", 1.0)]


def test_subcorridor_view_moves_down_one_level(spark):
    got = rows(subcorridor_view(_corridors(spark)).where("SignalID = '1'"), "Zone_Group", "Zone", "Corridor")
    assert got == [("Z1", "A", "A-0")]


def test_quarters(spark):
    mo = spark.createDataFrame([("A", "G", date(2024, m, 1), v, w) for m, v, w in [(1, 1.0, 1), (2, 3.0, 3), (4, 10.0, 1)]], "Corridor string, Zone_Group string, Month date, v double, w int")
    assert rows(A.quarterly(mo, "v", "w"), "Quarter", "v", "delta") == [("2024.1", 2.5, None), ("2024.2", 10.0, 3.0)]
    assert rows(A.quarterly(mo, "v", "w", "latest"), "Quarter", "v") == [("2024.1", 3.0), ("2024.2", 10.0)]
    assert rows(A.quarterly(mo, "v", operation="sum"), "Quarter", "v") == [("2024.1", 4.0), ("2024.2", 10.0)]
    with pytest.raises(ValueError):
        A.quarterly(mo, "v", operation="other")


def test_detector_uptime_drops_silent_periods(spark):
    fc = spark.createDataFrame(
        [("1", 2, 1, DAY, at("8:00"), 5.0, 1), ("1", 2, 2, DAY, at("8:00"), None, 0), ("1", 4, 3, DAY, at("8:00"), 1.0, 1), ("1", 2, 1, DAY, at("9:00"), 0.0, 1)],
        "SignalID string, CallPhase int, Detector int, Date date, Timeperiod timestamp_ntz, vol double, Good_Day int",
    )
    out = A.daily_detector_uptime(fc)
    assert rows(out, "CallPhase", "setback", "uptime", "all") == [(2, "Setback", 0.5, 2.0), (4, "Presence", 1.0, 1.0)]
    avg = A.avg_daily_detector_uptime(out).collect()[0]
    assert (avg["uptime"], avg["uptime_sb"], avg["uptime_pr"]) == (pytest.approx(2 / 3), 0.5, 1.0)


def test_runs(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([1, 1, 2, 2, 2, 1])], "k string, i int, v int")
    assert [r["run"] for r in R.run_length(df, ["k"], "i", "v", "run").orderBy("i").collect()] == [1, 2, 1, 2, 3, 1]
    days = spark.createDataFrame([("a", DAY + timedelta(days=i)) for i in (0, 1, 2, 4, 5)], "k string, d date")
    assert [r["s"] for r in R.day_streak(days, ["k"], "d", "s").orderBy("d").collect()] == [1, 2, 3, 1, 2]
    zeros = spark.createDataFrame([("a", i, v) for i, v in enumerate([0, 3, 0, 0, 5, 0])], "k string, i int, v int")
    assert [r["z"] for r in R.zero_streak_id(zeros, ["k"], "i", "v", "z").orderBy("i").collect()] == [None, None, 2, 2, None, 5]


def test_travel_time_indexes(spark):
    d = [("A", at("8:00") + timedelta(days=i), float(t), 10.0, 5.0) for i, t in enumerate([10, 20, 30])]
    df = spark.createDataFrame(d, "Corridor string, Hour timestamp_ntz, travel_time_minutes double, reference_minutes double, miles double")
    out = V.travel_time_metrics(df, ["Corridor"]).collect()[0]
    assert (out["tti"], out["pti"], out["bi"]) == (2.0, pytest.approx(2.8), pytest.approx(0.8))
    assert out["Hour"] == at("8:00", date(2024, 1, 1)) and out["speed_mph"] == pytest.approx((30 + 15 + 10) / 3)


def test_hour_share_is_one_where_unknown(spark):
    c = "Zone_Group string, Zone string, Corridor string, Hour timestamp_ntz"
    ti = spark.createDataFrame([("G", "Z", "A", at("8:00"), 1.5), ("G", "Z", "A", at("9:00"), 1.5)], c + ", tti double")
    vph = spark.createDataFrame([("G", "Z", "A", at("8:00"), 30.0), ("G", "Z", "A", at("10:00"), 10.0)], c + ", vph double")
    assert rows(V.with_hour_shares(ti, vph), "Hour", "pct") == [(at("8:00"), 0.75), (at("9:00"), 1.0)]


def test_points_of_a_segment(spark):
    s = spark.createDataFrame([("a", "-80.5 30.1, -80.6 30.2"), ("b", "x'1 2, 3 4'y")], "tmc string, coordinates string")
    assert rows(V.segment_points(s)) == [("a", 0, -80.5, 30.1), ("a", 1, -80.6, 30.2), ("b", 0, 1.0, 2.0), ("b", 1, 3.0, 4.0)]
