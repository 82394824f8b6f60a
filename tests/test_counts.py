"""Detector-day filter and imputation."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from phasewright.operators import counts as C
from tests.conftest import at, rows

COUNTS = "SignalID string, Timeperiod timestamp_ntz, Detector int, CallPhase int, vol int"


def _day(spark, volumes, detector=1, phase=2):
    return spark.createDataFrame([("1", at("0:00") + timedelta(hours=h), detector, phase, v) for h, v in enumerate(volumes)], COUNTS)


def _config(spark, approach="Side", detector=1, phase=2):
    return spark.createDataFrame([("1", detector, phase, approach)], "SignalID string, Detector int, CallPhase int, ApproachDesc string")


VARIED = [10, 20, 15, 30, 12, 50, 80, 120, 150, 140, 130, 125, 135, 145, 150, 160, 180, 170, 120, 100, 80, 60, 40, 20]


@pytest.mark.parametrize(
    "volumes,approach,good",
    [
        (VARIED, "Side", 1),
        (VARIED[:10] + [7] * 5 + VARIED[15:], "Side", 1),        # five equal hours are allowed
        (VARIED[:10] + [7] * 6 + VARIED[16:], "Side", 0),        # six are not
        ([0] * 5 + VARIED[5:], "Side", 1),                       # hours before five do not count
        ([v + 1190 if i % 2 else v + 1195 for i, v in enumerate(VARIED)], "Side", 0),      # over 1200 in more than five hours
        ([v + 1190 if i % 2 else v + 1195 for i, v in enumerate(VARIED)], "Mainline", 1),  # mainline limit is 3000
        ([100, 400] * 12, "Side", 0),                            # mean change 300
        ([100, 400] * 12, "Mainline", 1),                        # mainline limit is 500
    ],
)
def test_detector_day_flags(spark, volumes, approach, good):
    out = C.filter_counts(_day(spark, volumes), _config(spark, approach))
    assert out.select("Good_Day").distinct().collect()[0][0] == good
    assert out.where("vol is null").count() == (0 if good else 24)


def test_periods_without_counts_are_zero(spark):
    out = C.filter_counts(_day(spark, VARIED[:3]), _config(spark))
    assert out.count() == 24
    assert out.agg(F.max("flat_strk")).collect()[0][0] == 19


def test_detector_outside_the_config_is_unknown_unless_flat(spark):
    # Mainline is unknown, so only the flat flag can decide.
    good = C.filter_counts(_day(spark, VARIED, detector=9), _config(spark)).where("Detector = 9")
    assert {r[0] for r in good.select("Good_Day").collect()} == {None}
    flat = C.filter_counts(_day(spark, [5] * 24, detector=9), _config(spark)).where("Detector = 9")
    assert {r[0] for r in flat.select("Good_Day").collect()} == {0}


def _filtered(spark, data):
    full = [("1", 2, d, t, t.replace(day=1), v) for d, t, v in data]
    return spark.createDataFrame(full, "SignalID string, CallPhase int, Detector int, Timeperiod timestamp_ntz, Month_Hour timestamp_ntz, vol double")


def test_missing_volume_from_sibling_detector(spark):
    data = [(1, at("8:00"), 30.0), (2, at("8:00"), 10.0), (1, at("9:00"), 61.0), (2, at("9:00"), None)]
    out = C.adjust_counts(_filtered(spark, data))
    # Shares are 3/4 and 1/4 in the complete hour; 61 / 0.75 * 0.25 = 20.3.
    assert rows(out.where("Detector = 2"), "Timeperiod", "vol") == [(at("8:00"), 10), (at("9:00"), 20)]


def test_no_sibling_uses_the_months_median_of_the_weekday(spark):
    week = timedelta(days=7)
    data = [(1, at("8:00") + i * week, v) for i, v in enumerate([10.0, 40.0, 20.0, None])]
    out = C.adjust_counts(_filtered(spark, data))
    assert rows(out.where(F.col("Timeperiod") == F.lit(at("8:00") + 3 * week)), "vol") == [(20,)]


def test_implausible_imputation_is_dropped(spark):
    data = [(1, at("8:00"), 1.0), (2, at("8:00"), 99.0), (1, at("9:00"), 50.0), (2, at("9:00"), None)]
    out = C.adjust_counts(_filtered(spark, data))
    assert rows(out.where(F.col("Timeperiod") == F.lit(at("9:00"))), "Detector", "vol") == [(1, 50)]


def test_fifteen_minute_periods(log, spark):
    events = log(("1", "8:14:59", 82, 1), ("1", "8:15", 82, 1), ("1", "8:29", 82, 1), ("1", "8:20", 81, 1), ("1", "8:20", 82, 8))
    out = C.counts(events, _config(spark), minutes=15)
    assert rows(out, "Timeperiod", "Detector", "CallPhase", "vol") == [
        (at("8:00"), 1, 2, 1), (at("8:15"), 1, 2, 2), (at("8:15"), 8, None, 1),
    ]


def test_imputation_deals_its_rows_once(spark):
    data = [("1", 2, i % 2 + 1, at(f"{i // 2}:00"), float(i)) for i in range(40)]
    periods = spark.createDataFrame(data, "SignalID string, CallPhase int, Detector int, Timeperiod timestamp_ntz, vol double")
    filtered = periods.withColumn("Month_Hour", F.col("Timeperiod"))
    out = C.adjust_counts(filtered.withColumn("vol", F.when(F.col("vol") % 7 > 0, F.col("vol"))))
    assert out.count() == 40
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_filtering_deals_its_rows_once(spark):
    counted = spark.createDataFrame([("1", at(f"{h}:00"), 1, 2, h) for h in range(24)] + [("1", at("5:00"), 1, 2, 3)], "SignalID string, Timeperiod timestamp_ntz, Detector int, CallPhase int, vol int")
    config = spark.createDataFrame([("1", 1, 2, "Mainline"), ("1", 2, 4, "Side")], "SignalID string, Detector int, CallPhase int, ApproachDesc string")
    out = C.filter_counts(counted, config, days=spark.sql("SELECT date'2024-01-02' AS Date"))
    assert {(r["Detector"], r["n"], r["v"]) for r in out.groupBy("Detector").agg(F.count("*").alias("n"), F.sum("delta_vol").alias("v")).collect()} == {(1, 24, 23.0), (2, 24, 0.0)}
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Join" not in plan and plan.count("REPARTITION_BY_COL") == 1 and plan.count("Exchange hashpartitioning(SignalID") == 2  # the configuration's distinct rows and this
