"""Imputation of changed units against a full run."""

from datetime import timedelta

from pyspark.sql import functions as F

from phasewright.operators import counts as C
from phasewright.plans import imputation as I
from tests.conftest import DAY, at, rows

COLS = ("SignalID", "CallPhase", "Detector", "Timeperiod", "vol")


def filtered(spark, days, extra=()):
    data = []
    for d in days:
        for h in range(24):
            for s, p, k in (("1", 2, 1), ("1", 2, 2), ("1", 4, 3), ("2", 2, 1)):
                missing = (d + h + k) % 7 == 0 and not (s == "2")
                data.append((s, p, k, at(f"{h}:00", DAY + timedelta(days=d)), None if missing else float(10 * k + h + d)))
    df = spark.createDataFrame([*data, *extra], "SignalID string, CallPhase int, Detector int, Timeperiod timestamp_ntz, vol double")
    return df.withColumn("Month_Hour", (F.trunc("Timeperiod", "month").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour("Timeperiod"))))


def test_a_day_added_gives_the_rows_of_a_full_run(spark, tmp_path):
    base = str(tmp_path)
    first = filtered(spark, range(20))
    assert I.adjust_changed(spark, first, base) == 3
    assert rows(I.read_adjusted(spark, base), *COLS) == rows(C.adjust_counts(first), *COLS)
    assert I.adjust_changed(spark, first.orderBy(F.rand(3)), base) == 0
    more = filtered(spark, range(21))
    assert I.adjust_changed(spark, more, base) == 3
    assert rows(I.read_adjusted(spark, base), *COLS) == rows(C.adjust_counts(more), *COLS)


def test_only_the_changed_phase_is_redone(spark, tmp_path):
    base = str(tmp_path)
    first = filtered(spark, range(16))
    I.adjust_changed(spark, first, base)
    late = filtered(spark, range(16), [("1", 4, 3, at("12:30"), 99.0)])
    assert I.adjust_changed(spark, late, base) == 1
    assert rows(I.read_adjusted(spark, base), *COLS) == rows(C.adjust_counts(late), *COLS)
    # a phase that has gone is gone; other months stay
    february = filtered(spark, range(31, 33))
    I.adjust_changed(spark, february, base)
    left = first.where("CallPhase = 2")
    assert I.adjust_changed(spark, left, base) == 1
    assert rows(I.read_adjusted(spark, base), *COLS) == rows(C.adjust_counts(left.unionByName(february)), *COLS)
