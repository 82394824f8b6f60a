"""All levels in one aggregate against the tables planned one by one."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from phasewright.operators import levels as L
from phasewright.plans import packages as P
from phasewright.schemas import METRICS
from tests.conftest import rows


@pytest.fixture(scope="module")
def corridors(spark):
    names = "SignalID string, Zone_Group string, Zone string, Corridor string, Subcorridor string, Name string, Description string"
    places = [("1", "G", "Z", "A", "A1"), ("2", "G", "Z", "A", "A2"), ("3", "G", "Y", "B", None), ("4", "H", "X", "C", "C1"), ("5", None, None, None, None)]
    return spark.createDataFrame([(*p, "n" + p[0], "d" + p[0]) for p in places], names)


def test_measure_levels_are_the_descriptor_s_tables(spark, corridors):
    days = [date(2024, 1, 1) + timedelta(3 * i) for i in range(40)]
    values = [(s, 0, d, (int(s) * d.day % 7) / 7 if (d.day + int(s)) % 5 else None, float(d.day % 4)) for s in "123456" for d in days]
    daily = spark.createDataFrame(values, "SignalID string, CallPhase int, Date date, delay double, vol double").withColumn("Week", F.weekofyear("Date"))
    metric = METRICS["ad"]
    long, quarters = P.measure_levels(metric, daily, corridors)
    bundle = P._described(metric, daily, corridors)
    for name, df in bundle.items():
        level, per, _ = name.split("_")
        at = {"dy": "Date", "wk": "Date", "mo": "Month", "qu": "Quarter"}[per]
        whole = (quarters if per == "qu" else long.where(F.col("per") == per).withColumnRenamed("at", at)).where(F.col("level") == level)
        if per != "qu":
            df = df.withColumn(at, F.col(at).cast("timestamp_ntz"))
        shown = lambda frame, value: rows(frame.select("Zone_Group", "Corridor", at, F.round(value, 9), F.round("delta", 9)))  # noqa: E731, B023
        assert shown(whole, "value") == shown(df, metric.variable), name


def test_hours_are_dealt_once(spark, corridors):
    hours = [(t, s, datetime(2024, 1, 1, h), float(h), 1.0, t == "b") for t in "ab" for s in "12345" for h in range(5)]
    measures = spark.createDataFrame(hours, "table string, SignalID string, at timestamp_ntz, value double, weight double, summed boolean").withColumn("per", F.col("table"))
    signals = L.signal_periods(measures)
    signals.collect()
    plan = signals._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning(") == 1 and "Window" in plan
    got = {(r["level"], r["table"], r["Corridor"], r["at"].hour): r["value"] for r in L.level_rows(signals, corridors).collect()}
    assert got["cor", "a", "A", 3] == 3.0 and got["cor", "a", "G", 3] == 3.0 and got["sub", "b", "A2", 2] == 2.0 and got["sig", "a", "5", 1] == 1.0
    assert ("sub", "a", "B", 3) not in got


def test_travel_package_has_both_levels(spark, corridors):
    names = set()
    for level, per in (("cor", "mo"), ("cor", "wk"), ("sub", "mo"), ("sub", "wk")):
        names |= {f"{level}_{per}_{var}{h}" for var in ("tti", "pti", "tt", "spd") for h in ("", "h")}
    readings = spark.createDataFrame(
        [("G", "Z", "A", a, datetime(2024, 1, d, h), 2.0, 1.5, 1.0 + d) for a in ("A1", "A2") for d in (2, 3) for h in (7, 8)],
        "Zone_Group string, Zone string, Corridor string, Subcorridor string, Hour timestamp_ntz, travel_time_minutes double, reference_minutes double, miles double")
    vph = spark.createDataFrame([("G", "Z", "A", datetime(2024, 1, 2, h), 10.0 * h) for h in (7, 8)], "Zone_Group string, Zone string, Corridor string, Hour timestamp_ntz, vph double")
    sub_vph = vph.withColumns({"Zone_Group": F.lit("Z"), "Zone": F.lit("A"), "Corridor": F.explode(F.array(F.lit("A1"), F.lit("A2")))})
    package = P.travel_package(readings, vph, sub_vph, corridors)
    assert set(package) == names and package.targets["sub_wk_tti"].weekly
    got = rows(package["sub_mo_tt"], "Zone_Group", "Corridor", "tt")
    assert got == [("A", "A1", 2.0), ("A", "A2", 2.0), ("Z", "Z", 2.0)]
