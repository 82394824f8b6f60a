"""Published tables: what a publish writes, what readers see, and the chain of merging and publishing."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from phasewright.plans import packages as P
from phasewright.schemas import Target
from phasewright.sources import publishing as B
from tests.conftest import rows

MONTHLY = Target("Month", variable="v")


@pytest.fixture
def prefix(spark, request):
    name = "published_" + "".join(c for c in request.node.name if c.isalnum())[:40]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    yield name + "."
    spark.sql(f"DROP DATABASE {name} CASCADE")


def months(spark, values, **more):
    df = spark.createDataFrame([(date(2023 + (m - 1) // 12, (m - 1) % 12 + 1, 1), "G", "C", float(v)) for m, v in values.items()], "Month date, Zone_Group string, Corridor string, v double")
    return df.withColumns({k: F.lit(x) for k, x in more.items()})


def shown(spark, table):
    return {r["Month"].month + 12 * (r["Month"].year - 2023): r["v"] for r in spark.table(table).collect()}


def files(spark, table):
    return set(spark.table(f"{table}__parts").inputFiles())


def test_a_publish_writes_its_window_alone(spark, prefix):
    table = prefix + "t"
    B.publish(spark, months(spark, {m: m for m in range(1, 14)}), table, MONTHLY)
    before = files(spark, table)
    now = B.publish(spark, months(spark, {m: 100 + m for m in range(1, 15)}), table, MONTHLY, start="2024-01-01", report_start="2023-02-01", report_end="2024-02-01")
    assert shown(spark, table) == {**{m: m for m in range(2, 13)}, 13: 113, 14: 114}
    assert now.version == 2 and {p for p, v in now.parts.items() if v == 2} == {"2024-01", "2024-02"}
    assert before < files(spark, table) and len(files(spark, table) - before) == 2
    # a month of the history is dropped by the publish after the one that left it
    B.publish(spark, months(spark, {14: 7.0}), table, MONTHLY, start="2024-02-01", report_start="2023-02-01", report_end="2024-02-01")
    left = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}__parts").collect()}
    assert "_part=2023-01/_version=1" not in left and "_part=2024-02/_version=2" in left and shown(spark, table)[14] == 7.0


def test_a_reader_stays_at_what_it_has_begun_with(spark, prefix):
    table = prefix + "t"
    B.publish(spark, months(spark, {1: 1, 2: 2}), table, MONTHLY)
    reading = spark.table(table)
    B.publish(spark, months(spark, {2: 20}), table, MONTHLY, start="2023-02-01")
    assert sorted(r["v"] for r in reading.collect()) == [1.0, 2.0]
    assert shown(spark, table) == {1: 1.0, 2: 20.0}


def test_a_publish_that_fails_changes_nothing(spark, prefix, monkeypatch):
    table = prefix + "t"
    B.publish(spark, months(spark, {1: 1, 2: 2}), table, MONTHLY)
    with monkeypatch.context() as patch:
        patch.setattr(B, "_swap", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            B.publish(spark, months(spark, {2: 9}), table, MONTHLY, start="2023-02-01")
    assert shown(spark, table) == {1: 1.0, 2: 2.0}
    now = B.publish(spark, months(spark, {2: 20}), table, MONTHLY, start="2023-02-01")
    assert now.version == 3 and shown(spark, table) == {1: 1.0, 2: 20.0}


def test_a_window_that_begins_inside_a_month(spark, prefix):
    days = lambda value: spark.createDataFrame([(date(2024, 1, 2) + timedelta(7 * i), value) for i in range(9)], "Date date, v double")
    for name, target in (("wk", Target("Date", True)), ("dy", Target("Date"))):
        B.publish(spark, days(1.0), prefix + name, target)
        B.publish(spark, days(2.0), prefix + name, target, start="2024-02-01")  # a Thursday; the Tuesday of its week is in January
    assert [v for _, v in rows(spark.table(prefix + "wk"), "Date", "v")] == [1.0] * 4 + [2.0] * 5
    assert [v for _, v in rows(spark.table(prefix + "dy"), "Date", "v")] == [1.0] * 5 + [2.0] * 4


def test_columns_stay_those_of_the_first_rows(spark, prefix):
    table = prefix + "t"
    B.publish(spark, months(spark, {1: 1, 2: 2}, delta=0.5), table, MONTHLY)
    B.publish(spark, months(spark, {2: 3}, other="x"), table, MONTHLY, start="2023-02-01")
    assert rows(spark.table(table), "Month", "v", "delta") == [(date(2023, 1, 1), 1.0, 0.5), (date(2023, 2, 1), 3.0, None)]


def test_tables_without_periods_and_empty_ones(spark, prefix):
    whole = Target(None)
    for values in ({1: 1}, {}, {2: 2, 3: 3}):
        df = months(spark, values or {1: 0}).where(F.lit(bool(values)))
        B.publish(spark, df, prefix + "qu", whole, start="2023-02-01")
        assert shown(spark, prefix + "qu") == {m: float(v) for m, v in values.items()}
    B.publish(spark, months(spark, {1: 1}).limit(0), prefix + "t", MONTHLY)
    assert shown(spark, prefix + "t") == {}
    B.publish(spark, months(spark, {1: 1, 2: 2}), prefix + "t", MONTHLY, start="2023-02-01")
    assert shown(spark, prefix + "t") == {2: 2.0}


def test_months_that_come_out_the_same_are_not_written(spark, prefix):
    def run(values, calc_start):
        bundle = P.Bundle({"cor_mo_t": lambda: months(spark, values, delta=None).withColumn("delta", F.col("delta").cast("double"))}, {"cor_mo_t": MONTHLY})
        return B.write_aggregations(spark, bundle, report_start="2023-01-01", calc_start=calc_start, report_end="2024-01-01", prefix=prefix)["cor_mo_t"]

    values = {m: m for m in range(1, 13)}
    assert len(run(values, "2023-01-01")) == 12
    # the first run leaves the change as it comes; the second takes it over all months but the first, whose change is null anyway
    assert run(values, "2023-11-01") == {f"2023-{m:02d}" for m in range(2, 13)}
    version = B.publication(spark, prefix + "cor_mo_t").version
    assert run(values, "2023-10-01") == set() and B.publication(spark, prefix + "cor_mo_t").version == version
    assert run({**values, 10: 20}, "2023-10-01") == {"2023-10", "2023-11"}
    got = {r["Month"].month: (r["v"], r["delta"]) for r in spark.table(prefix + "cor_mo_t").collect()}
    assert got[10] == (20.0, pytest.approx(20 / 9 - 1)) and got[11] == (11.0, pytest.approx(11 / 20 - 1)) and got[12][0] == 12.0


def test_a_bundle_published_twice(spark, prefix):
    names = "SignalID string, Zone_Group string, Zone string, Corridor string, Subcorridor string, Name string, Description string"
    corridors = spark.createDataFrame([("1", "G", "Z", "A", "A1", "n", "d"), ("2", "G", "Z", "B", "B1", "n", "d")], names)
    daily = lambda factor: spark.createDataFrame([(s, date(2024, m, d), factor * (m + d) / 10) for s in ("1", "2") for m in (1, 2, 3) for d in (2, 9)], "SignalID string, Date date, tint double")
    first = B.publish_bundle(spark, P.time_in_transition(daily(1.0), corridors), prefix=prefix)
    again = B.publish_bundle(spark, P.time_in_transition(daily(2.0), corridors), prefix=prefix, start="2024-03-01", report_start="2024-01-01", report_end="2024-03-01")
    assert first.keys() == again.keys() and len(again) == 12
    for name, now in again.items():
        target = P.time_in_transition(daily(1.0), corridors).targets[name]
        written = {p for p, v in now.parts.items() if v == 2}
        assert written == ({"all"} if target.period is None else {"2024-02", "2024-03"} if target.weekly and spark.table(prefix + name).where("Date < date'2024-03-01' and Date >= date'2024-02-27'").count() else {"2024-03"}), name
    values = {r["Month"].month: r["tint"] for r in spark.table(prefix + "cor_mo_tint").where("Corridor = 'A'").collect()}
    assert values[3] == pytest.approx(2 * (5 + 12) / 20) and values[1] == pytest.approx((3 + 10) / 20)
