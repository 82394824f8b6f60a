"""The jobs with a manifest: what a run does again, and what readers see meanwhile."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from phasewright.plans import jobs as J
from tests.conftest import DAY, rows

NEXT = DAY + timedelta(days=1)


@pytest.fixture(scope="module")
def config(spark):
    return spark.createDataFrame([("1", 1, 2), ("1", 2, 4)], "SignalID string, Detector int, CallPhase int").withColumn("ApproachDesc", F.lit("Mainline"))


def hits(log, *more):
    return log(*[("1", f"{h}:00", 82, 1, day) for day in (DAY, NEXT) for h in range(6)], *more)


def job(config, calls, fail=None):
    from phasewright.operators import counts as C
    from phasewright.sources import tables as S

    def step(name, plan):
        def run(i):
            calls.append(name)
            if name == fail:
                raise RuntimeError("executor lost")
            return plan(i)

        return run

    return J.Job({
        "counts": step("counts", lambda i: S.with_day(C.counts(i.rows(), config), "Timeperiod")),
        "busy": step("busy", lambda i: i.read("counts").groupBy("SignalID", "Date").agg(F.sum("vol").alias("vol")).where("vol > 6")),
        "total": step("total", lambda i: i.read("counts").groupBy("SignalID", "Date").agg(F.sum("vol").alias("vol"))),
    })


def test_a_run_does_what_is_missing(spark, log, config, tmp_path):
    base, calls, events = str(tmp_path), [], hits(log)
    run = lambda events, fail=None: J.run_job(spark, job(config, calls, fail), events, J.log_versions(events), base)
    with pytest.raises(RuntimeError):
        run(events, "total")
    assert rows(J.read_job_table(spark, base, "counts"), "Date").count((DAY,)) == 6
    assert J.read_job_table(spark, base, "busy").count() == 0  # stored, without a row
    assert run(events) == {"counts": [], "busy": [], "total": [DAY, NEXT]}
    assert calls == ["counts", "busy", "total", "total"]
    assert run(events) == {"counts": [], "busy": [], "total": []}
    late = hits(log, ("1", "7:00", 82, 1, NEXT))
    assert run(late) == {"counts": [NEXT], "busy": [NEXT], "total": [NEXT]}
    assert rows(J.read_job_table(spark, base, "total"), "Date", "vol") == [(DAY, 6), (NEXT, 7)]
    assert rows(J.read_job_table(spark, base, "busy"), "Date", "vol") == [(NEXT, 7)]
    # the day goes back: its stored row of another version is no longer seen, though nothing takes its place
    run(events)
    assert rows(J.read_job_table(spark, base, "busy")) == [] and rows(J.read_job_table(spark, base, "total"), "vol") == [(6,), (6,)]


def test_versions_tell_changed_days(log):
    one, again, other = hits(log), hits(log).orderBy(F.rand(1)), hits(log, ("1", "5:00", 82, 1, DAY), ("1", "5:00", 82, 1, DAY))
    at = lambda df: dict(rows(J.log_versions(df)))
    assert at(one) == at(again) and at(one)[NEXT] == at(other)[NEXT] and at(one)[DAY] != at(other)[DAY]


def test_a_month_is_done_as_a_whole(spark, log, tmp_path):
    monthly = J.Job({"n": lambda i: i.rows().groupBy("SignalID", "Date").agg(F.count("*").alias("n"))}, by_month=True)
    february = DAY + timedelta(days=31)
    events = hits(log, ("1", "8:00", 1, 2, february))
    run = lambda events: J.run_job(spark, monthly, events, J.log_versions(events), str(tmp_path))["n"]
    assert run(events) == [DAY, NEXT, february]
    assert run(hits(log, ("1", "8:00", 1, 2, february), ("1", "9:00", 1, 2, NEXT))) == [DAY, NEXT]
    assert rows(J.read_job_table(spark, str(tmp_path), "n"), "Date", "n") == [(DAY, 6), (NEXT, 7), (february, 1)]


def test_all_tables_of_the_jobs_are_stored(spark, log, config, tmp_path):
    events = log(*[("1", f"{h}:{m:02d}", code, 1 + m % 2, day) for day in (DAY, NEXT) for h in range(24) for m, code in enumerate((82, 82, 81, 81, 90, 90))])
    full = config.withColumns({"CountPriority": F.lit(1), "DetectionTypeDesc": F.lit("Advanced Count, Stop Bar Presence"), "TimeFromStopBar": F.lit(0.0)})
    base = str(tmp_path)
    counted = J.run_job(spark, J.count_job(full, config), events, J.log_versions(events), base)
    assert len(counted) == 11 and all(days == [DAY, NEXT] for days in counted.values())
    month = J.run_job(spark, J.month_job(full), events, J.table_versions(spark, base, "counts_1hr"), base, lambda name: J.read_job_table(spark, base, name))
    assert len(month) == 12 and all(days == [DAY, NEXT] for days in month.values())
    assert J.read_job_table(spark, base, "vehicles_15min").count() > 2 * J.read_job_table(spark, base, "vehicles_ph").count()
