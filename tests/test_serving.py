"""Merges, reads, alerts and stored tables."""

from datetime import date, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from phasewright import session as settings
from phasewright.operators import alerts as W
from phasewright.operators import detectors as K
from phasewright.operators import serving as Q
from phasewright.plans import daily as P
from phasewright.schemas import CORRIDORS_RAW, METRICS, PED_CONFIG, Metric, Target
from phasewright.sources import tables as S
from phasewright.sources.publishing import publish
from tests.conftest import DAY, at, rows

MONTHS = "Zone_Group string, Corridor string, Month date, v double, delta double"


def _months(spark, *data):
    return spark.createDataFrame([("G", "G", date(2024, m, 1), v, None) for m, v in data], MONTHS)


def test_merge_is_idempotent_and_recomputes_change(spark):
    old, new = _months(spark, (1, 10.0), (2, 20.0), (3, 99.0)), _months(spark, (2, 77.0), (3, 30.0), (4, 60.0))
    start, calc = F.lit("2024-01-01").cast("date"), F.lit("2024-03-01").cast("date")
    once = Q.merge_recomputed(old, new, "v", "Month", start, calc)
    assert rows(once, "Month", "v", "delta") == [
        (date(2024, 1, 1), 10.0, None), (date(2024, 2, 1), 20.0, 1.0), (date(2024, 3, 1), 30.0, 0.5), (date(2024, 4, 1), 60.0, 1.0),
    ]
    assert rows(Q.merge_recomputed(once, new, "v", "Month", start, calc)) == rows(once)
    assert Q.merge_recomputed(old, new, "v", "Quarter", start, calc) is new


def test_query_picks_table_and_filters(spark):
    asked = []

    def read(name):
        asked.append(name)
        return _months(spark, (1, 10.0), (2, 20.0), (3, 30.0))

    m = Metric("x", "v", "t", hourly_table=None)
    assert rows(Q.query_metric(read, m, zone_group="G", month="2024-02-01"), "v") == [(10.0,), (20.0,)]
    assert rows(Q.query_metric(read, m, zone_group="G", month="2024-02-01", upto=False, hourly=True), "v") == [(20.0,)]
    assert rows(Q.query_metric(read, m, level="signal", month="2024-03-01"), "v") == [(10.0,), (20.0,), (30.0,)]
    assert asked == ["cor_mo_t", "cor_mo_t", "sig_mo_t"]
    assert rows(Q.value_box(read, m, "G", month="2024-02-01"), "v", "delta") == [(20.0, 0.0)]


def test_before_and_after_windows(spark):
    wk = spark.createDataFrame([("Z", "1", DAY + timedelta(days=7 * i), float(i)) for i in range(6)], "Zone_Group string, Corridor string, Date date, v double")
    cor = spark.createDataFrame([("1", "1: a")], "SignalID string, Description string")
    out = Q.before_after(wk, "v", cor, "Z", ("2024-01-02", "2024-01-09"), ("2024-01-23", "2024-01-30"))
    assert rows(out, "Description", "before", "after", "delta") == [("1: a", 0.5, 3.5, 6.0)]


def test_compare_frames_counts_repeats(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(Q.compare_frames(a, b)) == [(1, "first"), (2, "first"), (3, "second")]


def test_latest_versions_keep_ties(spark):
    v = spark.createDataFrame([(date(2024, 1, 1), "Z", t) for t in (1, 2, 2, 3, 3)], "Month date, Zone string, LastModified int")
    assert rows(Q.latest_versions(v, 2), "LastModified") == [(3,), (3,)]
    assert rows(Q.latest_versions(v, 3), "LastModified") == [(2,), (2,), (3,), (3,)]
    assert rows(Q.last_modified(v, "Z"), "LastModified") == [(3,), (3,)]


def _alerts(spark, *days, kind="Count", zone="G", detector=1):
    data = [(zone, "Z", "C", "7", 2, detector, DAY + timedelta(days=d), "Main @ First", kind, "NB") for d in days]
    return spark.createDataFrame(data, "Zone_Group string, Zone string, Corridor string, SignalID string, CallPhase int, Detector int, Date date, Name string, Alert string, ApproachDesc string")


def test_streaks_restart_after_a_gap_and_old_alerts_drop(spark):
    out = W.alert_streaks([_alerts(spark, 0, 1, 2, 4), _alerts(spark, 4, -200).drop("ApproachDesc", "Detector")], DAY + timedelta(days=5))
    assert rows(out.where("Detector = 1"), "Date", "streak") == [(DAY + timedelta(days=d), s) for d, s in [(0, 1), (1, 2), (2, 3), (4, 1)]]
    assert rows(out.where("Detector = 0"), "Date", "streak") == [(DAY + timedelta(days=4), 1)]


def test_filtered_alerts_count_occurrences_and_current_streak(spark):
    both = W.alert_streaks([_alerts(spark, 0, 1, 2), _alerts(spark, 0, 1, detector=2)], DAY + timedelta(days=5))
    table, behind = W.filter_alerts(both, DAY, DAY + timedelta(days=9), "Count", zone_group="G", phase=2, pattern="main")
    assert rows(table, "Detector", "Occurrences", "Streak") == [(1, 3, 3), (2, 2, 0)]
    assert behind.count() == 5
    active, behind = W.filter_alerts(both, DAY, DAY + timedelta(days=9), "Count", active_days=0)
    assert rows(active, "Detector") == [(1,)] and behind.count() == 3
    assert W.filter_alerts(both, DAY, DAY + timedelta(days=9), "Count", pattern="nowhere")[0].count() == 0


def test_later_message_kind_wins(spark):
    m = spark.createDataFrame([(at("8:00"), "7", "712", 2, "Max Outs Count: 5"), (at("8:00"), "7", None, 2, "other")], "TimeStamp timestamp_ntz, SignalID string, DetectorID string, Phase int, Message string")
    cor = spark.createDataFrame([("G", "Z", "C", "7", "n")], "Zone_Group string, Zone string, Corridor string, SignalID string, Name string")
    assert rows(W.watchdog_alerts(m, cor, "2024-01-10"), "Detector", "Alert") == [(0, None), (12, "Max Outs")]


def test_rewriting_a_day_leaves_the_others(spark, log, tmp_path):
    path = str(tmp_path / "log")
    nxt = DAY + timedelta(days=1)
    both = log(("1", "8:00", 1, 2), ("1", "8:00", 1, 2, nxt))
    S.write_days(both, path)
    S.write_days(both, path)
    assert S.read_table(spark, path).count() == 2
    S.write_days(log(("2", "9:00", 8, 2, nxt)), path)
    assert rows(S.read_table(spark, path), "SignalID", "Date") == [("1", DAY), ("2", nxt)]
    assert rows(S.read_table(spark, path, start=nxt, signals=["2"], then=lambda d: d.where("EventCode = 8")), "SignalID") == [("2",)]
    assert "PartitionFilters: [isnotnull(date" in S.read_table(spark, path, start=nxt)._jdf.queryExecution().toString()


def test_config_reader_spans_days(spark, tmp_path):
    base = str(tmp_path)
    for i in range(3):
        df = spark.createDataFrame([("1", i, i, DAY + timedelta(days=i))], "SignalID string, Detector int, CallPhase int, Date date")
        S.write_days(df, f"{base}/ped")
    read = S.config_reader(spark, base, "ped", PED_CONFIG)
    assert rows(read(DAY), "Detector", "Date") == [(0, DAY)]
    assert read(DAY, DAY + timedelta(days=1)).count() == 2


def test_corridors_from_csv(spark, tmp_path):
    path = tmp_path / "c.csv"
    head = ",".join(f.name for f in CORRIDORS_RAW.fields)
    path.write_text(head + "\n1,G,Z,C,S,A,Main,First,1.5,2024-01-01,,true,2023-01-01,,33.0,-84.0\n1,G,Z,C,S,A,Main,Second,1.5,2024-01-01,,true,2023-06-01,,33.0,-84.0\n2,G,Z,C,S,A,Main,Third,1.5,2024-01-01,,false,,,33.0,-84.0\n")
    raw = S.read_corridors(spark, str(path), CORRIDORS_RAW)
    assert rows(K.clean_corridors(raw), "SignalID", "Description") == [("1", "1: Main @ Second")]
    assert K.clean_corridors(raw, included_only=False).count() == 2


def test_time_slices_cover_the_days_without_overlap():
    p = S.time_predicates("2024-01-01", "2024-01-02", 4)
    assert len(p) == 8
    assert p[0] == "Timestamp >= '2024-01-01 00:00:00' AND Timestamp < '2024-01-01 06:00:00'"
    assert p[-1].endswith("Timestamp < '2024-01-03 00:00:00'")


def test_publish_replaces_the_window(spark):
    name = "cor_mo_publish"
    target = Target("Month")
    publish(spark, _months(spark, (1, 1.0), (2, 2.0), (3, 3.0)), name, target)
    publish(spark, _months(spark, (2, 9.0), (3, 30.0), (4, 40.0), (6, 60.0)), name, target, start="2024-03-01", report_start="2024-02-01", report_end="2024-04-01")
    assert rows(spark.table(name), "Month", "v") == [(date(2024, 2, 1), 2.0), (date(2024, 3, 1), 30.0), (date(2024, 4, 1), 40.0)]


def test_weekly_publish_starts_on_tuesday(spark):
    wk = spark.createDataFrame([(DAY, 1.0), (DAY + timedelta(days=7), 2.0)], "Date date, v double")
    out = S.publish_window(wk, wk.withColumn("v", F.col("v") * 10), "Date", start="2024-01-05", weekly=True)
    assert rows(out, "v") == [(10.0,), (20.0,)]


def test_table_names():
    assert S.table_name("cor/mo/aogd.parquet") == "cor_mo_aogd"


def test_staging_uses_the_folder_the_session_names(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(settings, "shared_folder", lambda s: str(tmp_path))
    df = settings.stage(spark.range(5).withColumn("t", F.lit(at("8:00")).cast("timestamp_ntz")))
    assert df.count() == 5 and str(df.schema["t"].dataType) == "TimestampNTZType()"
    assert "RDDScan" not in df._jdf.queryExecution().toString() and any(tmp_path.iterdir())


def _stub(**conf):
    """The parts of a session that decide the shared folder."""
    context = SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda key: None))
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)), sparkContext=context)


def test_shared_folder_is_the_one_the_session_names():
    assert settings.shared_folder(_stub(**{"spark.checkpoint.dir": "hdfs:///shared"})) == "hdfs:///shared"
    assert settings.shared_folder(_stub(**{"spark.sql.warehouse.dir": "hdfs:///tables/"})) == "hdfs:///tables/_staged"


def test_count_job_twice_leaves_the_store_unchanged(spark, log, tmp_path):
    events = log(*[("1", f"{h}:{m:02d}", 82, 1) for h in range(24) for m in range(0, h + 1)], ("1", "9:00", 90, 2))
    config = spark.createDataFrame([("1", 1, 2, "Mainline")], "SignalID string, Detector int, CallPhase int, ApproachDesc string")
    ped = spark.createDataFrame([("1", 2, 2)], "SignalID string, Detector int, CallPhase int")
    base = str(tmp_path)
    tables = ("counts_1hr", "filtered_counts_1hr", "detector_uptime_pd", "ped_actuations_pd", "comm_uptime")

    def run():
        P.run_counts(spark, events, config, ped, base)
        return [sorted(map(str, S.read_table(spark, f"{base}/{t}").collect())) for t in tables]

    first = run()
    assert all(first) and run() == first


def test_metrics_have_one_descriptor_per_table():
    assert all(name == m.table for name, m in METRICS.items()) and METRICS["aogd"].weight == "vol"


def test_details_of_a_signal_are_read_from_its_bucket(spark, tmp_path):
    spark.sql(f"CREATE DATABASE details_test LOCATION '{tmp_path}'")
    counts = spark.createDataFrame([(str(s), at("8:00", DAY + timedelta(days=d)), k, 2, s + k) for s in range(40) for d in range(3) for k in (1, 2)],
                                   "SignalID string, Timeperiod timestamp_ntz, Detector int, CallPhase int, vol int")
    filtered, adjusted = counts.withColumn("Good_Day", F.col("Detector") - 1), counts
    S.store_signal_details(S.signal_details(counts, filtered, adjusted), "details_test.d", buckets=16)
    one = S.read_signal_details(spark.table("details_test.d"), "7", DAY, DAY + timedelta(days=1))
    assert rows(one, "Timeperiod", "Detector", "vol_rc", "vol_ac", "bad_day") == [
        (at("8:00", DAY + timedelta(days=d)), k, 7 + k, 8 if k == 1 else None, k == 1) for d in (0, 1) for k in (1, 2)]
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # the plan then names the buckets
    try:
        plan = S.read_signal_details(spark.table("details_test.d"), "7", DAY)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 16" in plan and "EqualTo(SignalID,7)" in plan and "GreaterThanOrEqual(Date" in plan
    spark.sql("DROP DATABASE details_test CASCADE")


def test_key_value_by_row(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, n string")
    assert rows(S.key_value("k", df, id="id")) == [("k:1", '{"id":1,"n":"a"}'), ("k:2", '{"id":2}')]


def test_key_value_is_one_row(spark):
    df = spark.range(100).withColumn("n", F.col("id") * 2)
    stored = S.key_value("k", df)
    assert [r["key"] for r in stored.collect()] == ["k"] and S.key_value("k", df.limit(0)).count() == 1
    back = stored.select(F.explode(F.from_json("data", "array<struct<id: bigint, n: bigint>>")).alias("r")).select("r.*")
    assert rows(back) == rows(df)


def test_key_value_joins_its_ranges_in_order(spark):
    df = spark.createDataFrame([(3, "c"), (None, None), (1, 'a,"]['), (2, None), (1, "b"), (3, "c")], "id int, n string")
    whole = '[{},{"id":1,"n":"a,\\"]["},{"id":1,"n":"b"},{"id":2},{"id":3,"n":"c"},{"id":3,"n":"c"}]'
    for merged in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
        try:
            assert [tuple(r) for r in S.key_value("k", df).collect()] == [("k", whole)]
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [tuple(r) for r in S.key_value("k", df.limit(0)).collect()] == [("k", "[]")]


def test_the_stored_suppliers_are_one_value(spark, tmp_path):
    import __spark_entry__ as entry

    wanted = [("suppliers", 1, k, n) for k, n in ((1, "a"), (2, None), (2, None), (3, "c"))]
    spark.createDataFrame([r[2:] for r in wanted], "s_suppkey long, s_name string").write.parquet(str(tmp_path / "supplier.parquet"))
    assert rows(entry.queries()["s27_key_value"](spark, str(tmp_path))) == rows(spark.createDataFrame(wanted, "key string, parts long, s_suppkey long, s_name string"))
