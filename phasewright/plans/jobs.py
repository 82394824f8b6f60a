"""Jobs of many tables with a manifest of what is stored.

A job is an ordered list of steps, each a plan of one table from the input and from tables stored by earlier
steps. Every input day has a version, a digest of its rows. The manifest, a small table beside the
others, says which table has been stored for which day from which version; it is written after the
table, so it is the commit. A run does for each table the days that the manifest does not have in their
present version: after a failure that is what was missing, after late data the days that changed. Readers
take the days and versions that the manifest names, so they see neither a half-written
table nor rows of a day that have since become none.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasewright.functions.calendar import month_of
from phasewright.operators import counts as C
from phasewright.operators import detectors as K
from phasewright.operators import events as E
from phasewright.operators import measures as M
from phasewright.operators import rollups as A
from phasewright.session import stage
from phasewright.sources import tables as S

MANIFEST = "table string, Date date, version string, run long, schema string"


@dataclass(frozen=True)
class Inputs:
    """What a step plans from: the input rows of its days, the stored tables, and the days themselves."""

    rows: Callable[[], DataFrame]
    read: Callable[[str], DataFrame]
    days: DataFrame


@dataclass(frozen=True)
class Job:
    """Steps by table name, in order. A job by ``month`` does whole months: its tables depend on all days of one."""

    steps: Mapping[str, Callable[[Inputs], DataFrame]]
    by_month: bool = False


def log_versions(events: DataFrame) -> DataFrame:
    """Date and version of each day of a log: its number of rows and two sums over their hashes, whatever their order."""
    h = F.xxhash64("SignalID", "Timestamp", "EventCode", "EventParam")
    return events.groupBy("Date").agg(
        F.concat_ws("-", F.count(F.lit(1)).cast("string"), F.hex(F.bit_xor(h)), F.sum(F.pmod(h, F.lit(2**31))).cast("string")).alias("version"))


def manifest(spark: SparkSession, base: str) -> DataFrame:
    """What has been stored: table, day, version, run and columns, of the last run of each table's day; empty before the first run."""
    path = f"{base}/manifest"
    try:
        rows = spark.read.schema(MANIFEST).parquet(path)
    except Exception as e:  # the folder does not exist yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], MANIFEST)
    return rows.groupBy("table", "Date").agg(*[F.max_by(c, "run").alias(c) for c in ("version", "schema")], F.max("run").alias("run"))


def read_job_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A stored table as the manifest has it: rows of the named days and versions, with ``Date``."""
    stored = manifest(spark, base).where(F.col("table") == table)
    columns = T.StructType.fromJson(json.loads(stored.agg(F.max_by("schema", "run")).first()[0]))
    named = stored.select("Date", F.col("version").alias("_version"))
    rows = spark.read.schema(columns).parquet(f"{base}/{table}").withColumnRenamed("date", "Date")
    return rows.join(named, ["Date", "_version"], "left_semi").drop("_version")


def table_versions(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Date and version of the days of a stored table: the versions of a job that reads it."""
    return manifest(spark, base).where(F.col("table") == table).select("Date", "version")


def run_job(spark: SparkSession, job: Job, rows: DataFrame, versions: DataFrame, base: str, read: Callable[[str], DataFrame] | None = None) -> dict[str, list[date]]:
    """Do what the manifest lacks; returns these days by table.

    ``rows`` has a ``Date``; ``versions`` names its days. ``read`` gives tables that are not this job's own. The
    days of a table reach the driver, one value for each; rows do not.
    """
    versions = stage(versions.where("Date IS NOT NULL"), "versions")
    if job.by_month:
        month = month_of("Date")
        whole = versions.groupBy(month.alias("_month")).agg(F.md5(F.concat_ws(",", F.array_sort(F.collect_list(F.concat_ws(":", "Date", "version"))))).alias("version"))
        versions = stage(versions.select("Date", month.alias("_month")).join(whole, "_month").select("Date", "version"), "versions")
    stored = stage(manifest(spark, base), "manifest-as-read")
    run = (stored.agg(F.max("run")).first()[0] or 0) + 1
    every = versions.withColumn("table", F.explode(F.array(*[F.lit(t) for t in job.steps])))
    missing: dict[str, list[date]] = {table: [] for table in job.steps}
    for row in every.join(stored, ["table", "Date", "version"], "left_anti").select("table", "Date").collect():
        missing[row["table"]].append(row["Date"])
    missing = {table: sorted(days) for table, days in missing.items()}
    for table, plan in job.steps.items():
        days = missing[table]
        if not days:
            continue

        def own(name: str, days=days) -> DataFrame:
            frame = read_job_table(spark, base, name) if name in job.steps else read(name)
            return frame.where(F.col("Date").isin(days))

        todo = versions.where(F.col("Date").isin(days))
        made = plan(Inputs(lambda days=days: rows.where(F.col("Date").isin(days)), own, todo.select("Date")))
        made = made.join(todo.withColumnRenamed("version", "_version"), "Date")
        S.write_days(made, f"{base}/{table}")
        columns = T.StructType([f for f in made.schema.fields if f.name != "Date"] + [T.StructField("date", T.DateType())])
        entry = todo.select(F.lit(table).alias("table"), "Date", "version", F.lit(run).cast("long").alias("run"), F.lit(columns.json()).alias("schema"))
        entry.coalesce(1).write.mode("append").parquet(f"{base}/manifest")
    return missing


def count_job(config: DataFrame, ped_config: DataFrame, hourly: C.CountLimits = C.HOURLY, quarter_hourly: C.CountLimits = C.QUARTER_HOURLY) -> Job:
    """The eleven count tables of a day of the log (C02). Each size of period is counted once; the others start from stored counts."""
    def counted(minutes: int, code: int, of: DataFrame):
        return lambda i: S.with_day(C.counts(i.rows(), of, minutes=minutes, code=code), "Timeperiod")

    return Job({
        "comm_uptime": lambda i: M.comm_uptime(i.rows()),
        "counts_1hr": counted(60, 82, config),
        "counts_15min": counted(15, 82, config),
        "counts_ped_1hr": counted(60, 90, ped_config),
        "counts_ped_15min": counted(15, 90, ped_config),
        "filtered_counts_1hr": lambda i: C.filter_counts(i.read("counts_1hr").drop("Date", "date"), config, hourly, days=i.days),
        "filtered_counts_15min": lambda i: C.filter_counts(i.read("counts_15min").drop("Date", "date"), config, quarter_hourly, days=i.days),
        "bad_detectors": lambda i: M.bad_detectors(i.read("filtered_counts_1hr")),
        "detector_uptime_pd": lambda i: A.daily_detector_uptime(i.read("filtered_counts_1hr")),
        "ped_actuations_pd": lambda i: M.volume_per_day(i.read("counts_ped_1hr"), phases=None).withColumnRenamed("vpd", "papd"),
        "ped_actuations_ph": lambda i: S.with_day(A.volume_per_period(i.read("counts_ped_1hr"), phases=None).withColumnRenamed("vph", "paph"), "Hour"),
    })


def month_job(config: DataFrame) -> Job:
    """The twelve tables made from a month's counts (C07); ``read`` gives those of ``count_job``."""
    def adjusted(name: str):
        return lambda i: C.adjust_counts(C.select_count_detectors(i.read(name), config))

    def ped(minutes: int, name: str, to: str, period: str):
        return lambda i: S.with_day(A.volume_per_period(i.read(name), minutes=minutes, phases=None).withColumnRenamed("vph", to), period)

    return Job({
        "adjusted_counts_1hr": adjusted("filtered_counts_1hr"),
        "adjusted_counts_15min": adjusted("filtered_counts_15min"),
        "signal_details": lambda i: S.signal_details(i.read("counts_1hr"), i.read("filtered_counts_1hr"), i.read("adjusted_counts_1hr")),
        "month_bad_detectors": lambda i: M.bad_detectors(i.read("filtered_counts_1hr")),
        "month_detector_uptime_pd": lambda i: A.daily_detector_uptime(i.read("filtered_counts_1hr")),
        "vehicles_pd": lambda i: M.volume_per_day(i.read("adjusted_counts_1hr")),
        "vehicles_ph": lambda i: S.with_day(A.volume_per_period(i.read("adjusted_counts_1hr")), "Hour"),
        "throughput": lambda i: M.throughput(i.read("adjusted_counts_15min")),
        "vehicles_15min": lambda i: S.with_day(A.volume_per_period(i.read("adjusted_counts_15min"), minutes=15), "Timeperiod"),
        "month_ped_actuations_pd": lambda i: M.volume_per_day(i.read("counts_ped_1hr"), phases=None).withColumnRenamed("vpd", "papd"),
        "month_ped_actuations_ph": ped(60, "counts_ped_1hr", "paph", "Hour"),
        "month_ped_actuations_15min": ped(15, "counts_ped_15min", "pa15", "Timeperiod"),
    }, by_month=True)


def event_job(config: DataFrame, bad: DataFrame | None = None, *, bin_seconds: int = 3600, **options: Mapping) -> Job:
    """Cycles and detections of a day of the log (E16), and the eleven measures made from them.

    ``options`` are arguments of single measures: ``split_failures``, ``queue_spillback``, ``ped_delay``.
    """
    presence, spill = K.for_split_failures(config), K.for_spillback(config, bad)
    of = lambda name: dict(options.get(name, {}))

    def etl(i: Inputs) -> tuple[DataFrame, DataFrame]:
        return E.etl(i.rows(), E.count_detector_flag(config), bin_seconds=bin_seconds)

    def aog(minutes: int):
        return lambda i: M.shape_aog(M.arrivals_on_green(i.read("detections"), config, minutes=minutes))

    def failures(minutes: int):
        return lambda i: M.split_failures(i.read("cycles"), i.read("detections"), presence, minutes=minutes, **of("split_failures"))

    def spillback(minutes: int):
        return lambda i: M.queue_spillback(i.read("detections"), spill, minutes=minutes, **of("queue_spillback"))

    def delay(minutes: int):
        return lambda i: S.with_day(M.approach_delay(i.read("detections"), i.read("cycles"), i.rows(), minutes=minutes), "Hour")

    return Job({
        "cycles": lambda i: etl(i)[0],
        "detections": lambda i: etl(i)[1],
        "arrivals_on_green": aog(60), "arrivals_on_green_15min": aog(15),
        "split_failures": failures(60), "sf_15min": failures(15),
        "queue_spillback": spillback(60), "qs_15min": spillback(15),
        "ped_delay": lambda i: M.ped_delay(i.rows(), **of("ped_delay")),
        "approach_delay_1hr": delay(60), "approach_delay_15min": delay(15),
        "phase_termination": lambda i: M.terminations(i.read("cycles")),
        "time_in_transition": lambda i: M.time_in_transition(i.rows()),
    })


def rows_of_day(df: DataFrame, table: str, key: list[str], values: list[str], period: str | None = None) -> DataFrame:
    """A table in the long form all tables share: ``name``, ``SignalID``, ``Date``, ``key`` and ``data``.

    ``data`` holds the day's rows of the key in order, as period and values in millionths: a day of a
    detector at most.
    """
    number = [F.coalesce(F.floor(F.col(v).cast("double") * 1e6 + 0.50037).cast("bigint").cast("string"), F.lit("-")) for v in values]
    item = F.concat_ws(",", *([F.col(period).cast("string")] if period else []), *number)
    return df.groupBy("SignalID", F.col("Date"), F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in key]).alias("key")).agg(
        F.concat_ws(";", F.array_sort(F.collect_list(item))).alias("data")).select(F.lit(table).alias("name"), "SignalID", "Date", "key", "data")
