"""Readers and writers of the stored tables.

Tables are Parquet directories partitioned by ``date`` (hive style); filters on the
date prune directories and the other predicates reach the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasewright.functions.calendar import is_midweek, midnight, plus_seconds, round_to_tuesday
from phasewright.operators.carry import DAY_SECONDS
from phasewright.operators.events import add_barriers

Predicate = Callable[[DataFrame], DataFrame]


# Reading ------------------------------------------------------------------------------------


def read_table(
    spark: SparkSession, base: str, *, start=None, end=None, signals: Iterable[str] | DataFrame | None = None,
    schema: T.StructType | None = None, then: Predicate | None = None, midweek_only: bool = False, distinct: bool = False,
) -> DataFrame:
    """A date range of a stored table, with the day as ``Date``.

    ``signals`` is a short list (pushed down) or a frame of ids (semi join). ``then`` is
    the caller's own predicate or projection; the optimizer pushes it to the scan.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(base)
    day = F.col("date").cast("date")
    if start is not None:
        df = df.where(day >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(day <= F.lit(end).cast("date"))
    df = df.withColumnRenamed("date", "Date").drop(*[c for c in df.columns if c.startswith("__")])
    if midweek_only:
        df = df.where(is_midweek("Date"))
    df = only_signals(df, signals)
    if then is not None:
        df = then(df)
    return df.distinct() if distinct else df


def only_signals(df: DataFrame, signals: Iterable[str] | DataFrame | None) -> DataFrame:
    if signals is None:
        return df
    if isinstance(signals, DataFrame):
        return df.join(signals.select("SignalID").distinct(), "SignalID", "left_semi")
    return df.where(F.col("SignalID").isin(*signals))


def event_log(events: DataFrame, start=None, end=None) -> DataFrame:
    """Distinct event rows of a date range.

    The distinct is per day and signal; its hash covers the whole row, so a busy signal
    is spread evenly.
    """
    df = events
    if start is not None:
        df = df.where(F.col("Date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("Date") <= F.lit(end).cast("date"))
    return df.select("SignalID", "Timestamp", "EventCode", "EventParam", "Date").distinct()


def detection_events(detections: DataFrame, then: Predicate | None = None) -> DataFrame:
    """Detections with their on and off times."""
    df = detections.select("SignalID", "Phase", "Detector", "CycleStart", "PhaseStart", "DetTimeStamp", "DetDuration", "Date")
    df = then(df) if then else df
    return df.withColumn("DetOff", plus_seconds("DetTimeStamp", F.col("DetDuration"))).withColumnRenamed("DetTimeStamp", "DetOn")


def cycle_data(cycles: DataFrame, then: Predicate | None = None) -> DataFrame:
    """Cycle columns used by the measures."""
    df = cycles.select("SignalID", "Phase", "CycleStart", "PhaseStart", "PhaseEnd", "EventCode", "Date")
    return then(df) if then else df


def config_reader(spark: SparkSession, base: str, folder: str, schema: T.StructType) -> Callable[..., DataFrame]:
    """Reader of one kind of configuration over a range of days."""
    dated = T.StructType([*schema.fields, T.StructField("date", T.DateType())])

    def read(start, end=None) -> DataFrame:
        return read_table(spark, f"{base}/{folder}", start=start, end=end or start, schema=dated)

    return read


def read_corridors(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Corridor list from CSV with its declared types (S08; cleaned by ``clean_corridors``)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def pull_source_events(
    spark: SparkSession, url: str, table: str, start, end, *, slices_per_day: int = 24, properties: dict | None = None
) -> DataFrame:
    """Events of a source database over JDBC, one task per slice of a day, barriers added."""
    rows = spark.read.jdbc(url, table, predicates=time_predicates(start, end, slices_per_day), properties=properties or {})
    return add_barriers(rows.withColumn("Date", F.to_date("Timestamp")))


def time_predicates(start, end, slices_per_day: int = 24) -> list[str]:
    """Half-open time slices covering whole days from start to end, as SQL predicates."""
    import datetime as dt

    first, last = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    width = dt.timedelta(seconds=DAY_SECONDS / slices_per_day)
    at = dt.datetime.combine(first, dt.time())
    stop = dt.datetime.combine(last + dt.timedelta(days=1), dt.time())
    out = []
    while at < stop:
        out.append(f"Timestamp >= '{at}' AND Timestamp < '{at + width}'")
        at += width
    return out


# Writing ------------------------------------------------------------------------------------


def write_days(df: DataFrame, base: str, *, day: str = "Date", per_day_files: int | None = None) -> None:
    """Replace the days present in the frame, leaving other days alone.

    Rows of a day are spread over as many files as their volume asks for: the
    rebalance splits large days and joins small ones. Running it again leaves the
    table unchanged.
    """
    keyed = df.select(*[c for c in df.columns if c != day], F.col(day).cast("date").alias("date"))
    keyed = keyed.withColumn("SignalID", F.col("SignalID").cast("string"))
    spread = keyed.repartition(per_day_files, "date", "SignalID") if per_day_files else keyed.hint("rebalance", "date")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(base)


def with_day(df: DataFrame, period: str) -> DataFrame:
    """Date taken from the row's own period, the column ``period``."""
    return df.withColumn("Date", F.to_date(period))


def to_milliseconds(ts: str):
    """A wall-clock value rounded to milliseconds."""
    ms = F.round(F.unix_micros(F.col(ts).cast("timestamp")) / 1000).cast("bigint")
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))]
    df.withColumns({c: to_milliseconds(c) for c in stamps}).write.mode("overwrite").parquet(path)


# Publishing ---------------------------------------------------------------------------------


def publish_window(
    published: DataFrame, new: DataFrame, period: str, *, start=None, report_start=None, report_end=None, weekly: bool = False
) -> DataFrame:
    """Published rows before a window followed by the new rows in it.

    Weekly tables start at the Tuesday of the start's week. Without a start the new
    rows replace everything.
    """
    p = F.col(period)
    if start is None:
        kept = published.limit(0)
    else:
        first = F.lit(start).cast("date")
        first = round_to_tuesday(first) if weekly else first
        kept = published.where(p < first)
        new = new.where(p >= first)
    if report_start is not None:
        kept = kept.where(p >= F.lit(report_start).cast("date"))
    if report_end is not None:
        new = new.where(p < F.add_months(F.lit(report_end).cast("date"), 1))
    return kept.unionByName(new, allowMissingColumns=True)


def replace_from_first(published: DataFrame, new: DataFrame, period: str, asof=None) -> DataFrame:
    """Replace everything from the first period of the new rows on."""
    p = F.col(period)
    fresh = new.where(p.isNotNull())
    if asof is not None:
        fresh = fresh.where(p >= F.lit(asof))
    first = fresh.agg(F.min(p)).scalar()
    kept = published.where(F.coalesce(p < first, F.lit(True)))
    return kept.unionByName(fresh, allowMissingColumns=True)


def load_once(df: DataFrame, table: str, *, period: str | None = None, start=None, end=None) -> None:
    """Truncate and load a table, with optional bounds."""
    if period and start is not None:
        df = df.where(F.col(period) >= F.lit(start))
    if period and end is not None:
        df = df.where(F.col(period) <= F.lit(end))
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def table_name(path: str) -> str:
    """Name of a published table from its path: ``cor/mo/aogd.parquet`` is ``cor_mo_aogd``."""
    return path.removesuffix(".parquet").strip("/").replace("/", "_")


def key_value(key: str, df: DataFrame, id: str | None = None) -> DataFrame:
    """A table as rows of a key and JSON.

    Without ``id`` the whole table is one row with an array, as the report stores its configuration
    tables: the objects are made and put in order in many tasks, by ranges of rows; one task joins the
    texts of the ranges. With ``id``, a column that tells rows apart, every row is stored under
    ``key:id`` as an object of its own, whatever the table's size.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    if id is not None:
        return df.select(F.concat_ws(":", F.lit(key), F.col(id).cast("string")).alias("key"), F.to_json(row).alias("data"))
    ranges = df.repartitionByRange(*df.columns).select(F.spark_partition_id().alias("_range"), row.alias("_row"))
    texts = ranges.groupBy("_range").agg(F.to_json(F.array_sort(F.collect_list("_row"))).alias("_text"))
    texts = texts.select(F.struct("_range", F.expr("substring(_text, 2, length(_text) - 2)").alias("_text")).alias("_part"))
    joined = F.array_join(F.array_sort(F.collect_list("_part")).getField("_text"), ",")
    return texts.agg(F.concat(F.lit("["), joined, F.lit("]")).alias("data")).select(F.lit(key).alias("key"), "data")


# Nested signal details ----------------------------------------------------------------------


def signal_details(raw: DataFrame, filtered: DataFrame, adjusted: DataFrame) -> DataFrame:
    """Raw and repaired hourly volumes of a signal's day in one nested row.

    An array holds one day of one signal: detectors times 24 hours.
    """
    key = ["SignalID", "Timeperiod", "Detector", "CallPhase"]
    none = lambda kind: F.lit(None).cast(kind)
    tagged = (
        raw.select(*key, F.col("vol").cast("double").alias("vol_rc"), none("int").alias("Good_Day"), none("double").alias("_ac"))
        .union(filtered.select(*key, none("double"), F.col("Good_Day").cast("int"), none("double")))
        .union(adjusted.select(*key, none("double"), none("int"), F.col("vol").cast("double")))
    )
    rows = tagged.groupBy(*key).agg(F.max("vol_rc").alias("vol_rc"), F.max("Good_Day").alias("Good_Day"), F.max("_ac").alias("_ac"))
    bad = F.col("Good_Day") == 0
    item = F.struct(
        F.col("Detector").alias("detector"), F.hour("Timeperiod").alias("hour"), F.col("CallPhase").alias("callphase"),
        F.col("vol_rc").cast("int").alias("vol_rc"), F.when(bad, F.col("_ac").cast("int")).alias("vol_ac"), bad.alias("bad_day"),
    )
    return rows.groupBy("SignalID", F.to_date("Timeperiod").alias("Date")).agg(F.array_sort(F.collect_list(item)).alias("data"))


def store_signal_details(details: DataFrame, table: str, *, buckets: int = 64) -> None:
    """Details in buckets of signals, by signal and day inside each file.

    A read of one signal opens the files of its bucket, one for each day range written, and skips
    the row groups of other signals and days there.
    """
    writer = details.repartition(buckets, "SignalID").write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, "SignalID").sortBy("SignalID", "Date").saveAsTable(table)


def read_signal_details(details: DataFrame, signal: str | None = None, start=None, end=None) -> DataFrame:
    """Nested details back to rows (S29); the signal and days are filtered where the rows are still nested, so they reach the scan."""
    df = details if signal is None else details.where(F.col("SignalID") == signal)
    if start is not None:
        df = df.where(F.col("Date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("Date") <= F.lit(end).cast("date"))
    rows = df.select("SignalID", "Date", F.inline("data"))
    return rows.select(
        (midnight("Date") + F.make_dt_interval(F.lit(0), F.col("hour"))).alias("Timeperiod"), "SignalID",
        F.col("detector").alias("Detector"), F.coalesce("callphase", F.lit(0)).alias("CallPhase"), "vol_rc", "vol_ac", "bad_day",
    )


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Frames of different shapes stacked, missing columns null."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
