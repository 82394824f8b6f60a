"""Reads of published measures: merges, points, trends, comparisons (Q01-Q21)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasewright.functions.calendar import floor_hour, month_of
from phasewright.functions.stats import change, with_delta
from phasewright.operators.runs import complete_dates
from phasewright.schemas import Metric

Reader = Callable[[str], DataFrame]
LEVELS = {"corridor": "cor", "subcorridor": "sub", "signal": "sig"}
RESOLUTIONS = {"quarterly": "qu", "monthly": "mo", "weekly": "wk", "daily": "dy"}


def merge_recomputed(old: DataFrame, new: DataFrame, var: str, period: str, report_start, calc_start) -> DataFrame:
    """Published rows up to the recomputed window, then the new rows, change recomputed over both (Q01).

    Quarters are replaced whole. Merging twice gives the same as merging once.
    """
    if period == "Quarter":
        return new
    p = F.col(period)
    kept = old.where((p >= F.lit(report_start)) & (p < F.lit(calc_start)))
    both = kept.drop("delta").unionByName(new.where(p >= F.lit(calc_start)).drop("delta"), allowMissingColumns=True)
    entity = [c for c in ("Zone_Group", "Corridor", "SignalID") if c in both.columns]
    return with_delta(both, var, entity, period)


def query_metric(
    read: Reader, metric: Metric, *, level: str = "corridor", resolution: str = "monthly", hourly: bool = False,
    zone_group: str = "All", corridor: str | None = None, month=None, quarter: str | None = None, upto: bool = True,
) -> DataFrame:
    """Rows of a published measure for a place and up to (or in) a period (Q02).

    ``read`` maps a table name to its frame, for instance ``spark.table``; the filters
    are plain predicates, so they reach the scan.
    """
    is_hourly = hourly and metric.hourly_table is not None
    df = read(f"{LEVELS[level]}_{RESOLUTIONS[resolution]}_{metric.hourly_table if is_hourly else metric.table}")
    if not (level == "signal" and zone_group == "All"):
        df = df.where(F.col("Zone_Group") == zone_group)
    if corridor is not None:
        df = df.where(F.col("Corridor") == corridor)
    if resolution == "quarterly":
        limit, value = F.col("Quarter"), F.lit(quarter)
    else:
        first = F.lit(month).cast("date")
        last = F.date_sub(F.add_months(first, 1), 1)
        if is_hourly:
            end = F.add_months(first, 1).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(1))
            df = df.where(F.col("Hour") <= end)
            return df if upto else df.where(F.col("Hour") >= first.cast("timestamp_ntz"))
        limit, value = (F.col("Month"), first) if resolution == "monthly" else (F.col("Date"), last)
    return df.where(limit <= value if upto else limit == value)


def before_after(
    weekly: DataFrame, var: str, corridors: DataFrame, zone_group: str,
    before: tuple, after: tuple, *, period: str = "Date",
) -> DataFrame:
    """Mean of a weekly series before and after, per corridor or signal, with the change (Q03).

    The before window runs from its start to its end; the after window from its start
    to the end of its last day.
    """
    d = F.col(period)
    names = corridors.groupBy("SignalID").agg(F.min("Description").alias("Description")).withColumnRenamed("SignalID", "Corridor")
    b0, b1, a0, a1 = [F.lit(x).cast("date") for x in (*before, *after)]
    rows = weekly.where((F.col("Zone_Group") == zone_group) & (d >= b0) & (d < F.date_add(a1, 1)))
    out = rows.groupBy("Corridor").agg(
        F.avg(F.when(d <= b1, F.col(var))).alias("before"), F.avg(F.when(d >= a0, F.col(var))).alias("after"),
        F.bool_or((d <= b1) | (d >= a0)).alias("_in"),
    ).where("_in").drop("_in")
    return out.join(names, "Corridor", "left").select(
        "Corridor", F.coalesce("Description", "Corridor").alias("Description"), "before", "after",
        change(F.col("after"), F.col("before")).alias("delta"),
    ).orderBy(F.desc("after"))


def before_after_scatter(x: DataFrame, y: DataFrame) -> DataFrame:
    """Two before/after comparisons side by side (Q04)."""
    key = ["Corridor", "Description"]

    def side(df, s):
        return df.select(*key, F.col("before").alias(f"before_{s}"), F.col("after").alias(f"after_{s}"))

    return side(x, "x").join(side(y, "y"), key, "full_outer")


def corridor_summary(metrics: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Monthly measures of each corridor side by side with their changes (Q05).

    ``metrics`` maps a column name to a monthly frame and its value column; the first
    one decides the rows.
    """
    key = ["Zone_Group", "Corridor", "Month"]
    parts = [
        df.select(*key, F.col(var).alias(name), F.col("delta").alias(f"{name}_delta")) for name, (df, var) in metrics.items()
    ]
    return reduce(lambda a, b: a.join(b, key, "left"), parts)


def summary_with_goals(
    summary: DataFrame, month, zone_group: str, goals: dict[str, tuple[float | None, str]], *, goal_on_change: tuple[str, ...] = ("tp",)
) -> DataFrame:
    """One row per corridor and measure with goal and improvement checks (Q06).

    ``goals`` maps a measure to its goal and direction (">" or "<"); measures in
    ``goal_on_change`` are held to their change instead of their value.
    """
    chosen = summary.where((F.col("Month") == F.lit(month).cast("date")) & (F.col("Zone_Group") == zone_group))
    cells = F.array(*[
        F.struct(
            F.lit(name).alias("Metric"), F.col(name).cast("double").alias("value"), F.col(f"{name}_delta").cast("double").alias("delta"),
            F.lit(goal).cast("double").alias("goal"), F.lit(sign).alias("sign"), F.lit(name in goal_on_change).alias("on_change"),
        )
        for name, (goal, sign) in goals.items()
    ])
    rows = chosen.select("Corridor", F.explode(cells).alias("_c")).select("Corridor", "_c.*")
    checked = F.when(F.col("on_change"), F.col("delta")).otherwise(F.col("value"))

    def ok(x: Column, limit: Column) -> Column:
        return F.when(F.col("sign") == ">", x >= limit).otherwise(x <= limit)

    meets, better = ok(checked, F.col("goal")), ok(F.col("delta"), F.lit(0.0))
    return rows.select(
        "Corridor", "Metric", "value", "delta", "goal",
        F.when(meets, "Meeting Goal").when(~meets, "Not Meeting Goal").alias("check_goal"),
        F.when(better, "Improvement").when(~better, "Deterioration").alias("check_delta"),
    )


def pivot_corridors(rows: DataFrame, value: str, corridors: list[str]) -> DataFrame:
    """Measures down, the named corridors across (Q06)."""
    return rows.groupBy("Metric").pivot("Corridor", corridors).agg(F.first(value))


def value_box(
    read: Reader, metric: Metric, zone_group: str, *, corridor: str | None = None, month=None, quarter: str | None = None
) -> DataFrame:
    """One value and its change for a month or quarter (Q07, Q15); all corridors is the zone group's own row."""
    df = query_metric(
        read, metric, resolution="monthly" if quarter is None else "quarterly", zone_group=zone_group,
        corridor=corridor, month=month, quarter=quarter, upto=False,
    )
    if corridor is None:
        df = df.where(F.col("Zone_Group") == F.col("Corridor"))
    return df.select("Zone_Group", "Corridor", metric.variable, F.coalesce("delta", F.lit(0.0)).alias("delta"))


def monthly_series(read: Reader, metric: Metric, zone_group: str, month, corridor: str | None = None) -> DataFrame:
    df = query_metric(read, metric, zone_group=zone_group, corridor=corridor, month=month)
    return df if corridor is not None else df.where(F.col("Zone_Group") == F.col("Corridor"))


def first_and_last(series: DataFrame, var: str, by: list[str]) -> DataFrame:
    """First and last month of a series with their values (Q08)."""
    return series.groupBy(*by).agg(
        F.min("Month").alias("first_month"), F.min_by(var, "Month").alias("first_value"),
        F.max("Month").alias("last_month"), F.max_by(var, "Month").alias("last_value"),
    )


def trend(read: Reader, metric: Metric, zone_group: str, month, *, level: str = "corridor", line: str = "weekly") -> dict[str, DataFrame]:
    """Month bar, weekly line and hourly line, with the average's row marked (Q09)."""
    def marked(df):
        return df.withColumn("is_average", F.col("Corridor") == zone_group)

    out = {
        "bar": marked(query_metric(read, metric, level=level, zone_group=zone_group, month=month, upto=False)),
        "line": marked(query_metric(read, metric, level=level, resolution=line, zone_group=zone_group, month=month)).where(
            F.col(metric.variable).isNotNull()
        ),
    }
    if metric.hourly_table:
        out["hours"] = marked(
            query_metric(read, metric, level=level, hourly=True, zone_group=zone_group, month=month, upto=False)
        )
    return out


def completed_days(daily: DataFrame, var: str, entity: list[str]) -> DataFrame:
    """Every entity on every day of the months covered, 0 where absent (Q10, long form)."""
    edges = daily.agg(
        F.struct(month_of(F.min("Date")).alias("lo"), F.last_day(F.max("Date")).alias("hi"))
    ).scalar()
    summed = daily.groupBy(*entity, "Date").agg(F.sum(var).alias(var))
    keyed = daily.select(*entity).distinct().withColumn("_e", edges)
    grid = keyed.select(*entity, F.explode(F.sequence(F.col("_e.lo"), F.col("_e.hi"))).alias("Date"))
    return grid.join(summed, [*entity, "Date"], "left").withColumn(var, F.coalesce(var, F.lit(0)))


def heat_map(daily: DataFrame, var: str, entity: list[str], days: list[str]) -> DataFrame:
    """Entities down, the named days across (Q10)."""
    long = completed_days(daily, var, entity).withColumn("_d", F.date_format("Date", "yyyy-MM-dd"))
    return long.groupBy(*entity).pivot("_d", days).agg(F.sum(var)).na.fill(0)


# Meaning of the daily camera status.
CAMERA_STATUS = {0: "Camera Down", 1: "Working at encoder, but not 511", 2: "Working on 511"}


def status_matrix(daily: DataFrame, zone_group: str, days: list[str]) -> DataFrame:
    """Status label of each camera on the named days, absent days down (Q11)."""
    rows = daily.where(F.col("Corridor") != zone_group).select(
        F.col("Corridor").alias("CameraID"), "Description", F.date_format("Date", "yyyy-MM-dd").alias("_d"), "up"
    ).distinct()
    label = F.create_map(*[x for k, v in CAMERA_STATUS.items() for x in (F.lit(k), F.lit(v))])
    wide = rows.groupBy("CameraID", "Description").pivot("_d", days).agg(F.max("up")).na.fill(0)
    return wide.select("CameraID", "Description", *[label[F.round(F.col(f"`{d}`")).cast("int")].alias(d) for d in days])


def compare_with_past(hourly: DataFrame, var: str, by: list[str]) -> DataFrame:
    """Each month's hours beside those of the month and the year before (Q12).

    ``hourly`` has Month and month_hour. The two self-joins are on entity and hour.
    """
    at = F.col("month_hour")

    def shifted(months: int, name: str):
        moved = F.add_months(F.to_date(at), months).cast("timestamp_ntz") + (at - F.to_date(at).cast("timestamp_ntz"))
        return hourly.select(*by, moved.alias("month_hour"), F.col(var).alias(name))

    key = [*by, "month_hour"]
    return hourly.select(*by, "Month", "month_hour", var).join(shifted(1, f"{var}_last_month"), key, "left").join(
        shifted(12, f"{var}_last_year"), key, "left"
    )


def last_modified(rows: DataFrame, zone: str | None = None, month=None) -> DataFrame:
    """Latest version per month and zone, ties kept (Q13)."""
    if zone is not None:
        rows = rows.where(F.col("Zone") == zone)
    if month is not None:
        rows = rows.where(F.col("Month") == F.lit(month).cast("date"))
    newest = rows.groupBy("Month", "Zone").agg(F.max("LastModified").alias("LastModified"))
    return rows.join(newest, ["Month", "Zone", "LastModified"], "left_semi").select(*rows.columns)


def latest_versions(rows: DataFrame, n: int = 10) -> DataFrame:
    """Latest n versions per month and zone, ties kept (Q14); the rank limit is applied before the shuffle too."""
    w = Window.partitionBy("Month", "Zone").orderBy(F.desc("LastModified"))
    return rows.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") <= n).drop("_rank")


def published_range(df: DataFrame, period: str, first, last, zone_group: str | None = None) -> DataFrame:
    """Rows of a published table between two periods (Q15)."""
    out = df.where(F.col(period).between(F.lit(first), F.lit(last)))
    return out if zone_group is None else out.where(F.col("Corridor") == zone_group)


def signal_counts(counts: DataFrame, signal: str, start, end) -> DataFrame:
    """Raw, filtered or adjusted counts of a signal, missing volumes 0 (Q16)."""
    day = F.to_date("Timeperiod")
    return counts.where((F.col("SignalID") == signal) & day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(
        "SignalID", "Detector", "CallPhase", "Timeperiod", F.coalesce("vol", F.lit(0)).alias("vol")
    )


def signal_series(df: DataFrame, signal: str, var: str, month, *, period: str = "Hour", fill: bool = True) -> DataFrame:
    """A signal's month by phase, hours completed with 0 (Q17)."""
    first = F.lit(month).cast("date")
    rows = df.where((F.col("SignalID") == signal) & (month_of(period) == first)).select(
        "SignalID", "CallPhase", floor_hour(period).alias(period) if fill else F.col(period), var
    )
    if not fill:
        return rows
    out = complete_dates(rows, ["SignalID", "CallPhase"], period, step="interval 1 hour")
    return out.withColumn(var, F.coalesce(var, F.lit(0.0)))


def map_table(read: Reader, metric: Metric, month, corridors: DataFrame) -> DataFrame:
    """A month's signal values with coordinates; signals without them drop (Q18)."""
    df = query_metric(read, metric, level="signal", zone_group="All", month=month, upto=False)
    return df.drop("Description").withColumnRenamed("Corridor", "SignalID").join(
        corridors.select("SignalID", "Latitude", "Longitude", "Description"), "SignalID", "left"
    ).where("Latitude is not null")


def ranked_signals(mapped: DataFrame, metric: Metric) -> DataFrame:
    """Signals from worst to best for uptimes, else from highest (Q19)."""
    var = metric.variable
    out = mapped.select("SignalID", F.col("Description").alias("Signal"), F.col("Zone_Group").alias("Corridor"), var).distinct()
    return out.orderBy(F.asc(var) if var == "uptime" else F.desc(var))


def reconstitute(frames: dict[str, DataFrame], column: str) -> DataFrame:
    """Named frames stacked, the name in a column (Q20)."""
    named = [df.withColumn(column, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def compare_frames(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one frame missing from the other, repeats counted (Q21)."""
    b = b.select(*a.columns)
    return a.exceptAll(b).withColumn("only_in", F.lit("first")).unionByName(
        b.exceptAll(a).withColumn("only_in", F.lit("second"))
    )
