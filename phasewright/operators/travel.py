"""Roadway segment travel times and their indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phasewright.functions.calendar import midnight, month_of, onto_date, onto_month_start, tuesday_of_week, week
from phasewright.functions.sketches import merged, quantile, sketch
from phasewright.operators.rollups import CORRIDOR, corridor_by_date, corridor_by_hour, corridor_by_month


def segment_readings(segments: DataFrame, readings: DataFrame) -> DataFrame:
    """Readings with their segment's corridor and length, repeats removed."""
    joined = readings.join(segments.select(F.col("tmc").alias("tmc_code"), "miles", "Corridor", "Subcorridor"), "tmc_code")
    return joined.withColumnRenamed("measurement_tstamp", "Hour").withColumn(
        "reference_minutes", F.col("miles") / F.col("reference_speed") * 60
    ).withColumn("date", F.to_date("Hour")).dropDuplicates()


def _corridor_hours(df: DataFrame, grouping: list[str]) -> DataFrame:
    total = [F.sum(c).alias(c) for c in ("travel_time_minutes", "reference_minutes", "miles")]
    return df.groupBy(*grouping, "Hour").agg(*total)


def _indexes() -> list:
    tt, ref = F.col("travel_time_minutes"), F.avg("reference_minutes")
    return [F.try_divide(F.avg(tt), ref).alias("tti"), F.try_divide(F.percentile(tt, 0.9), ref).alias("pti")]


def travel_time_metrics(df: DataFrame, grouping: list[str]) -> DataFrame:
    """Travel time, planning time and buffer index and speed per corridor and month-hour."""
    hours = _corridor_hours(df, grouping).withColumn("speed", F.try_divide(F.col("miles"), F.col("travel_time_minutes") / 60))
    out = hours.withColumn("Hour", onto_month_start("Hour")).groupBy(*grouping, "Hour").agg(
        *_indexes(), F.avg("speed").alias("speed_mph")
    )
    return out.withColumn("bi", F.col("pti") - F.col("tti"))


def travel_time_sketches(df: DataFrame, grouping: list[str]) -> DataFrame:
    """Travel times of a corridor by day and hour of day: a sketch, and what the means need (V03 for any set of days)."""
    hours = _corridor_hours(df, grouping)
    return hours.groupBy(*grouping, F.to_date("Hour").alias("Date"), F.hour("Hour").alias("hr")).agg(
        sketch(F.col("travel_time_minutes").cast("double")).alias("sketch"), F.sum("travel_time_minutes").alias("minutes"),
        F.sum("reference_minutes").alias("reference"), F.count(F.lit(1)).alias("n"))


def indexes_from_sketches(sketches: DataFrame, grouping: list[str]) -> DataFrame:
    """Travel time, planning time and buffer index by corridor and month-hour from stored sketches; ``p90`` is the sketch's."""
    hour = midnight(month_of("Date")) + F.make_dt_interval(F.lit(0), F.col("hr"))
    out = sketches.groupBy(*grouping, hour.alias("Hour")).agg(
        merged("sketch").alias("sketch"), F.sum("minutes").alias("_tt"), F.sum("reference").alias("_ref"), F.sum("n").alias("n"))
    out = out.withColumn("p90", quantile("sketch", 0.9))
    return out.select(
        *grouping, "Hour", F.try_divide("_tt", "_ref").alias("tti"), F.try_divide(F.col("p90") * F.col("n"), "_ref").alias("pti"), "p90", "n"
    ).withColumn("bi", F.col("pti") - F.col("tti"))


def travel_time_package(df: DataFrame, grouping: list[str], period: str = "monthly") -> DataFrame:
    """Indexes, travel time and speed by corridor on the hours of a month or of a week's Tuesday."""
    hours = _corridor_hours(df, grouping)
    if period == "monthly":
        hours = hours.withColumn("Hour", onto_month_start("Hour"))
    elif period == "weekly":
        first = hours.agg(F.min(F.to_date("Hour"))).scalar()
        hours = hours.withColumn("Hour", onto_date("Hour", tuesday_of_week(week(F.to_date("Hour")), first)))
    else:
        raise ValueError(f"unknown period {period!r}")
    mean = F.avg("travel_time_minutes")
    return hours.groupBy(*grouping, "Hour").agg(
        *_indexes(), mean.alias("tt"), F.try_divide(F.max("miles"), mean / 60).alias("spd")
    )


def hour_shares(cor_vph: DataFrame, *, weekly: bool = False) -> DataFrame:
    """Share of the day's volume by corridor and hour of day, averaged over periods."""
    if weekly:
        first = cor_vph.agg(F.min(F.to_date("Hour"))).scalar()
        period = tuesday_of_week(week(F.to_date("Hour")), first)
    else:
        period = F.month("Hour")
    w = Window.partitionBy(*CORRIDOR, "_p")
    rows = cor_vph.withColumn("_p", period).withColumn("pct", F.try_divide("vph", F.sum("vph").over(w)))
    return rows.groupBy(*CORRIDOR, F.hour("Hour").alias("hr")).agg(F.avg("pct").alias("pct"))


def with_hour_shares(ti: DataFrame, cor_vph: DataFrame, *, weekly: bool = False) -> DataFrame:
    """Index rows with their hour's share of volume as weight, 1 where unknown."""
    shares = hour_shares(cor_vph, weekly=weekly)
    return ti.withColumn("hr", F.hour("Hour")).join(shares, [*CORRIDOR, "hr"], "left").withColumn(
        "pct", F.coalesce("pct", F.lit(1.0))
    )


def index_by_hour(ti: DataFrame, var: str, cor_vph: DataFrame, corridors: DataFrame) -> DataFrame:
    """Share-weighted index by hour of the month (V07); rows meet the hierarchy once per signal."""
    return corridor_by_hour(with_hour_shares(ti, cor_vph), corridors, var, "pct", on=tuple(CORRIDOR))


def index_by_month(ti: DataFrame, var: str, cor_vph: DataFrame, corridors: DataFrame) -> DataFrame:
    rows = with_hour_shares(ti, cor_vph).withColumn("Month", month_of("Hour"))
    return corridor_by_month(rows, corridors, var, "pct", on=tuple(CORRIDOR))


def index_by_week(ti: DataFrame, var: str, cor_vph: DataFrame, corridors: DataFrame) -> DataFrame:
    rows = with_hour_shares(ti, cor_vph, weekly=True).withColumn("Date", F.to_date("Hour"))
    return corridor_by_date(rows, corridors, var, "pct", on=tuple(CORRIDOR))


def buffer_index(tti: DataFrame, pti: DataFrame, period: str) -> DataFrame:
    """Travel and planning time index side by side with their difference."""
    key = ["Corridor", "Zone_Group", period]
    both = tti.select(*key, "tti").join(pti.select(*key, "pti"), key, "full_outer").where("Corridor is not null")
    return both.withColumn("bti", F.col("pti") - F.col("tti"))


def segment_points(segments: DataFrame, text: str = "coordinates") -> DataFrame:
    """Ordered points of a segment from text like "lon lat, lon lat" (V09)."""
    inner = F.coalesce(F.nullif(F.regexp_extract(text, r"'(.*?)'", 1), F.lit("")), F.col(text))
    points = segments.select("tmc", F.posexplode(F.split(inner, r"\s*[,:]\s*")).alias("point", "_xy"))
    xy = F.split(F.trim("_xy"), r"\s+")
    return points.select(
        "tmc", "point", F.get(xy, F.lit(0)).try_cast("double").alias("longitude"), F.get(xy, F.lit(1)).try_cast("double").alias("latitude")
    )


