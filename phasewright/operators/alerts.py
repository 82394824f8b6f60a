"""Watchdog alerts: sources, streaks and filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasewright.operators.runs import day_streak

# Text in a message and the alert it stands for; a later one wins.
MESSAGE_ALERTS = ("Force Offs", "Count", "Max Outs", "Pedestrian Activations", "Missing Records")
PLACE = ["Zone_Group", "Zone", "Corridor"]
LOOK_BACK_DAYS = 90


def _since(day: str, as_of, days: int) -> Column:
    return F.col(day) > F.date_sub(F.lit(as_of).cast("date"), days)


def _placed(df: DataFrame, corridors: DataFrame) -> DataFrame:
    return df.join(corridors.select(*PLACE, "SignalID", "Name"), "SignalID", "left")


def watchdog_alerts(messages: DataFrame, corridors: DataFrame, as_of, *, days: int = 100) -> DataFrame:
    """Watchdog messages classified and placed in the hierarchy."""
    alert = F.lit(None).cast("string")
    for text in MESSAGE_ALERTS:
        alert = F.when(F.col("Message").contains(text), text).otherwise(alert)
    recent = messages.where(F.col("TimeStamp") > F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")).distinct()
    detector = F.replace(F.coalesce("DetectorID", F.lit("0")), F.col("SignalID"), F.lit("")).try_cast("int")
    return _placed(recent, corridors).where("Corridor is not null").select(
        *PLACE, "SignalID", F.col("Phase").cast("string").alias("CallPhase"), detector.alias("Detector"),
        alert.alias("Alert"), "Name", F.to_date("TimeStamp").alias("Date"),
    )


def bad_detection_alerts(bad: DataFrame, config: DataFrame, corridors: DataFrame, as_of) -> DataFrame:
    """Bad vehicle detectors of the last ninety days."""
    day = F.lit(as_of).cast("date")
    recent = bad.where(F.col("Date").between(F.date_sub(day, LOOK_BACK_DAYS), F.date_sub(day, 1)))
    on = ["SignalID", "Detector", *(["Date"] if "Date" in config.columns else [])]
    lane = F.concat(F.trim("ApproachDesc"), F.lit(" Lane "), F.coalesce(F.col("LaneNumber").cast("string"), F.lit("NA")))
    name = F.when(F.col("Corridor") == "Ramp Meter", F.regexp_replace("Name", "^([^@]*)@", "$1-")).otherwise(F.col("Name"))
    rows = _placed(recent.join(config.select(*on, "CallPhase", "ApproachDesc", "LaneNumber"), on, "left"), corridors)
    return rows.where("Corridor is not null").select(
        *PLACE, "SignalID", "CallPhase", "Detector", "Date", F.lit("Bad Vehicle Detection").alias("Alert"),
        name.alias("Name"), F.when(F.col("ApproachDesc").isNull(), "").otherwise(lane).alias("ApproachDesc"),
    )


def bad_ped_alerts(bad: DataFrame, corridors: DataFrame, as_of) -> DataFrame:
    """Bad push-buttons of the last ninety days."""
    day = F.lit(as_of).cast("date")
    recent = bad.where(F.col("Date").between(F.date_sub(day, LOOK_BACK_DAYS), F.date_sub(day, 1)))
    return _placed(recent, corridors).select(
        *PLACE, "SignalID", "Detector", "Date", F.lit("Bad Ped Detection").alias("Alert"), "Name"
    )


def bad_comm_alerts(quality: DataFrame, corridors: DataFrame, as_of, *, least: float = 90) -> DataFrame:
    """Days of poor communication quality."""
    day = F.lit(as_of).cast("date")
    recent = quality.where(F.col("Date").between(F.date_sub(day, LOOK_BACK_DAYS), F.date_sub(day, 1)) & (F.col("AvgQuality") < least))
    return _placed(recent.withColumnRenamed("AssetNum", "SignalID"), corridors).where("Corridor is not null").select(
        *PLACE, "SignalID", F.lit(0).alias("CallPhase"), F.lit(0).alias("Detector"), "Date",
        F.lit("Bad Comm").alias("Alert"), "Name",
    )


def alert_streaks(sources: list[DataFrame], as_of, *, look_back_days: int = LOOK_BACK_DAYS) -> DataFrame:
    """All alerts of the last ``look_back_days`` days with their run of consecutive days.

    Rows are distinct by alert and day before the windows, so a partition has at most
    ninety days of one alert (times its few approach descriptions).
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    for c in ("CallPhase", "Detector", "ApproachDesc"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    rows = rows.where(F.col("Corridor").isNotNull() & _since("Date", as_of, look_back_days)).select(
        *PLACE, "SignalID", F.coalesce(F.col("CallPhase").try_cast("int"), F.lit(0)).alias("CallPhase"),
        F.coalesce(F.col("Detector").try_cast("int"), F.lit(0)).alias("Detector"), "Date", "Name", "Alert", "ApproachDesc",
    ).distinct()
    key = ["Zone_Group", "Zone", "SignalID", "CallPhase", "Detector", "Alert"]
    return day_streak(rows, key, "Date", "streak")


def filter_alerts(
    alerts: DataFrame, start, end, alert: str, *, zone_group: str | None = None, corridor: str | None = None,
    phase: int | None = None, pattern: str | None = None, active_days: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Alerts of a kind in a date range: the table of occurrences and the rows behind it.

    A streak is current only on the last date of the kind. ``active_days`` keeps alerts
    whose current streak is longer: 0 for active, 2 for active three days.
    """
    in_range = alerts.where(F.col("Date").between(F.lit(start).cast("date"), F.lit(end).cast("date")) & (F.col("Alert") == alert))
    latest = in_range.agg(F.max("Date")).scalar()
    rows = in_range.withColumn("_current", F.when(F.col("Date") == latest, F.col("streak")).otherwise(0))
    if corridor is not None:
        rows = rows.where(F.col("Corridor") == corridor)
    elif zone_group is not None:
        rows = rows.where(F.col("Zone_Group") == zone_group)
    if pattern:
        expr = f"(?i){pattern}"
        rows = rows.where(F.col("Name").rlike(expr) | F.col("Corridor").rlike(expr) | F.col("SignalID").rlike(expr))
    if phase is not None and alert != "Missing Records":
        rows = rows.where(F.col("CallPhase") == phase)
    key = ["Zone", "Corridor", "SignalID", "CallPhase", "Detector", "ApproachDesc", "Name", "Alert"]
    table = rows.groupBy(*key).agg(F.count("*").alias("Occurrences"), F.max("_current").alias("Streak"))
    if active_days is not None:
        table = table.where(F.col("Streak") > active_days)
        rows = rows.join(table.select("SignalID", "Detector").distinct(), ["SignalID", "Detector"], "left_semi")
    return table, rows.drop("_current")
