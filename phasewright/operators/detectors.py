"""Detector configuration: assembled from the inventory tables and selected per measure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasewright.operators.events import count_detector_flag


def latest_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; a plain aggregate, so it combines before the shuffle."""
    row = F.max_by(F.struct("*"), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select("_row.*")


def detector_inventory(tables: dict[str, DataFrame], as_of=None) -> DataFrame:
    """Nine inventory tables joined to one row per detector in force on a date.

    ``tables`` has detectors, approaches, signals, detection_type_detector,
    detection_types, lane_types, hardwares, movement_types and direction_types.
    """
    detectors, signals = tables["detectors"], tables["signals"]
    if as_of is not None:
        d = F.lit(as_of).cast("timestamp_ntz")
        detectors = detectors.where((F.col("DateAdded") <= d) & (F.col("DateDisabled").isNull() | (F.col("DateDisabled") > d)))
        signals = signals.where(F.col("Start") <= d)
    detectors = latest_per(detectors, ["DetectorID"], ["DateAdded", "ID"])
    signals = latest_per(signals, ["SignalID"], ["VersionID"])
    types = (
        tables["detection_type_detector"].join(tables["detection_types"], "DetectionTypeID")
        .groupBy("ID").agg(F.concat_ws(", ", F.array_sort(F.collect_list("Description"))).alias("DetectionTypeDesc"))
    )
    joined = (
        detectors.join(tables["movement_types"], "MovementTypeID")
        .join(tables["hardwares"], "DetectionHardwareID")
        .join(tables["lane_types"], "LaneTypeID")
        .join(types, "ID")
        .join(tables["approaches"], "ApproachID")
        .join(tables["direction_types"], "DirectionTypeID")
        .join(signals, "SignalID")
    )
    return joined.select(
        "SignalID", "DetectorID", F.col("DetChannel").alias("Detector"), call_phase().alias("CallPhase"),
        (F.col("DistanceFromStopBar") / F.col("MPH") * 3600 / 5280).alias("TimeFromStopBar"),
        "DistanceFromStopBar", "ApproachDesc", "LaneTypeDesc", "DetectionTypeDesc",
        "DirectionTypeDesc", "DateAdded", count_priority().alias("CountPriority"),
    )


def call_phase() -> Column:
    """Phase a detector calls, by movement type."""
    move, protected, permissive = F.col("MovementTypeAbbr"), F.col("ProtectedPhaseNumber"), F.col("PermissivePhaseNumber")
    return (
        F.when(move.isin("L", "T", "R", "TL"), protected)
        .when((move == "TR") & (permissive > 0), permissive)
        .when(move == "TR", protected)
        .otherwise(0)
    )


def count_priority() -> Column:
    lane, kinds = F.col("LaneTypeDesc"), F.col("DetectionTypeDesc")
    return (
        F.when(lane == "Exit", 0)
        .when((lane == "Vehicle") & kinds.contains("Advanced Count"), 1)
        .when((lane == "Vehicle") & kinds.contains("Lane-by-lane Count"), 2)
        .otherwise(3)
    )


def ped_inputs(events: DataFrame, as_of) -> DataFrame:
    """Pedestrian inputs seen in the ninety days before a date."""
    since = F.date_sub(F.lit(as_of).cast("date"), 90).cast("timestamp_ntz")
    seen = events.where((F.col("EventCode") == 90) & (F.col("Timestamp") > since))
    return seen.select("SignalID", F.col("EventParam").alias("Detector")).distinct().withColumn("CallPhase", F.col("Detector"))


def included_detectors(events: DataFrame, as_of, *, code: int = 82, every_days: int = 3, look_back_days: int = 365) -> DataFrame:
    """Detectors seen between 08:00 and 09:00 on every third day of the past year."""
    start = F.date_sub(F.lit(as_of).cast("date"), look_back_days)
    day = F.to_date("Timestamp")
    since = F.datediff(day, start)
    at = F.col("Timestamp") - day.cast("timestamp_ntz")
    hour = (at >= F.make_dt_interval(F.lit(0), F.lit(8))) & (at <= F.make_dt_interval(F.lit(0), F.lit(9)))
    return (
        events.where((F.col("EventCode") == code) & since.between(0, look_back_days) & (since % every_days == 0) & hour)
        .select("SignalID", F.col("EventParam").alias("Detector")).distinct()
    )


def good_config(inventory: DataFrame, included: DataFrame) -> DataFrame:
    """The detector list used by the measures."""
    valid = inventory.where("Detector is not null and CallPhase is not null")
    worst = valid.agg(F.max("CountPriority") + 1).scalar()
    flagged = valid.join(included.withColumn("Included", F.lit(1)), ["SignalID", "Detector"], "left")
    return flagged.withColumn(
        "TimeFromStopBar", F.round(F.coalesce("TimeFromStopBar", F.lit(0.0)), 1)
    ).withColumn("CountPriority", F.coalesce(F.col("CountPriority"), worst))


def nightly_config(tables: dict[str, DataFrame], events: DataFrame, as_of) -> dict[str, DataFrame]:
    """The three configuration tables of a date."""
    inventory = detector_inventory(tables, as_of)
    stamp = F.lit(as_of).cast("date")
    return {
        "det_config": inventory.withColumn("Date", stamp),
        "det_config_good": good_config(inventory, included_detectors(events, as_of)).withColumn("Date", stamp),
        "ped_config": ped_inputs(events, as_of).withColumn("Date", stamp),
    }


def _day_keys(config: DataFrame) -> list[str]:
    return ["Date"] if "Date" in config.columns else []


def for_arrivals(config: DataFrame) -> DataFrame:
    """Exit or advanced-count detectors of the best kind per signal and phase."""
    kind = F.when(F.col("DetectionTypeDesc").contains("Exit"), 0).when(
        F.col("DetectionTypeDesc").contains("Advanced Count"), 1
    ).otherwise(2)
    ranked = config.where("Detector is not null").withColumn("_p", kind).where("_p < 2")
    best = F.min("_p").over(Window.partitionBy("SignalID", "CallPhase", *_day_keys(config)))
    return ranked.withColumn("_best", best).where("_p = _best").select(
        "SignalID", "Detector", "CallPhase", "TimeFromStopBar", *_day_keys(config)
    )


def for_spillback(config: DataFrame, bad: DataFrame | None = None) -> DataFrame:
    """Advanced count or speed detectors at a known distance that are not bad that day."""
    kinds = F.col("DetectionTypeDesc")
    dc = config.where(kinds.contains("Advanced Count") | kinds.contains("Advanced Speed")).where(
        "DistanceFromStopBar is not null and Detector is not null"
    ).select("SignalID", "Detector", "CallPhase", "TimeFromStopBar", *_day_keys(config))
    if bad is None:
        return dc
    on = ["SignalID", "Detector", *[c for c in _day_keys(config) if c in bad.columns]]
    return dc.join(bad.where("Good_Day is not null"), on, "left_anti")


def for_split_failures(config: DataFrame) -> DataFrame:
    """Stop bar presence detectors."""
    return config.where(F.col("DetectionTypeDesc").contains("Stop Bar Presence")).where("Detector is not null").select(
        "SignalID", "Detector", "CallPhase", "TimeFromStopBar", *_day_keys(config)
    )


def for_volumes(config: DataFrame) -> DataFrame:
    """Detectors at the least count priority of their signal and phase."""
    least = F.min("CountPriority").over(Window.partitionBy("SignalID", "CallPhase", *_day_keys(config)))
    return config.withColumn("_least", least).where("CountPriority = _least").select(
        "SignalID", "Detector", "CallPhase", "CountPriority", "TimeFromStopBar", *_day_keys(config)
    )


def for_approach_delay(config: DataFrame) -> DataFrame:
    """Latest advanced-count row per detector, with the count-detector flag."""
    newest = latest_per(config.where("DateAdded is not null"), ["SignalID", "Detector"], ["DateAdded"])
    return count_detector_flag(newest).where(F.col("DetectionTypeDesc").contains("Advanced Count"))


def without_bad(config: DataFrame, bad: DataFrame) -> DataFrame:
    """Detector list minus the day's bad detectors."""
    on = ["SignalID", "Detector", *[c for c in _day_keys(config) if c in bad.columns]]
    return config.join(bad.where("Good_Day <> 1"), on, "left_anti")


def pad_signal_ids(config: DataFrame, width: int = 5) -> DataFrame:
    """Zero-padded signal ids."""
    return config.withColumn("SignalID", F.lpad("SignalID", width, "0"))


def subcorridor_view(corridors: DataFrame) -> DataFrame:
    """The hierarchy moved down one level."""
    moved = corridors.where("Subcorridor is not null")
    others = [c for c in corridors.columns if c not in ("Zone_Group", "Zone", "Corridor", "Subcorridor")]
    return moved.select(
        F.col("Zone").alias("Zone_Group"), F.col("Corridor").alias("Zone"), F.col("Subcorridor").alias("Corridor"), *others
    )


def unmatched_corridors(signals: DataFrame, segments: DataFrame) -> DataFrame:
    """Corridor and subcorridor names found on one side only."""
    on = ["Corridor", "Subcorridor"]
    a = signals.select(*on).distinct().withColumn("_a", F.lit("signals"))
    b = segments.select(*on).distinct().withColumn("_b", F.lit("segments"))
    return a.join(b, on, "full_outer").where("_a is null or _b is null").select(
        *on, F.coalesce("_a", "_b").alias("only_in")
    )


def clean_corridors(raw: DataFrame, *, included_only: bool = True) -> DataFrame:
    """Typed hierarchy: last modified rows, named and described."""
    modified = F.coalesce(F.col("Modified"), F.lit("1900-01-01").cast("date"))
    newest = F.max("_m").over(Window.partitionBy("SignalID", "Zone", "Corridor"))
    rows = raw.withColumn("_m", modified).withColumn("_newest", newest).where("_m = _newest and Corridor is not null")
    if included_only:
        rows = rows.where("Include")
    name = F.concat_ws(" @ ", F.coalesce("Main_Street_Name", F.lit("NA")), F.coalesce("Side_Street_Name", F.lit("NA")))
    return rows.select(
        "SignalID", "Zone", "Zone_Group", "Corridor", "Subcorridor", "Milepost", "Agency", name.alias("Name"),
        F.to_date("Asof").alias("Asof"), "Latitude", "Longitude",
        F.concat(F.col("SignalID"), F.lit(": "), name).alias("Description"),
    )
