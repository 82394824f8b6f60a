"""All levels of many measures in one aggregate, in long form.

Signal rows of any number of tables and periods stand in one frame: ``per``, ``table``, ``SignalID``,
``at``, ``value``, ``weight``, ``delta``. They meet the hierarchy once, and one aggregate with grouping
sets makes corridors and subcorridors of them; zone groups, quarters and changes come from its rows, which
are as many as corridors and periods.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phasewright.functions.calendar import quarter_of
from phasewright.functions.stats import change, sum0, wmean
from phasewright.session import stage

LONG = ["level", "per", "table", "Zone_Group", "Corridor", "at", "value", "delta"]


def _with_change(df: DataFrame, *entity: str) -> DataFrame:
    w = Window.partitionBy("per", "table", *entity).orderBy("at")
    return df.withColumn("delta", change(F.col("value"), F.lag("value").over(w)))


def signal_periods(measures: DataFrame) -> DataFrame:
    """One row per table, signal and period with its change: weighted means, or sums where ``summed`` is true.

    ``measures`` has ``per``, ``table``, ``SignalID``, ``at``, ``value``, ``weight`` and ``summed``.
    The rows are dealt by table and signal once; the aggregate and the change use that dealing.
    """
    dealt = measures.repartition("per", "table", "SignalID")
    value = F.when(F.max("summed"), sum0("value")).otherwise(wmean("value", "weight"))
    rows = dealt.groupBy("per", "table", "SignalID", "at").agg(value.alias("value"), sum0("weight").alias("weight"))
    return _with_change(rows, "SignalID")


def level_rows(signals: DataFrame, corridors: DataFrame, *, keep_missing: bool = False, named_only: bool = False) -> DataFrame:
    """Signal, subcorridor and corridor rows with zone groups, ``LONG`` and ``weight``, of stored signal rows.

    Corridors are weighted means of their signals, zone groups of their corridors; both have the change
    from their period before. Without ``keep_missing``, corridors without a value are left out before the
    zone groups are made. Signals stand under their corridor, beside that corridor's own rows; ``named_only``
    leaves out signals of no corridor.
    """
    kept = corridors.where("Corridor IS NOT NULL").select("SignalID", "Zone_Group", "Zone", "Corridor", "Subcorridor")
    key = ["per", "table", "at"]
    cor, sub = [*key, "Zone_Group", "Zone", "Corridor"], [*key, "Zone", "Corridor", "Subcorridor"]
    columns = [*key, "Zone_Group", "Zone", "Corridor", "Subcorridor"]
    sets = signals.join(kept, "SignalID").groupingSets([cor, sub], *columns).agg(
        wmean("value", "weight").alias("value"), sum0("weight").alias("weight"), F.grouping("Zone_Group").alias("_moved"))
    moved = F.col("_moved") == 1
    place = sets.where(~moved | F.col("Subcorridor").isNotNull()).select(
        *key, "value", "weight", F.when(moved, "sub").otherwise("cor").alias("level"), F.when(moved, F.col("Zone")).otherwise(F.col("Zone_Group")).alias("_group"),
        F.when(moved, F.col("Corridor")).otherwise(F.col("Zone")).alias("_zone"), F.when(moved, F.col("Subcorridor")).otherwise(F.col("Corridor")).alias("_place"))
    place = _with_change(place, "level", "_group", "_zone", "_place")
    place = stage(place if keep_missing else place.where("value IS NOT NULL"), "corridor-rows")

    group = place.groupBy("level", *key, "_group").agg(wmean("value", "weight").alias("value"), sum0("weight").alias("weight"))
    group = _with_change(group, "level", "_group")
    named = lambda df, zone, name: df.select("level", "per", "table", F.col(zone).alias("Zone_Group"), F.col(name).alias("Corridor"), "at", "value", "delta", "weight")
    higher = named(place, "_zone", "_place").unionByName(named(group, "_group", "_group")).distinct()

    pairs = corridors.select("SignalID", "Corridor").distinct()
    alone = signals.join(pairs, "SignalID", "left")
    if named_only:
        alone = alone.where("Corridor IS NOT NULL")
    alone = alone.select(F.lit("sig").alias("level"), "per", "table", F.col("Corridor").alias("Zone_Group"), F.col("SignalID").alias("Corridor"), "at", "value", "delta", "weight")
    shown = signals.select("per", "table", "SignalID").distinct().join(pairs, "SignalID").select("per", "table", "Corridor").distinct()
    totals = higher.where("level = 'cor'").join(shown, ["per", "table", "Corridor"], "left_semi").withColumns({"level": F.lit("sig"), "Zone_Group": F.col("Corridor")})
    return reduce(DataFrame.unionByName, [higher, alone, totals.select(alone.columns)])


def quarter_rows(months: DataFrame, weighted: bool) -> DataFrame:
    """Quarters of the monthly rows of each level, with change; ``Quarter`` in place of ``at``. Months count alike, or ``weighted``."""
    weight = F.when(F.lit(weighted) & (F.col("level") != "sig"), F.col("weight")).otherwise(F.lit(1))
    rows = months.where("per = 'mo'").withColumns({"Quarter": quarter_of("at"), "weight": weight})
    key = ["level", "table", "Corridor", "Zone_Group"]
    out = rows.groupBy(*key, "Quarter").agg(wmean("value", "weight").alias("value"))
    w = Window.partitionBy(*key).orderBy("Quarter")
    return out.withColumn("delta", change(F.col("value"), F.lag("value").over(w)))
