"""Month imputation that redoes only what has changed.

A volume is imputed from the shares and medians of its signal, phase and month, so these three are the unit
of work: a day added to a month changes the other days of the phases it counts, and nothing else.
Each unit's filtered rows have a digest. What is stored carries the digest it was made from; a
run imputes the units whose digest is new, adds their rows, and names the digests in force in a table
of one row for each unit and run. Readers take the rows of those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasewright.functions.calendar import month_of
from phasewright.operators import counts as C
from phasewright.session import stage

UNIT = ["SignalID", "CallPhase", "Month"]
UNITS = "SignalID string, CallPhase int, Month date, version string, run long"
ROWS = "SignalID string, CallPhase int, Detector int, Timeperiod timestamp_ntz, vol int, Date date, version string, Month date"


def unit_versions(filtered: DataFrame) -> DataFrame:
    """Unit and digest of its filtered rows, whatever their order."""
    h = F.xxhash64("Detector", "Timeperiod", "vol")
    return filtered.groupBy("SignalID", "CallPhase", month_of("Timeperiod").alias("Month")).agg(
        F.concat_ws("-", F.count(F.lit(1)).cast("string"), F.hex(F.bit_xor(h)), F.sum(F.pmod(h, F.lit(2**31))).cast("string")).alias("version"))


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # the folder does not exist yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def units_in_force(spark: SparkSession, base: str) -> DataFrame:
    """Unit, digest and run of what is stored; a unit whose rows have all gone has none."""
    last = _stored(spark, f"{base}/units", UNITS).groupBy(*UNIT).agg(F.max_by("version", "run").alias("version"), F.max("run").alias("run"))
    return last.where("version IS NOT NULL")


def read_adjusted(spark: SparkSession, base: str) -> DataFrame:
    """The adjusted counts in force, in the columns of ``counts.adjust_counts``."""
    rows = _stored(spark, f"{base}/rows", ROWS)
    named = units_in_force(spark, base).drop("run")
    return rows.join(named, [*UNIT, "version"], "left_semi").select("SignalID", "CallPhase", "Detector", "Timeperiod", "vol", "Date")


def adjust_changed(spark: SparkSession, filtered: DataFrame, base: str, **options) -> int:
    """Impute the units of ``filtered`` that are new or changed; returns how many.

    ``filtered`` holds whole months (those it names no row of stay as they are). ``options`` are those
    of ``counts.adjust_counts``. Months are partitions, so only theirs are written and read. A unit without a
    phase is never imputed.
    """
    known = filtered.where("CallPhase IS NOT NULL")
    versions = stage(unit_versions(known), "unit-versions")
    before = stage(units_in_force(spark, base), "units-before")
    run = (_stored(spark, f"{base}/units", UNITS).agg(F.max("run")).first()[0] or 0) + 1
    changed = stage(versions.join(before.drop("run"), [*UNIT, "version"], "left_anti"), "changed-units")
    months = versions.select("Month").distinct()
    gone = before.join(months, "Month", "left_semi").join(versions, UNIT, "left_anti").select(*UNIT, F.lit(None).cast("string").alias("version"))
    entries = stage(changed.unionByName(gone).withColumn("run", F.lit(run).cast("long")), "unit-entries")
    n = entries.count()
    if not n:
        return 0
    rows = known.withColumn("Month", month_of("Timeperiod")).join(changed, UNIT, "left_semi").drop("Month")
    made = C.adjust_counts(rows, **options).withColumn("Month", month_of("Timeperiod")).join(changed, UNIT)
    made.hint("rebalance", "Month").write.mode("append").partitionBy("Month").parquet(f"{base}/rows")
    entries.coalesce(1).write.mode("append").parquet(f"{base}/units")
    return n
