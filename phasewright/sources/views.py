"""The library's input shapes read from a star-schema dataset.

Each view maps general tables (events, orders, line items, ...) onto an event log, a
detector list, a corridor hierarchy and measures, so every operator can be run on data
of any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasewright.functions.calendar import NTZ, week
from phasewright.operators.events import count_detector_flag, etl
from phasewright.session import configure, stage

DAY_ZERO = "2024-01-01"
DAY_ZERO_MICROS = 1_704_067_200_000_000


def _steps(*steps: tuple[int, int]):
    """Code by band: each step is (upper band, code); the last one is the rest."""
    b = F.col("b")
    out = F.when(b <= steps[0][0], steps[0][1])
    for upper, code in steps[1:-1]:
        out = out.when(b <= upper, code)
    return out.otherwise(steps[-1][1])


# Which event code a kind of event and a band of its number stand for.
EVENT_CODES = {
    "click": ((5, 82), (9, 81)),
    "view": ((3, 81), (5, 1), (7, 8), (9, 9)),
    "purchase": ((1, 1), (3, 8), (5, 9), (6, 4), (7, 5), (8, 6), (9, 31)),
    "signup": ((3, 90), (5, 45), (7, 21), (9, 22)),
    "error": ((1, 132), (5, 150), (6, 0), (7, 12), (8, 173), (9, 502)),
}


# Codes of the controller's log that the kinds above do not give; each event adds one of them.
MORE_CODES = (10, 83, 84, 87, 131, 133, 134, 135, 136, 137, 138, 139, 140, 141, 182, 183, 184, 300, 301, 302, 303, 304, 305, 306, 307, 316, 317, 318,
              612, 613, 614, 615, 616, 617, 618, 619)


class Views:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # Events ---------------------------------------------------------------------------------

    def _coded(self, signals: int, ts) -> DataFrame:
        k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
        e = self.table("events").select(
            (F.col("user_id") % signals).cast("string").alias("SignalID"), ts.alias("Timestamp"), "event_type", "value",
            k.alias("k"), F.floor(k / 10).cast("int").alias("b"),
        )
        code = F.lit(None).cast("int")
        for kind, steps in EVENT_CODES.items():
            code = F.when(F.col("event_type") == kind, _steps(*steps)).otherwise(code)
        e = e.withColumn("EventCode", code).where("EventCode is not null")
        param = (
            F.when(F.col("EventCode") == 31, 1)
            .when(F.col("EventCode") == 132, F.floor("value").cast("int"))
            .when(F.col("EventCode") == 150, F.col("k") % 5 + 1)
            .when(F.col("EventCode") == 502, F.col("k"))
            .otherwise(F.col("k") % 8 + 1)
        )
        e = e.withColumn("EventParam", param)
        own = F.struct(F.col("EventCode").alias("c"), F.col("EventParam").alias("p"))
        term = F.struct((F.col("k") % 3 + 4).alias("c"), F.col("EventParam").alias("p"))
        ended = F.struct(F.lit(12).alias("c"), ((F.col("EventParam") + 2) % 8 + 1).alias("p"))
        rows = F.when(F.col("EventCode") == 8, F.array(own, term)).when(F.col("EventCode") == 0, F.array(own, ended)).otherwise(F.array(own))
        return e.select("SignalID", "Timestamp", F.explode(rows).alias("_e")).select(
            "SignalID", "Timestamp", F.col("_e.c").alias("EventCode"), F.col("_e.p").alias("EventParam"),
            F.to_date("Timestamp").alias("Date"),
        )

    def event_log(self) -> DataFrame:
        """Events of a month at 25 signals."""
        return self._coded(25, F.col("ts"))

    def event_log_full(self) -> DataFrame:
        """The month at 25 signals with all codes that a wide row knows, a second before midnight in places; distinct rows."""
        k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
        codes = F.array(*[F.lit(c) for c in MORE_CODES])
        midnight = F.date_trunc("day", F.col("ts").cast("timestamp")) + F.expr("interval 86399 seconds")
        late = F.when(k >= F.when(F.col("event_type") == "click", 80).otherwise(50), midnight.cast(NTZ)).otherwise(F.col("ts"))
        more = self.table("events").select(
            (F.col("user_id") % 25).cast("string").alias("SignalID"), F.col("ts").alias("Timestamp"),
            F.get(codes, (F.col("event_id") % len(MORE_CODES)).cast("int")).alias("EventCode"), (k % 8 + 1).alias("EventParam"))
        shifted = self.table("events").where("event_type IN ('click', 'view')").select(
            (F.col("user_id") % 25).cast("string").alias("SignalID"), late.alias("Timestamp"),
            F.when(F.col("event_type") == "click", 82).otherwise(81).alias("EventCode"), (k % 8 + 1).alias("EventParam"))
        return self.event_log().unionByName(more.unionByName(shifted).withColumn("Date", F.to_date("Timestamp"))).distinct()

    def dated_det_config(self) -> DataFrame:
        """The detector list of each day of the month."""
        days = F.sequence(F.lit(DAY_ZERO).cast("date"), F.date_add(F.lit(DAY_ZERO).cast("date"), 30))
        return self.det_config().withColumn("Date", F.explode(days))

    def event_log_day(self) -> DataFrame:
        """The month pressed into one day at 5 signals, so events pair up; distinct rows."""
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        pressed = F.lit(DAY_ZERO_MICROS) + F.floor((us - DAY_ZERO_MICROS) / 30)
        return self._coded(5, F.timestamp_micros(pressed.cast("bigint")).cast(NTZ)).distinct()

    def stored_day(self) -> DataFrame:
        """The one-day log as a stored table, as a pipeline would find it."""
        return stage(self.event_log_day())

    def stored_tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The one-day log with its stored cycle and detection tables."""
        log = self.stored_day()
        cycles, detections = etl(log, count_detector_flag(self.det_config()))
        return log, stage(cycles), detections

    # Configuration --------------------------------------------------------------------------

    def corridors(self) -> DataFrame:
        n = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return n.select(
            F.col("n_nationkey").cast("string").alias("SignalID"),
            F.concat(F.lit("GROUP_"), F.col("n_regionkey") % 2).alias("Zone_Group"),
            F.concat(F.lit("ZONE_"), F.col("n_regionkey") % 2).alias("Zone"),
            F.col("r_name").alias("Corridor"),
            F.concat(F.col("r_name"), F.lit("-"), F.floor(F.col("n_nationkey") / 5).cast("int") % 2).alias("Subcorridor"),
            F.concat(F.col("n_name"), F.lit(" @ "), F.col("r_name")).alias("Name"),
            F.concat(F.col("n_nationkey"), F.lit(": "), F.col("n_name"), F.lit(" @ "), F.col("r_name")).alias("Description"),
            F.lit(DAY_ZERO).cast("date").alias("Asof"),
            F.when(F.col("n_nationkey") % 6 != 5, 33.0 + F.col("n_nationkey") / 100).alias("Latitude"),
            F.when(F.col("n_nationkey") % 6 != 5, -84.0 - F.col("n_nationkey") / 100).alias("Longitude"),
        )

    def _inputs(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("string").alias("SignalID"), F.explode(F.sequence(F.lit(1), F.lit(8))).alias("Detector")
        )

    def det_config(self) -> DataFrame:
        """Eight detectors per signal."""
        d = F.col("Detector")
        kinds = F.when(d % 3 == 0, "Advanced Count").when(d % 3 == 1, "Lane-by-lane Count").otherwise("Stop Bar Presence")
        return self._inputs().withColumn("CallPhase", (F.floor((d - 1) / 2).cast("int") + 1) * 2).select(
            "SignalID", "Detector", "CallPhase", (d % 4).alias("CountPriority"), (d * 0.5).cast("double").alias("TimeFromStopBar"),
            (d * 40).cast("double").alias("DistanceFromStopBar"), kinds.alias("DetectionTypeDesc"),
            F.when(F.col("CallPhase").isin(2, 6), "Mainline").otherwise("Side").alias("ApproachDesc"),
            F.lit("Vehicle").alias("LaneTypeDesc"), (d % 3 + 1).alias("LaneNumber"),
        )

    def ped_config(self) -> DataFrame:
        return self._inputs().withColumn("CallPhase", F.col("Detector"))

    # Measures -------------------------------------------------------------------------------

    def daily_measure(self) -> DataFrame:
        """Value and weight by signal, phase and day over several years, from orders."""
        o = self.table("orders").select(
            (F.col("o_custkey") % 25).cast("string").alias("SignalID"),
            F.when(F.col("o_orderkey") % 2 == 0, 2).otherwise(6).alias("CallPhase"), F.to_date("o_orderdate").alias("Date"),
            F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        )
        d = o.groupBy("SignalID", "CallPhase", "Date").agg((F.sum("cents") / 1e7).alias("value"), F.count("*").alias("weight"))
        return d.withColumn("Week", week("Date")).withColumn("DOW", F.dayofweek("Date"))

    def hourly_measure(self) -> DataFrame:
        """Value and weight by signal, phase and hour over several years, from line items."""
        li = self.table("lineitem").select(
            (F.col("l_suppkey") % 25).cast("string").alias("SignalID"),
            F.when(F.col("l_orderkey") % 2 == 0, 2).otherwise(6).alias("CallPhase"),
            (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber") * 3)).alias("Date_Hour"), "l_quantity",
        )
        h = li.groupBy("SignalID", "CallPhase", "Date_Hour").agg(F.sum("l_quantity").alias("value"), F.count("*").alias("weight"))
        return h.withColumn("Date", F.to_date("Date_Hour")).withColumn("Week", week("Date")).withColumn("DOW", F.dayofweek("Date"))

    def segment_readings(self) -> DataFrame:
        """Segment travel times by hour, from line items and suppliers."""
        li = self.table("lineitem").join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        li = li.join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        li = li.join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        speed = F.lit(45.0) * (1 - 3 * F.col("l_discount"))
        return li.select(
            F.col("l_suppkey").cast("string").alias("tmc_code"),
            F.concat(F.lit("GROUP_"), F.col("n_regionkey") % 2).alias("Zone_Group"),
            F.concat(F.lit("ZONE_"), F.col("n_regionkey") % 2).alias("Zone"), F.col("r_name").alias("Corridor"),
            F.concat(F.col("r_name"), F.lit("-"), F.floor(F.col("n_nationkey") / 5).cast("int") % 2).alias("Subcorridor"),
            (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber") * 3)).alias("Hour"),
            (F.col("l_quantity") / 10).alias("miles"), F.lit(45.0).alias("reference_speed"), speed.alias("speed"),
            (F.col("l_quantity") / 10 / speed * 60).alias("travel_time_minutes"),
            (F.col("l_quantity") / 10 / 45.0 * 60).alias("reference_minutes"),
        )

    def _errors(self) -> DataFrame:
        k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
        return self.table("events").where("event_type = 'error'").select(
            (F.col("user_id") % 25).cast("string").alias("SignalID"), F.to_date("ts").alias("Date"), "ts", "value", k.alias("k"), "event_id"
        )

    def comm_quality(self) -> DataFrame:
        return self._errors().select(
            F.col("SignalID").alias("AssetNum"), F.least(F.lit(100.0), F.col("value")).alias("AvgQuality"),
            F.date_sub("Date", F.when(F.col("k") % 10 == 0, 1).otherwise(0)).alias("CSDATE"), "Date",
        )

    def watchdog_messages(self) -> DataFrame:
        kinds = F.array(*[F.lit(m) for m in ("Force Offs", "Count", "Max Outs", "Pedestrian Activations", "Missing Records")])
        return self._errors().select(
            F.col("ts").alias("TimeStamp"), "SignalID", F.concat("SignalID", (F.col("k") % 8 + 1).cast("string")).alias("DetectorID"),
            (F.col("k") % 8 + 1).alias("Phase"), F.lit(1).alias("ErrorCode"),
            F.concat(F.get(kinds, F.col("k") % 5), F.lit(" threshold exceeded")).alias("Message"),
        )

    def alerts(self) -> DataFrame:
        """Alert rows by signal, detector and day."""
        kinds = F.array(*[F.lit(m) for m in ("Bad Vehicle Detection", "Bad Ped Detection", "Bad Comm", "Count", "Missing Records")])
        e = self._errors().select(
            "SignalID", (F.col("k") % 8 + 1).alias("CallPhase"), (F.col("k") % 8 + 1).alias("Detector"), "Date",
            F.get(kinds, F.col("k") % 5).alias("Alert"), F.lit("Mainline").alias("ApproachDesc"),
        )
        return e.join(self.corridors().select("Zone_Group", "Zone", "Corridor", "SignalID", "Name"), "SignalID")
