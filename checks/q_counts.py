"""Counting, filtering, imputing and detector configuration."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views_sql import dow
from phasewright.operators import counts as C
from phasewright.operators import detectors as K
from phasewright.plans import daily as P

# Limits scaled to the sparse event table.
LOW_HOURLY = C.CountLimits(60, 1, 2, 1, 2, 12, 5)
LOW_QUARTER = C.CountLimits(15, 1, 2, 1, 2, 50, 20)
COUNT_COLS = "SignalID, Timeperiod, Detector:int, CallPhase:int, vol:int"


@query("c01_counts_hour", COUNT_COLS, "SELECT * FROM counts_1h")
def _(v):
    return C.counts(v.event_log(), v.det_config())


@query("c01_counts_15min", COUNT_COLS, "SELECT * FROM counts_15")
def _(v):
    return C.counts(v.event_log(), v.det_config(), minutes=15)


@query("c01_counts_ped", COUNT_COLS, "SELECT * FROM counts_ped_1h")
def _(v):
    return C.counts(v.event_log(), v.ped_config(), code=90)


@query("c01_counts_midweek", COUNT_COLS, f"SELECT * FROM counts_1h WHERE {dow('Timeperiod')} IN (3, 4, 5)")
def _(v):
    return C.counts(v.event_log(), v.det_config(), midweek_only=True)


FILTER_COLS = (
    "SignalID, Date, Timeperiod, Detector:int, CallPhase:int, ~vol, ~delta_vol, mean_abs_delta:int, ~flatlined, flat_strk:int, "
    "flat_flag:int, maxvol_flag:int, mad_flag:int, Good_Day:int, Month_Hour, Hour"
)


def _filtered(v):
    return C.filter_counts(C.counts(v.event_log(), v.det_config()), v.det_config(), LOW_HOURLY)


@query("c03_filter_counts_hour", FILTER_COLS, "SELECT * FROM filtered_1h")
def _(v):
    return _filtered(v)


@query(
    "c03_filter_counts_15min", "SignalID, Date, Detector:int, Good_Day:int, flat_strk:int, mean_abs_delta:int, periods:bigint, ~total",
    """SELECT SignalID, Date, Detector, Good_Day, flat_strk, mean_abs_delta, count(*) AS periods, sum(vol) AS total
    FROM filtered_15 GROUP BY ALL""",
)
def _(v):
    quarter = C.filter_counts(C.counts(v.event_log(), v.det_config(), minutes=15), v.det_config(), LOW_QUARTER)
    day = ["SignalID", "Date", "Detector", "Good_Day", "flat_strk", "mean_abs_delta"]
    return quarter.groupBy(*day).agg(F.count("*").alias("periods"), F.sum("vol").alias("total"))


@query("c04_adjust_counts", "SignalID, CallPhase:int, Detector:int, Timeperiod, vol:int, Date", "SELECT * FROM adjusted_1h")
def _(v):
    return C.adjust_counts(_filtered(v))


_BEST = "SELECT * FROM (SELECT *, min(CountPriority) OVER (PARTITION BY SignalID, CallPhase) AS least FROM det_config) WHERE CountPriority = least"


@query(
    "c05_select_count_detectors", "SignalID, Timeperiod, Detector:int, CallPhase:int, ~vol, Good_Day:int",
    f"SELECT f.* FROM filtered_1h f SEMI JOIN ({_BEST}) k ON f.SignalID = k.SignalID AND f.Detector = k.Detector AND f.CallPhase = k.CallPhase",
)
def _(v):
    return C.select_count_detectors(_filtered(v), v.det_config())


@query(
    "c06_adjust_then_throughput", "SignalID, Date, ~vph",
    """SELECT SignalID, Date, quantile_cont(s, 0.95) * 4 AS vph FROM (SELECT SignalID, Date, Timeperiod, sum(vol) AS s FROM adjusted_1h
       GROUP BY ALL) GROUP BY ALL""",
)
def _(v):
    from phasewright.operators.measures import throughput

    return C.adjust_counts(_filtered(v), then=throughput)


# Day and month jobs ---------------------------------------------------------------------------


@query(
    "c02_count_tables", "name, SignalID, rows:bigint, ~total",
    f"""SELECT 'counts_1hr' AS name, SignalID, count(*) AS rows, sum(vol) AS total FROM counts_1h GROUP BY ALL
    UNION ALL SELECT 'counts_15min', SignalID, count(*), sum(vol) FROM counts_15 GROUP BY ALL
    UNION ALL SELECT 'counts_ped_1hr', SignalID, count(*), sum(vol) FROM counts_ped_1h GROUP BY ALL
    UNION ALL SELECT 'ped_actuations_pd', SignalID, count(*), sum(papd) FROM (SELECT SignalID, CallPhase, cast(Timeperiod as date) AS d,
      sum(vol) AS papd FROM counts_ped_1h GROUP BY ALL) GROUP BY ALL
    UNION ALL SELECT 'ped_actuations_ph', SignalID, count(*), sum(paph) FROM (SELECT SignalID, Timeperiod, sum(vol) AS paph
      FROM counts_ped_1h GROUP BY ALL) GROUP BY ALL""",
)
def _(v):
    tables = P.count_tables(v.event_log(), v.det_config(), v.ped_config())
    value = {"counts_1hr": "vol", "counts_15min": "vol", "counts_ped_1hr": "vol", "ped_actuations_pd": "papd", "ped_actuations_ph": "paph"}
    parts = [
        tables[t].groupBy("SignalID").agg(F.count("*").alias("rows"), F.sum(c).alias("total")).withColumn("name", F.lit(t))
        for t, c in value.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "c07_month_tables", "name, SignalID, Date, ~total",
    """SELECT 'vehicles_pd' AS name, SignalID, Date, sum(vol) AS total FROM adjusted_sel WHERE CallPhase IN (2, 6) GROUP BY ALL
    UNION ALL SELECT 'vehicles_ph', SignalID, Date, sum(vol) FROM adjusted_sel WHERE CallPhase IN (2, 6) GROUP BY ALL""",
)
def _(v):
    counted = C.counts(v.event_log(), v.det_config())
    filtered = C.filter_counts(counted, v.det_config(), LOW_HOURLY)
    ped = C.counts(v.event_log(), v.ped_config(), code=90)
    tables = P.month_tables(counted, filtered, filtered, v.det_config(), ped, ped)
    pd = tables["vehicles_pd"].groupBy("SignalID", "Date").agg(F.sum("vpd").alias("total")).withColumn("name", F.lit("vehicles_pd"))
    ph = tables["vehicles_ph"].groupBy("SignalID", "Date").agg(F.sum("vph").alias("total")).withColumn("name", F.lit("vehicles_ph"))
    return pd.unionByName(ph)


# Configuration: an inventory the size of the part table -----------------------------------------

INVENTORY = {
    "movement_types": [(0, "L"), (1, "T"), (2, "TR"), (3, "R"), (4, "TL"), (5, "X")],
    "lane_types": [(0, "Vehicle"), (1, "Exit"), (2, "Bike")],
    "detection_types": [(0, "Advanced Count"), (1, "Lane-by-lane Count"), (2, "Stop Bar Presence"), (3, "Advanced Speed")],
    "direction_types": [(0, "Northbound"), (1, "Southbound"), (2, "Eastbound"), (3, "Westbound")],
    "hardwares": [(0, "Loop"), (1, "Radar")],
}


def inventory(v):
    """Inventory tables made from parts (detectors, approaches) and suppliers (signals)."""
    spark, p = v.spark, v.table("part")
    look = {
        "movement_types": "MovementTypeID int, MovementTypeAbbr string", "lane_types": "LaneTypeID int, LaneTypeDesc string",
        "detection_types": "DetectionTypeID int, Description string", "direction_types": "DirectionTypeID int, DirectionTypeDesc string",
        "hardwares": "DetectionHardwareID int, HardwareDesc string",
    }
    tables = {name: spark.createDataFrame(INVENTORY[name], schema) for name, schema in look.items()}
    k = F.col("p_partkey")
    signals = v.table("supplier")
    versions = F.explode(F.sequence(F.lit(1), F.lit(2))).alias("ver")
    tables["detectors"] = p.select("*", versions).select(
        (k * 2 + F.col("ver")).alias("ID"), F.concat(F.lit("D"), k).alias("DetectorID"), (k % 16 + 1).cast("int").alias("DetChannel"),
        k.alias("ApproachID"), (k % 6).cast("int").alias("MovementTypeID"), (k % 3).cast("int").alias("LaneTypeID"),
        (k % 2).cast("int").alias("DetectionHardwareID"), (F.col("p_size") * 10).cast("double").alias("DistanceFromStopBar"),
        (F.lit(30.0) + k % 3 * 5).alias("MPH"),
        (F.lit("2023-01-01").cast("timestamp_ntz") + F.make_dt_interval(((k * 7 + F.col("ver") * 200) % 500).cast("int"))).alias("DateAdded"),
        F.when(k % 10 == 0, F.lit("2023-12-01").cast("timestamp_ntz")).alias("DateDisabled"),
    )
    tables["detection_type_detector"] = tables["detectors"].select(
        "ID", F.explode(F.array_distinct(F.array((F.col("ID") % 4).cast("int"), (F.col("ID") % 3).cast("int")))).alias("DetectionTypeID")
    )
    tables["approaches"] = p.select(
        k.alias("ApproachID"), (k % 40).cast("string").alias("SignalID"), F.concat(F.lit("Approach "), k).alias("ApproachDesc"),
        (k % 4).cast("int").alias("DirectionTypeID"), (k % 8 + 1).cast("int").alias("ProtectedPhaseNumber"),
        F.when(k % 3 == 0, (k % 8).cast("int")).alias("PermissivePhaseNumber"),
    )
    tables["signals"] = signals.select((F.col("s_suppkey") % 40).cast("string").alias("SignalID"), F.col("s_suppkey").alias("VersionID"),
                                       F.lit("2022-01-01").cast("timestamp_ntz").alias("Start"))
    return tables


_LOOK = {
    name: ", ".join(f"({a}, '{b}')" for a, b in rows) for name, rows in INVENTORY.items()
}
INVENTORY_SQL = f"""SELECT s.SignalID, d.DetectorID, d.DetChannel AS Detector,
  CASE WHEN m.a IN ('L', 'T', 'R', 'TL') THEN prot WHEN m.a = 'TR' AND perm > 0 THEN perm WHEN m.a = 'TR' THEN prot ELSE 0 END AS CallPhase,
  dist / mph * 3600 / 5280 AS TimeFromStopBar, dist AS DistanceFromStopBar, 'Approach ' || a.ap AS ApproachDesc, l.a AS LaneTypeDesc, t.kinds AS DetectionTypeDesc,
  d.DateAdded, CASE WHEN l.a = 'Exit' THEN 0 WHEN l.a = 'Vehicle' AND t.kinds LIKE '%Advanced Count%' THEN 1
  WHEN l.a = 'Vehicle' AND t.kinds LIKE '%Lane-by-lane Count%' THEN 2 ELSE 3 END AS CountPriority
  FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY DetectorID ORDER BY DateAdded DESC, ID DESC) AS rn FROM (
    SELECT p_partkey * 2 + ver AS ID, 'D' || p_partkey AS DetectorID, cast(p_partkey % 16 + 1 as int) AS DetChannel, p_partkey AS ap,
    cast(p_partkey % 6 as int) AS mt, cast(p_partkey % 3 as int) AS lt, p_size * 10.0::double AS dist, 30.0::double + p_partkey % 3 * 5 AS mph,
    timestamp '2023-01-01' + to_days(cast((p_partkey * 7 + ver * 200) % 500 as int)) AS DateAdded,
    CASE WHEN p_partkey % 10 = 0 THEN timestamp '2023-12-01' END AS DateDisabled FROM part, (VALUES (1), (2)) x(ver))
    WHERE DateAdded <= timestamp '2024-01-15' AND (DateDisabled IS NULL OR DateDisabled > timestamp '2024-01-15')) WHERE rn = 1) d
  JOIN (VALUES {_LOOK['movement_types']}) m(i, a) ON d.mt = m.i
  JOIN (VALUES {_LOOK['lane_types']}) l(i, a) ON d.lt = l.i
  JOIN (SELECT ID, string_agg(a, ', ' ORDER BY a) AS kinds FROM (SELECT DISTINCT ID, unnest([ID % 4, ID % 3]) AS dt FROM (
    SELECT p_partkey * 2 + ver AS ID FROM part, (VALUES (1), (2)) x(ver))) JOIN (VALUES {_LOOK['detection_types']}) q(i, a) ON dt = q.i GROUP BY ID) t
    ON t.ID = d.ID
  JOIN (SELECT p_partkey AS ap, cast(p_partkey % 40 as varchar) AS SignalID, cast(p_partkey % 8 + 1 as int) AS prot,
    CASE WHEN p_partkey % 3 = 0 THEN cast(p_partkey % 8 as int) END AS perm FROM part) a ON a.ap = d.ap
  JOIN (SELECT DISTINCT cast(s_suppkey % 40 as varchar) AS SignalID FROM supplier) s ON s.SignalID = a.SignalID"""
AS_OF = "2024-01-15"
INV_COLS = "SignalID, DetectorID, Detector:int, CallPhase:int, ~TimeFromStopBar, DetectionTypeDesc, LaneTypeDesc, ApproachDesc, CountPriority:int"


@query("k01_detector_inventory", INV_COLS, INVENTORY_SQL)
def _(v):
    return K.detector_inventory(inventory(v), AS_OF)


@query(
    "k02_ped_inputs", "SignalID, Detector:int, CallPhase:int",
    "SELECT DISTINCT SignalID, EventParam AS Detector, EventParam AS CallPhase FROM event_log WHERE EventCode = 90 AND Timestamp > timestamp '2023-10-17'",
)
def _(v):
    return K.ped_inputs(v.event_log(), AS_OF)


_INCLUDED = """SELECT DISTINCT SignalID, EventParam AS Detector FROM event_log WHERE EventCode = 82
  AND date_diff('day', date '2023-01-30', cast(Timestamp as date)) BETWEEN 0 AND 365
  AND date_diff('day', date '2023-01-30', cast(Timestamp as date)) % 3 = 0
  AND Timestamp - date_trunc('day', Timestamp) BETWEEN interval 8 hour AND interval 9 hour"""


@query("k03_included_detectors", "SignalID, Detector:int", _INCLUDED)
def _(v):
    return K.included_detectors(v.event_log(), "2024-01-30")


@query(
    "k04_good_config", "SignalID, DetectorID, Detector:int, CallPhase:int, ~TimeFromStopBar, CountPriority:int, Included:int",
    f"""SELECT i.SignalID, DetectorID, i.Detector, CallPhase, round(coalesce(TimeFromStopBar, 0) + 1e-9, 1) AS TimeFromStopBar,
    coalesce(CountPriority, max(CountPriority) OVER () + 1) AS CountPriority, CASE WHEN n.SignalID IS NOT NULL THEN 1 END AS Included
    FROM ({INVENTORY_SQL}) i LEFT JOIN ({_INCLUDED}) n ON i.SignalID = n.SignalID AND i.Detector = n.Detector
    WHERE i.Detector IS NOT NULL AND CallPhase IS NOT NULL""",
)
def _(v):
    return K.good_config(K.detector_inventory(inventory(v), AS_OF), K.included_detectors(v.event_log(), "2024-01-30"))


@query(
    "k05_nightly_config", "name, SignalID, n:bigint",
    f"""SELECT 'det_config' AS name, SignalID, count(*) AS n FROM ({INVENTORY_SQL}) GROUP BY ALL UNION ALL
    SELECT 'det_config_good', SignalID, count(*) FROM ({INVENTORY_SQL}) WHERE Detector IS NOT NULL AND CallPhase IS NOT NULL GROUP BY ALL UNION ALL
    SELECT 'ped_config', SignalID, count(DISTINCT EventParam) FROM event_log WHERE EventCode = 90 AND Timestamp > timestamp '2023-10-17' GROUP BY ALL""",
)
def _(v):
    parts = [
        df.groupBy("SignalID").agg(F.count("*").alias("n")).withColumn("name", F.lit(name))
        for name, df in K.nightly_config(inventory(v), v.event_log(), AS_OF).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SEL_COLS = "SignalID, Detector:int, CallPhase:int, ~TimeFromStopBar"


@query(
    "k06_for_arrivals", SEL_COLS,
    f"""SELECT * FROM (SELECT *, min(p) OVER (PARTITION BY SignalID, CallPhase) AS best FROM (SELECT *, CASE WHEN DetectionTypeDesc LIKE '%Exit%' THEN 0
    WHEN DetectionTypeDesc LIKE '%Advanced Count%' THEN 1 ELSE 2 END AS p FROM ({INVENTORY_SQL})) WHERE p < 2) WHERE p = best""",
)
def _(v):
    return K.for_arrivals(K.detector_inventory(inventory(v), AS_OF))


@query(
    "k07_for_spillback", SEL_COLS,
    f"""SELECT i.* FROM ({INVENTORY_SQL}) i ANTI JOIN (SELECT DISTINCT SignalID, Detector FROM filtered_1h WHERE Good_Day = 0) b
    ON i.SignalID = b.SignalID AND i.Detector = b.Detector
    WHERE (DetectionTypeDesc LIKE '%Advanced Count%' OR DetectionTypeDesc LIKE '%Advanced Speed%') AND DistanceFromStopBar IS NOT NULL""",
)
def _(v):
    bad = _filtered(v).where("Good_Day = 0").select("SignalID", "Detector", "Good_Day").distinct()
    return K.for_spillback(K.detector_inventory(inventory(v), AS_OF), bad)


@query("k08_for_split_failures", SEL_COLS, f"SELECT * FROM ({INVENTORY_SQL}) WHERE DetectionTypeDesc LIKE '%Stop Bar Presence%' AND Detector IS NOT NULL")
def _(v):
    return K.for_split_failures(K.detector_inventory(inventory(v), AS_OF))


@query(
    "k09_for_volumes", SEL_COLS + ", CountPriority:int",
    f"SELECT * FROM (SELECT *, min(CountPriority) OVER (PARTITION BY SignalID, CallPhase) AS least FROM ({INVENTORY_SQL})) WHERE CountPriority = least",
)
def _(v):
    return K.for_volumes(K.detector_inventory(inventory(v), AS_OF))


@query(
    "k10_for_approach_delay", "SignalID, Detector:int, CallPhase:int, CountDetector, DateAdded",
    f"""SELECT * FROM (SELECT *, CountPriority = min(CountPriority) OVER (PARTITION BY SignalID, CallPhase) AS CountDetector FROM (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY SignalID, Detector ORDER BY DateAdded DESC, DetectorID DESC) AS rn
      FROM ({INVENTORY_SQL})) WHERE rn = 1)) WHERE DetectionTypeDesc LIKE '%Advanced Count%'""",
)
def _(v):
    # Detector ids break ties of the date.
    inv = K.detector_inventory(inventory(v), AS_OF)
    newest = K.latest_per(inv, ["SignalID", "Detector"], ["DateAdded", "DetectorID"])
    return K.for_approach_delay(newest)


@query(
    "k11_subcorridor_view", "Zone_Group, Zone, Corridor, ~value",
    "SELECT Zone_Group, Zone, Corridor, sum(value) AS value FROM daily_measure JOIN subcorridors USING (SignalID) GROUP BY ALL",
)
def _(v):
    return v.daily_measure().join(K.subcorridor_view(v.corridors()), "SignalID").groupBy("Zone_Group", "Zone", "Corridor").agg(
        F.sum("value").alias("value")
    )


@query(
    "k13_unmatched_corridors", "Corridor, Subcorridor, only_in",
    """SELECT coalesce(a.Corridor, b.Corridor) AS Corridor, coalesce(a.Subcorridor, b.Subcorridor) AS Subcorridor,
    CASE WHEN a.Corridor IS NULL THEN 'segments' ELSE 'signals' END AS only_in FROM
    (SELECT DISTINCT p_brand AS Corridor, p_type AS Subcorridor FROM part WHERE p_size > 5) a FULL JOIN
    (SELECT DISTINCT p_brand AS Corridor, p_type AS Subcorridor FROM part WHERE p_size <= 25) b USING (Corridor, Subcorridor)
    WHERE a.Corridor IS NULL OR b.Corridor IS NULL""",
)
def _(v):
    p = v.table("part").select(F.col("p_brand").alias("Corridor"), F.col("p_type").alias("Subcorridor"), "p_size")
    return K.unmatched_corridors(p.where("p_size > 5"), p.where("p_size <= 25"))


@query(
    "s08_clean_corridors", "SignalID, Zone_Group, Zone, Corridor, Name, Description, Asof",
    """SELECT SignalID, Zone_Group, Zone, Corridor, main || ' @ ' || side AS Name, SignalID || ': ' || main || ' @ ' || side AS Description, "Asof"
    FROM (SELECT *, max(m) OVER (PARTITION BY SignalID, Zone, Corridor) AS newest FROM (
      SELECT cast(c_custkey % 300 as varchar) AS SignalID, 'G' || (c_nationkey % 2) AS Zone_Group, 'Z' || (c_custkey % 3) AS Zone,
      CASE WHEN c_nationkey % 7 <> 0 THEN c_mktsegment END AS Corridor, c_name AS main, 'N' || c_nationkey AS side, date '2024-01-01' AS "Asof",
      coalesce(CASE WHEN c_custkey % 5 <> 0 THEN date '2020-01-01' + cast(floor(c_acctbal / 10) as int) END, date '1900-01-01') AS m,
      c_custkey % 4 <> 0 AS inc FROM customer)) WHERE m = newest AND Corridor IS NOT NULL AND inc""",
)
def _(v):
    k = F.col("c_custkey")
    raw = v.table("customer").select(
        (k % 300).cast("string").alias("SignalID"), F.concat(F.lit("G"), F.col("c_nationkey") % 2).alias("Zone_Group"),
        F.concat(F.lit("Z"), k % 3).alias("Zone"), F.when(F.col("c_nationkey") % 7 != 0, F.col("c_mktsegment")).alias("Corridor"),
        F.lit(None).cast("string").alias("Subcorridor"), F.lit(None).cast("double").alias("Milepost"), F.lit("A").alias("Agency"),
        F.col("c_name").alias("Main_Street_Name"), F.concat(F.lit("N"), F.col("c_nationkey")).alias("Side_Street_Name"),
        F.lit("2024-01-01").cast("date").alias("Asof"),
        F.when(k % 5 != 0, F.date_add(F.lit("2020-01-01").cast("date"), F.floor(F.col("c_acctbal") / 10).cast("int"))).alias("Modified"),
        (k % 4 != 0).alias("Include"), F.lit(None).cast("double").alias("Latitude"), F.lit(None).cast("double").alias("Longitude"),
    )
    return K.clean_corridors(raw)


@query(
    "s16_without_bad", "SignalID, DetectorID, Detector:int",
    f"""SELECT i.* FROM ({INVENTORY_SQL}) i ANTI JOIN (SELECT DISTINCT SignalID, Detector FROM filtered_1h WHERE Good_Day = 0) b
    ON i.SignalID = b.SignalID AND i.Detector = b.Detector""",
)
def _(v):
    return K.without_bad(K.detector_inventory(inventory(v), AS_OF), _filtered(v).select("SignalID", "Detector", "Good_Day").distinct())


@query("s18_pad_signal_ids", "SignalID, DetectorID", f"SELECT lpad(SignalID, 5, '0') AS SignalID, DetectorID FROM ({INVENTORY_SQL})")
def _(v):
    return K.pad_signal_ids(K.detector_inventory(inventory(v), AS_OF))


