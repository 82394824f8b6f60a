"""Day and month jobs: compositions of the operators over any number of days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewright.operators import counts as C
from phasewright.operators import detectors as K
from phasewright.operators import events as E
from phasewright.operators import measures as M
from phasewright.operators import rollups as A
from phasewright.sources import tables as S


def count_tables(events: DataFrame, config: DataFrame, ped_config: DataFrame) -> dict[str, DataFrame]:
    """Every count-based table of the days in the log.

    All frames are plans over the event scan. Store the two count tables first and read
    them back when they are large: the others then start from counts, not events.
    """
    hour = C.counts(events, config)
    quarter = C.counts(events, config, minutes=15)
    ped_hour = C.counts(events, ped_config, code=90)
    ped_quarter = C.counts(events, ped_config, minutes=15, code=90)
    filtered = C.filter_counts(hour, config, C.HOURLY)
    papd = M.volume_per_day(ped_hour, phases=None).withColumnRenamed("vpd", "papd")
    paph = A.volume_per_period(ped_hour, phases=None).withColumnRenamed("vph", "paph")
    return {
        "comm_uptime": M.comm_uptime(events),
        "counts_1hr": S.with_day(hour, "Timeperiod"),
        "filtered_counts_1hr": filtered,
        "bad_detectors": M.bad_detectors(filtered),
        "detector_uptime_pd": A.daily_detector_uptime(filtered),
        "counts_ped_1hr": S.with_day(ped_hour, "Timeperiod"),
        "ped_actuations_pd": papd,
        "ped_actuations_ph": S.with_day(paph, "Hour"),
        "counts_15min": S.with_day(quarter, "Timeperiod"),
        "filtered_counts_15min": C.filter_counts(quarter, config, C.QUARTER_HOURLY),
        "counts_ped_15min": S.with_day(ped_quarter, "Timeperiod"),
    }


def month_tables(
    counts_1hr: DataFrame, filtered_1hr: DataFrame, filtered_15min: DataFrame, config: DataFrame,
    ped_1hr: DataFrame, ped_15min: DataFrame,
) -> dict[str, DataFrame]:
    """Adjusted counts of a month and the measures made from them."""
    adjusted = C.adjust_counts(C.select_count_detectors(filtered_1hr, config))
    adjusted_15 = C.adjust_counts(C.select_count_detectors(filtered_15min, config))
    return {
        "adjusted_counts_1hr": adjusted,
        "signal_details": S.signal_details(counts_1hr, filtered_1hr, adjusted),
        "bad_detectors": M.bad_detectors(filtered_1hr),
        "detector_uptime_pd": A.daily_detector_uptime(filtered_1hr),
        "vehicles_pd": M.volume_per_day(adjusted),
        "vehicles_ph": S.with_day(A.volume_per_period(adjusted), "Hour"),
        "adjusted_counts_15min": adjusted_15,
        "throughput": M.throughput(adjusted_15),
        "vehicles_15min": S.with_day(A.volume_per_period(adjusted_15, minutes=15), "Timeperiod"),
        "ped_actuations_pd": M.volume_per_day(ped_1hr, phases=None).withColumnRenamed("vpd", "papd"),
        "ped_actuations_ph": S.with_day(A.volume_per_period(ped_1hr, phases=None).withColumnRenamed("vph", "paph"), "Hour"),
        "ped_actuations_15min": S.with_day(
            A.volume_per_period(ped_15min, minutes=15, phases=None).withColumnRenamed("vph", "pa15"), "Timeperiod"
        ),
    }


def event_tables(events: DataFrame, config: DataFrame, *, bin_seconds: int = 3600) -> dict[str, DataFrame]:
    """Cycle and detection tables of all signals and days in one plan."""
    cycles, detections = E.etl(events, E.count_detector_flag(config), bin_seconds=bin_seconds)
    return {"cycles": cycles, "detections": detections}


def event_measures(
    events: DataFrame, cycles: DataFrame, detections: DataFrame, config: DataFrame, bad: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Measures from the stored cycle and detection tables over any range of days."""
    presence, spill = K.for_split_failures(config), K.for_spillback(config, bad)
    aog = M.shape_aog(M.arrivals_on_green(detections, config))
    delay = M.approach_delay(detections, cycles, events)
    return {
        "arrivals_on_green": aog,
        "arrivals_on_green_15min": M.shape_aog(M.arrivals_on_green(detections, config, minutes=15)),
        "split_failures": M.split_failures(cycles, detections, presence),
        "sf_15min": M.split_failures(cycles, detections, presence, minutes=15),
        "queue_spillback": M.queue_spillback(detections, spill),
        "qs_15min": M.queue_spillback(detections, spill, minutes=15),
        "ped_delay": M.ped_delay(events),
        "approach_delay_1hr": S.with_day(delay, "Hour"),
        "approach_delay_15min": S.with_day(M.approach_delay(detections, cycles, events, minutes=15), "Hour"),
        "phase_termination": M.terminations(cycles),
        "time_in_transition": M.time_in_transition(events),
    }


def store(tables: dict[str, DataFrame], base: str) -> None:
    """Write each table by day; a rerun of the same days leaves the store unchanged."""
    for name, df in tables.items():
        S.write_days(df, f"{base}/{name}")


def run_counts(spark, events: DataFrame, config: DataFrame, ped_config: DataFrame, base: str) -> None:
    """The daily count job, stage by stage: each stage reads the stored result of the one before."""
    first = count_tables(events, config, ped_config)
    S.write_days(first["counts_1hr"], f"{base}/counts_1hr")
    S.write_days(first["counts_15min"], f"{base}/counts_15min")
    hour = S.read_table(spark, f"{base}/counts_1hr").drop("Date")
    quarter = S.read_table(spark, f"{base}/counts_15min").drop("Date")
    days = events.select("Date").distinct()
    for name, counted, limits in (("1hr", hour, C.HOURLY), ("15min", quarter, C.QUARTER_HOURLY)):
        todays = counted.withColumn("Date", F.to_date("Timeperiod")).join(days, "Date", "left_semi").drop("Date")
        S.write_days(C.filter_counts(todays, config, limits), f"{base}/filtered_counts_{name}")
    filtered = S.read_table(spark, f"{base}/filtered_counts_1hr").join(days, "Date", "left_semi")
    S.write_days(M.bad_detectors(filtered), f"{base}/bad_detectors")
    S.write_days(A.daily_detector_uptime(filtered), f"{base}/detector_uptime_pd")
    for name in ("comm_uptime", "counts_ped_1hr", "counts_ped_15min", "ped_actuations_pd", "ped_actuations_ph"):
        S.write_days(first[name], f"{base}/{name}")


def run_events(spark, events: DataFrame, config: DataFrame, base: str) -> None:
    """The event job: cycles and detections are stored, then measured from the store."""
    store(event_tables(events, config), base)
    stored = [S.read_table(spark, f"{base}/{t}") for t in ("cycles", "detections")]
    store(event_measures(events, *stored, config), base)
