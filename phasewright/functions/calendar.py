"""Calendar expressions (X01-X04, X07, X09-X11, X13), free of the session time zone unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first Sunday of the week count, peak hours, days of the week (Sunday is 1).
WEEK_ZERO = "2016-12-25"
AM_PEAK_HOURS = (6, 7, 8, 9)
PM_PEAK_HOURS = (15, 16, 17, 18, 19)
TUE, WED, THU = 3, 4, 5

NTZ = "timestamp_ntz"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts) -> Column:
    """Epoch microseconds of a wall-clock value (the session zone must be UTC)."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def seconds_between(start, end) -> Column:
    return (micros(end) - micros(start)) / F.lit(1e6)


def plus_seconds(ts, seconds) -> Column:
    return _col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _col(seconds).cast("decimal(18,6)"))


def midnight(d) -> Column:
    return _col(d).cast("date").cast(NTZ)


def floor_minutes(ts, minutes: int) -> Column:
    """Floor to a period of up to one day that divides the day."""
    ts = _col(ts)
    if minutes == 1440:
        return midnight(ts)
    of_day = F.hour(ts) * 60 + F.minute(ts)
    return midnight(ts) + F.make_dt_interval(F.lit(0), F.lit(0), of_day - of_day % minutes, F.lit(0))


def floor_hour(ts) -> Column:
    return midnight(ts) + F.make_dt_interval(F.lit(0), F.hour(_col(ts)))


def week(d) -> Column:
    """Whole weeks since the zero Sunday, truncated towards it."""
    days = F.datediff(_col(d), F.lit(WEEK_ZERO).cast("date"))
    return F.when(days < 0, -F.floor(-days / 7)).otherwise(F.floor(days / 7)).cast("int")


def tuesday_of_week(week_number, first_date) -> Column:
    """Tuesday of a week, not before the first date of the data.

    A week number of zero spans two calendar weeks because of the truncation; the
    later one is taken.
    """
    week_number = _col(week_number)
    start = F.date_add(F.lit(WEEK_ZERO).cast("date"), (week_number * 7 + F.when(week_number < 0, -5).otherwise(2)).cast("int"))
    return F.greatest(start, _col(first_date).cast("date"))


def round_to_tuesday(d) -> Column:
    d = _col(d).cast("date")
    return F.date_add(d, F.lit(TUE) - F.dayofweek(d))


def most_recent_monday(d) -> Column:
    return F.trunc(_col(d), "week")


def month_of(d) -> Column:
    return F.trunc(_col(d), "month")


def quarter_of(d) -> Column:
    d = _col(d)
    return F.concat(F.year(d).cast("string"), F.lit("."), F.quarter(d).cast("string"))


def month_labels(start, end) -> Column:
    """Array of yyyy-MM labels from the month of start to the month of end."""
    months = F.sequence(month_of(start), month_of(end), F.expr("interval 1 month"))
    return F.transform(months, lambda m: F.date_format(m, "yyyy-MM"))


def _time_of_day(ts) -> Column:
    ts = _col(ts)
    return ts - midnight(ts)


def onto_month_start(ts) -> Column:
    """The same time of day on the first of the month."""
    return month_of(ts).cast(NTZ) + _time_of_day(ts)


def onto_year_start(ts) -> Column:
    return F.trunc(_col(ts), "year").cast(NTZ) + _time_of_day(ts)


def onto_date(ts, d) -> Column:
    return midnight(d) + _time_of_day(ts)


def is_peak(ts) -> Column:
    return F.hour(_col(ts)).isin(*AM_PEAK_HOURS, *PM_PEAK_HOURS)


def is_midweek(d) -> Column:
    return F.dayofweek(_col(d)).isin(TUE, WED, THU)


def local_to_utc(ts, zone: str) -> Column:
    return F.to_utc_timestamp(_col(ts).cast("timestamp"), zone).cast(NTZ)


def utc_to_local(ts, zone: str) -> Column:
    return F.from_utc_timestamp(_col(ts).cast("timestamp"), zone).cast(NTZ)
