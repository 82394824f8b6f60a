import sys
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from phasewright.session import configure

    yield configure(session)
    session.stop()


DAY = date(2024, 1, 2)


def at(clock: str, day: date = DAY) -> datetime:
    """Time of day such as 8:00:05 or 8:00:05.5 on the test day."""
    h, m, s = (clock.split(":") + ["0"])[:3]
    return datetime(day.year, day.month, day.day, int(h), int(m), int(float(s)), round(float(s) % 1 * 1e6))


@pytest.fixture(scope="session")
def log(spark):
    """Event log from rows (signal, clock, code, param[, day])."""
    def make(*rows):
        full = [(r[0], at(r[1], r[4] if len(r) > 4 else DAY), r[2], r[3], r[4] if len(r) > 4 else DAY) for r in rows]
        return spark.createDataFrame(full, "SignalID string, Timestamp timestamp_ntz, EventCode int, EventParam int, Date date")

    return make


def rows(df, *cols):
    """Sorted tuples of the chosen columns."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is None, str(type(x)) if x is None else x) for x in t))
