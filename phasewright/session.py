"""Session settings the library relies on, and staging of intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

# Wall-clock values live in timestamp_ntz; UTC makes the few casts to timestamp exact.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

_staged: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else started."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where it is unset, one in the session's warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the stored table.

    For frames that several later steps read: it is computed once, the lineage ends
    there, and a lost executor only repeats its own tasks.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _drop_local_tables() -> None:
    """Remove at exit what this process staged on a local disk; other stores have their own clean-up."""
    for path in _staged:
        if path.startswith(("/", "file:")):
            shutil.rmtree(urlparse(path).path, ignore_errors=True)
