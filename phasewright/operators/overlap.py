"""Joining intervals that overlap in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewright.functions.calendar import micros


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    *,
    bin_seconds: int = 60,
) -> DataFrame:
    """Inner join of rows whose closed spans touch or overlap.

    Both sides are laid out over time bins and joined on (keys, bin), so a busy key is
    spread over its bins; a pair is kept only in the first bin the two share.
    """
    width = bin_seconds * 1_000_000

    def laid_out(df, span, lo):
        bins = F.sequence(F.floor(micros(span[0]) / width), F.floor(micros(span[1]) / width))
        return (
            df.where(F.col(span[0]) <= F.col(span[1]))
            .withColumn(lo, F.floor(micros(span[0]) / width))
            .withColumn("_bin", F.explode(bins))
        )

    a = laid_out(left, left_span, "_lo_a")
    b = laid_out(right, right_span, "_lo_b")
    return (
        a.join(b, [*keys, "_bin"])
        .where(
            (F.col("_bin") == F.greatest("_lo_a", "_lo_b"))
            & (F.col(left_span[0]) <= F.col(right_span[1]))
            & (F.col(right_span[0]) <= F.col(left_span[1]))
        )
        .drop("_bin", "_lo_a", "_lo_b")
    )


def overlap_seconds(a: tuple[str, str], b: tuple[str, str]):
    start = F.greatest(micros(a[0]), micros(b[0]))
    end = F.least(micros(a[1]), micros(b[1]))
    return (end - start) / F.lit(1e6)
