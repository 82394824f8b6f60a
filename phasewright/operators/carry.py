"""Carrying the latest (or next) marker onto rows: the as-of join of the library.

A plain running window per key puts all rows of a key into one task. Here the day
is cut into bins, the running window works inside (key, bin), and the marker in
force at the start of each bin is carried in by an equi-join on (key, bin). The
carry-in table holds at most one row per key and bin, whatever the number of
events, and the join reuses the partitioning of the window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasewright.functions.calendar import micros, midnight

DAY_SECONDS = 86_400
# Rank of rows that come after every marker of their instant.
LAST = 2**31 - 1


@dataclass(frozen=True)
class Mark:
    """A value carried from the rows where ``when`` holds.

    ``strict`` takes only markers at an earlier (forward: later) instant than the row.
    """

    name: str
    when: Column
    value: Column
    strict: bool = False


def carry(
    df: DataFrame,
    keys: list[str],
    ts: str,
    marks: list[Mark],
    *,
    day: str = "Date",
    rank: Column | None = None,
    forward: bool = False,
    bin_seconds: int = 3600,
    days_before: int = 0,
    source: DataFrame | None = None,
    count_same: list[str] | None = None,
) -> DataFrame:
    """Add one column per mark: its value at the latest marker at or before the row.

    ``keys`` must contain ``day``: nothing is carried from one processing day to the
    next. ``rank`` orders rows at equal times (markers first by default, so an exact
    match counts). With ``forward`` the next marker is taken instead. Rows outside the
    day fall into its first or last bin; ``days_before`` adds bins ahead of it. Rows
    with a null key keep null marks from other bins. ``source`` is a frame holding the
    same markers when ``df`` is costly: the carry-in is then computed from it alone, so
    chained carries do not recompute each other. ``count_same`` adds ``_same``, the number
    of rows of the key at the row's instant with equal values in the columns.
    """
    if day not in keys:
        raise ValueError("keys must contain the processing day")
    per_day = DAY_SECONDS // bin_seconds
    first, last = -days_before * per_day, per_day - 1
    flip = -1 if forward else 1

    holds = [F.coalesce(m.when, F.lit(False)) for m in marks]
    is_mark = holds[0]
    for h in holds[1:]:
        is_mark = is_mark | h
    offset = F.floor((micros(ts) - micros(midnight(day))) / (bin_seconds * 1_000_000)).cast("int")

    def placed(frame: DataFrame) -> DataFrame:
        return frame.select(
            "*",
            (flip * F.greatest(F.lit(first), F.least(F.lit(last), offset))).alias("_bin"),
            (flip * micros(ts)).alias("_pos"),
            (rank if rank is not None else F.when(is_mark, 0).otherwise(1)).alias("_tie"),
        )

    rows = placed(df)
    part = Window.partitionBy(*keys, "_bin")
    at_or_before = part.orderBy("_pos", "_tie").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = part.orderBy("_pos").rangeBetween(Window.unboundedPreceding, -1)

    def inside(m: Mark, h: Column) -> Column:
        if m.strict:
            latest = F.max(F.when(h, F.struct(F.col("_pos"), F.col("_tie"), m.value.alias("v")))).over(before)
            return latest.getField("v").alias(m.name)
        return F.last(F.when(h, m.value), ignorenulls=True).over(at_or_before).alias(m.name)

    # All windows here partition by (keys, bin) or finer, so one shuffle serves them.
    local = rows.select("*", *[inside(m, h) for m, h in zip(marks, holds)])
    kept = [c for c in df.columns if c not in {m.name for m in marks}]
    if count_same is not None:
        same = Window.partitionBy(*dict.fromkeys([*keys, "_bin", "_pos", *count_same]))
        local = local.withColumn("_same", F.count("*").over(same))
        kept.append("_same")

    # One row per key and bin that has a marker: the value in force when the bin ends.
    # Without a rank the order is one number, so plain values aggregate by hash.
    order = F.col("_pos") if rank is None else F.struct("_pos", "_tie")
    ends = (rows if source is None else placed(source)).where(is_mark).groupBy(*keys, "_bin").agg(
        *[F.max_by(F.when(h, m.value), F.when(h, order)).alias(m.name) for m, h in zip(marks, holds)]
    )
    by_bin = Window.partitionBy(*keys).orderBy("_bin")
    last_bin = max(flip * first, flip * last)
    carried = (
        ends.select(
            *keys,
            *[
                F.last(m.name, ignorenulls=True)
                .over(by_bin.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                .alias(f"_in_{m.name}")
                for m in marks
            ],
            (F.col("_bin") + 1).alias("_from"),
            F.coalesce(F.lead("_bin").over(by_bin), F.lit(last_bin)).alias("_to"),
        )
        .where("_from <= _to")
        .withColumn("_bin", F.explode(F.sequence("_from", "_to")))
        .drop("_from", "_to")
    )
    joined = local.join(carried, [*keys, "_bin"], "left")
    return joined.select(*kept, *[F.coalesce(m.name, f"_in_{m.name}").alias(m.name) for m in marks])


def asof(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    values: list[str],
    *,
    forward: bool = False,
    strict: bool = False,
    day: str = "Date",
    bin_seconds: int = 3600,
) -> DataFrame:
    """Left rows with the columns of the latest (forward: next) right row of the same keys.

    Unmatched left rows keep nulls. The right frame should have one row per keys and
    instant; among several, the greatest ``values`` win.
    """
    on = [*keys] if day in keys else [*keys, day]
    payload = F.struct(F.col(right_ts), *[F.col(v) for v in values]) if values else F.col(right_ts)
    marks = right.where(F.col(right_ts).isNotNull()).select(
        *on, F.col(right_ts).alias("_ts"), payload.alias("_right"), F.lit(True).alias("_is_mark")
    )
    names = left.columns
    targets = left.withColumn("_ts", F.col(left_ts)).withColumn("_is_mark", F.lit(False))
    both = targets.unionByName(marks, allowMissingColumns=True)
    rank = F.struct(F.when(F.col("_is_mark"), 0).otherwise(1).alias("side"), F.col("_right")) if values else None
    out = carry(
        both, on, "_ts", [Mark("_match", F.col("_is_mark"), F.col("_right"), strict)],
        day=day, rank=rank, forward=forward, bin_seconds=bin_seconds, source=marks,
    ).where(~F.col("_is_mark"))
    if not values:
        return out.select(*[F.col(c) for c in names], F.col("_match").alias(right_ts))
    return out.select(
        *[F.col(c) for c in names],
        *[F.col(f"_match.{c}").alias(c) for c in dict.fromkeys([right_ts, *values])],
    )
