"""Published tables that are rewritten by period and swapped at once.

The rows of a published table lie in a store ``<table>__parts``, partitioned by month and version.
A publish appends the months it changes as a new version; then one catalog statement makes the
table, a view on the months and versions in force, name them. So a publish writes its window and no
history, readers see the table before or after and never between, and a publish that
fails leaves the table as it was. Versions that the table no longer named before the publish are dropped
by it; the ones it has just replaced stay for readers that are still at them.

One job at a time publishes a table.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasewright.functions.calendar import round_to_tuesday
from phasewright.operators.serving import merge_recomputed
from phasewright.schemas import Target
from phasewright.session import stage

WHOLE = "all"


@dataclass(frozen=True)
class Publication:
    """What a table names: versions by part, and the first period it shows (None: all)."""

    version: int
    parts: Mapping[str, int]
    since: str | None = None


def _store(table: str) -> str:
    return f"{table}__parts"


def publication(spark: SparkSession, table: str) -> Publication | None:
    """What the published table names now; None before its first publish."""
    if not spark.catalog.tableExists(table):
        return None
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    parts = dict(pair.split(":") for pair in kept["published.parts"].split(",") if pair)
    return Publication(int(kept["published.version"]), {p: int(v) for p, v in parts.items()}, kept.get("published.since") or None)


def _stored_parts(spark: SparkSession, table: str) -> list[tuple[str, int]]:
    """Part and version of every stored partition: catalog entries, a few for each month of the report."""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {_store(table)}").collect():
        part, version = (piece.partition("=")[2] for piece in row[0].split("/"))
        found.append((part, int(version)))
    return found


def _part_of(target: Target):
    return F.lit(WHOLE) if target.period is None else F.date_format(F.col(target.period), "yyyy-MM")


def _append(spark: SparkSession, df: DataFrame, table: str, target: Target, version: int) -> None:
    """Rows of a new version. The store's columns are those of its first rows: others are left out, missing ones null."""
    rows = df.withColumns({"_part": F.coalesce(_part_of(target), F.lit("none")), "_version": F.lit(version)})
    if not spark.catalog.tableExists(_store(table)):
        rows.hint("rebalance", "_part").write.format("parquet").partitionBy("_part", "_version").saveAsTable(_store(table))
        return
    known = spark.table(_store(table)).schema
    names = {c.lower(): c for c in rows.columns}
    chosen = [(F.col(names[f.name.lower()]) if f.name.lower() in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in known.fields]
    rows.select(*chosen).hint("rebalance", "_part").write.insertInto(_store(table))


def _swap(spark: SparkSession, table: str, target: Target, now: Publication) -> None:
    """Make the table name the parts in force: one statement, before which and after which it is whole."""
    columns = [f"`{c}`" for c in spark.table(_store(table)).columns if c not in ("_part", "_version")]
    by_version: dict[int, list[str]] = {}
    for part, version in now.parts.items():
        by_version.setdefault(version, []).append(f"'{part}'")
    chosen = " OR ".join(f"(_version = {v} AND _part IN ({', '.join(parts)}))" for v, parts in sorted(by_version.items())) or "1 = 0"
    since = f" AND `{target.period}` >= DATE'{now.since}'" if now.since and target.period else ""
    listed = ",".join(f"{part}:{version}" for part, version in sorted(now.parts.items()))
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('published.version' = '{now.version}', 'published.parts' = '{listed}', 'published.since' = '{now.since or ''}') "
        f"AS SELECT {', '.join(columns)} FROM {_store(table)} WHERE ({chosen}){since}")


def _clean(spark: SparkSession, table: str, *named: Publication | None) -> None:
    """Drop the versions that none of the publications names."""
    kept = {pair for p in named if p is not None for pair in p.parts.items()}
    for part, version in _stored_parts(spark, table):
        if (part, version) not in kept:
            spark.sql(f"ALTER TABLE {_store(table)} DROP IF EXISTS PARTITION (_part = '{part}', _version = {version})")


def first_day(spark: SparkSession, start, target: Target) -> date:
    """Where a window begins: its start, or the Tuesday of the start's week for weekly tables."""
    day = F.lit(str(start)).cast("date")
    return spark.range(1).select(round_to_tuesday(day) if target.weekly else day).first()[0]


def _next_month(day: date) -> date:
    return (day.replace(day=28) + timedelta(days=4)).replace(day=1)


def publish(spark: SparkSession, df: DataFrame, table: str, target: Target, *, start=None, report_start=None, report_end=None, only_parts: set[str] | None = None) -> Publication:
    """Publish rows through the window rule (S21, S22), writing the months of the window alone.

    Kept are the published rows from ``report_start`` on and before ``start`` (weekly tables: the Tuesday
    of its week); then come the new rows from there to the end of the month of ``report_end``. Without a
    start or a period column the new rows replace the table. If the window begins inside a
    month, that month's earlier rows are written again beside the new ones. ``only_parts`` names the
    months (``yyyy-MM``) that have changed: the others of the window stay as they are.
    """
    before = publication(spark, table)
    stored = spark.catalog.tableExists(_store(table))
    version = 1 + max([v for _, v in _stored_parts(spark, table)], default=0) if stored else 1
    kept: dict[str, int] = {}
    since = None
    if target.period is not None and report_end is not None:
        df = df.where(F.col(target.period) < F.lit(str(_next_month(date.fromisoformat(str(report_end))))).cast("date"))
    if before is not None and target.period is not None and start is not None:
        first = first_day(spark, start, target)
        border = f"{first:%Y-%m}"
        df = df.where(F.col(target.period) >= F.lit(str(first)).cast("date"))
        kept = {p: v for p, v in before.parts.items() if p < border}
        if first.day > 1 and border in before.parts:
            early = spark.table(table).where((_part_of(target) == border) & (F.col(target.period) < F.lit(str(first)).cast("date")))
            df = df.unionByName(early, allowMissingColumns=True)
        if only_parts is not None:
            df = df.where(_part_of(target).isin(*only_parts)) if only_parts else df.limit(0)
            kept |= {p: v for p, v in before.parts.items() if p not in only_parts}
        since = before.since
        if report_start is not None:
            since = str(report_start)
            kept = {p: v for p, v in kept.items() if p >= since[:7]}
    _append(spark, df, table, target, version)
    written = {part: v for part, v in _stored_parts(spark, table) if v == version}
    now = Publication(version, kept | written, since)
    _swap(spark, table, target, now)
    _clean(spark, table, before, now)
    return now


def publish_bundle(spark: SparkSession, bundle, *, prefix: str = "", **window) -> dict[str, Publication]:
    """Publish every table of a bundle as its target says (S25). The loop is over table names; each write is its own distributed job."""
    return {name: publish(spark, bundle[name], prefix + name, bundle.targets[name], **window) for name in bundle}


def changed_parts(old: DataFrame, new: DataFrame, target: Target) -> set[str]:
    """The months in which two frames of the same columns differ, by value and number of equal rows: one row for each month reaches the driver."""
    new = new.select(*[F.col(c).cast(old.schema[c].dataType).alias(c) if c in new.columns else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in old.columns])
    differing = old.exceptAll(new).unionByName(new.exceptAll(old))
    return {r[0] for r in differing.select(_part_of(target).alias("part")).distinct().collect()}


def write_aggregations(spark: SparkSession, bundle, *, report_start, calc_start, report_end, prefix: str = "") -> dict[str, set[str]]:
    """Merge every aggregate with what is published and publish the months that changed (S26); returns these by table.

    The recomputed rows from ``calc_start`` on replace the published ones, and the change from one
    period to the next is taken again over both (Q01). Comparing the result with the published rows
    gives the months that differ, and only these are written: the table's version tells what each
    month was last changed by. An aggregate that comes out the same is not written at all. Tables
    without a measure are published through the window; those without a period are replaced.
    """
    changed: dict[str, set[str]] = {}
    for name in bundle:
        table, target = prefix + name, bundle.targets[name]
        window = {"report_start": report_start, "report_end": report_end}
        before = publication(spark, table)
        if before is None or target.period is None or target.variable is None:
            now = publish(spark, bundle[name], table, target, start=calc_start if before else None, **window)
            changed[name] = {p for p, v in now.parts.items() if v == now.version}
            continue
        first = first_day(spark, calc_start, target)
        end = F.lit(str(_next_month(date.fromisoformat(str(report_end))))).cast("date")
        recent = bundle[name].where(F.col(target.period) < end)
        published = spark.table(table)
        merged = stage(merge_recomputed(published, recent, target.variable, target.period, report_start, str(first)), "merged")
        since = F.col(target.period) >= F.lit(str(report_start)).cast("date")
        parts = changed_parts(published.where(since), merged.where(since), target)
        changed[name] = parts
        if parts:
            begin = min(parts) + "-01"
            publish(spark, merged, table, Target(target.period, False, target.variable), start=begin, only_parts=parts, **window)
    return changed
