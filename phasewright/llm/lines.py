"""Line deduplication that returns keep bitmaps.

Line hashes are range-partitioned together with the document that holds them and sorted by
hash, document and position. One pass over each sorted run gives the number of documents and
the document that comes first; a key that spans several ranges (a line that a third of all
documents hold does) is put together from one partial result for each range. Texts stay where
they are: what comes back is one run-length bitmap for each document that loses lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasewright.llm.text import ascii_lower, let, lines, strip, whole
from phasewright.session import stage

_LAST = 2**63 - 1


def _row_key(id_col: str, text_col: str) -> list[Column]:
    """What names a row: equal ids with equal texts lose the same lines, so they may share a bitmap."""
    return [F.col(id_col).cast("long").alias("_doc"), F.xxhash64(whole(F.col(text_col))).alias("_text")]


def keep_bitmaps(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None
) -> DataFrame:
    """Bitmaps of the lines each document keeps, one row for each document that loses any.

    A key is a line stripped of white space with A-Z lower-cased. Keys of at least ``min_chars``
    code points that at least ``min_docs`` documents hold lose every line except those in the
    document that comes first, the one with the largest id. Columns: ``_doc``, ``_text`` (the
    row), ``n_lines``, ``keep_runs`` (array of start and length of each run of kept lines, a
    run-length bitmap).

    Null ids count as one document that comes last; a null text is one empty line. Rows with
    equal id are one document: repeated rows do not raise the count of documents.
    """
    key = ascii_lower(strip(F.col("_line")))
    found = (
        docs.select(*_row_key(id_col, text_col), F.posexplode(lines(F.col(text_col))).alias("_pos", "_line"))
        .where(F.length(strip(F.col("_line"))) >= min_chars)
        # ~id turns largest-first into an ascending order that no id overflows
        .select(F.unhex(F.md5(key)).alias("_key"), F.coalesce(F.bitwise_not("_doc"), F.lit(_LAST)).alias("_order"), "_doc", "_text", "_pos")
    )
    found = stage(found, "line-keys")  # texts are parsed once, not again for the sample that sets the ranges
    by = [F.col("_key"), F.col("_order")]
    ordered = (found.repartitionByRange(ranges, *by) if ranges else found.repartitionByRange(*by)).sortWithinPartitions("_key", "_order", "_pos")
    # the first grouping stays inside the ranges; the second merges the ranges of a key
    firsts = (
        ordered.groupBy("_key", "_order").agg(F.lit(1).alias("_one"))
        .groupBy("_key").agg(F.sum("_one").alias("_docs"), F.min("_order").alias("_first"))
        .where(F.col("_docs") >= min_docs)
    )
    firsts = stage(firsts, "line-firsts")  # a join on stored rows splits a hot key, one on an aggregate cannot
    lost = ordered.join(firsts, "_key").where(F.col("_order") != F.col("_first"))
    per_doc = lost.groupBy("_doc", "_text").agg(F.array_sort(F.collect_set("_pos")).alias("_lost"))
    return per_doc.select("_doc", "_text", _runs_between(F.col("_lost")).alias("_gaps"))


def _runs_between(lost: Column) -> Column:
    """Kept runs between sorted lost positions; the last one is open (length -1) until the number of lines is known."""
    before = F.concat(F.array(F.lit(-1)), lost)
    after = F.concat(lost, F.array(F.lit(None).cast("int")))
    runs = F.zip_with(before, after, lambda a, b: F.struct((a + 1).alias("start"), F.coalesce(b - a - 1, F.lit(-1)).alias("length")))
    return F.filter(runs, lambda r: r["length"] != 0)


def close_runs(gaps: Column, n_lines: Column) -> Column:
    """The bitmap of a row: all lines where it lost none, the open last run cut at the number of lines."""
    everything = F.array(F.struct(F.lit(0).alias("start"), n_lines.cast("int").alias("length")))
    closed = F.transform(gaps, lambda r: F.struct(
        r["start"].alias("start"), F.when(r["length"] < 0, n_lines.cast("int") - r["start"]).otherwise(r["length"]).alias("length")))
    return F.coalesce(F.filter(closed, lambda r: r["length"] > 0), everything)


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The text with the lines of its bitmap, joined by newlines."""
    kept = let(lines(text), lambda own: F.flatten(F.transform(keep_runs, lambda r: F.slice(own, r["start"] + 1, r["length"]))))
    return F.array_join(kept, "\n")


def with_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Every row of ``docs`` with ``n_lines``, ``n_dropped`` and ``keep_runs`` beside its own columns.

    Columns of ``docs`` with one of these names are replaced. An empty table gives an empty one.
    """
    maps = keep_bitmaps(docs, id_col=id_col, text_col=text_col, **limits)
    doc, text = _row_key(id_col, text_col)
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "keep_runs")]
    rows = docs.select(F.struct(*own).alias("_row"), doc, text, F.size(lines(F.col(text_col))).cast("long").alias("n_lines")).alias("l")
    r = maps.alias("r")
    joined = rows.join(r, F.col("l._doc").eqNullSafe(F.col("r._doc")) & (F.col("l._text") == F.col("r._text")), "left")
    runs = close_runs(F.col("r._gaps"), F.col("l.n_lines"))
    kept = F.aggregate("keep_runs", F.lit(0).cast("long"), lambda total, run: total + run["length"])
    return (
        joined.select(F.col("l._row").alias("_row"), F.col("l.n_lines").alias("n_lines"), runs.alias("keep_runs"))
        .select("_row.*", "n_lines", (F.col("n_lines") - kept).alias("n_dropped"), "keep_runs")
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with its repeated lines removed from the text; rows and columns stay."""
    out = with_bitmaps(docs, id_col, text_col, **limits)
    text = F.when(F.col("n_dropped") > 0, kept_text(F.col(text_col), F.col("keep_runs"))).otherwise(F.col(text_col))
    return out.withColumn(text_col, text).select(*docs.columns)
