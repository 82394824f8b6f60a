"""Exact duplicates with the frequent digests split off.

Every text becomes the SHA-256 of what is left without white space. Misra-Gries counters (Spark's
frequent-items sketch: a bounded table of counters, all of them lowered when it is full) find the
digests that may hold more than a few thousandths of all rows; sketches of the input's slices are
merged in two steps. The rows of these digests are aggregated exactly, and the verified winners,
at most as many as the sketch can report, are broadcast: their copies are answered where they lie.
All other digests are shuffled as usual.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasewright.llm.text import SPACE, whole
from phasewright.session import stage


def without_space(text: Column) -> Column:
    """The text without any white space; empty for null."""
    return F.translate(whole(text), SPACE, "")


def frequent(keys: DataFrame, counters: int = 3000, most: int = 1000, slices: int = 256) -> DataFrame:
    """Digests (``digest``) that may be frequent, at most ``most``; all above 3.5 / ``counters`` of the rows are among them.

    The counters of each slice of the input are merged first, then those of the slices, so that
    no task meets more than its share of the sketches.
    """
    sliced = keys.groupBy((F.spark_partition_id() % slices).alias("slice")).agg(F.expr(f"approx_top_k_accumulate(digest, {counters})").alias("state"))
    merged = sliced.groupBy(F.lit(True).alias("all")).agg(F.expr(f"approx_top_k_combine(state, {counters})").alias("state"))
    return merged.select(F.explode(F.expr(f"approx_top_k_estimate(state, {min(most, counters)})")).alias("top")).select(F.col("top.item").alias("digest"))


def _winners(keys: DataFrame) -> DataFrame:
    """One row for each digest: ``keep_id``, ``keep_row`` and ``group_size``. The longest original stays, then the smallest id, null last."""
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")
    return keys.groupBy("digest").agg(best, F.count(F.lit(1)).alias("group_size")).select(
        "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")


def _keys(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"), F.length(whole(text)).alias("n_chars"), F.sha2(without_space(text).cast("binary"), 256).alias("digest"),
        F.monotonically_increasing_id().alias("row"), *more)


def _decide(keys: DataFrame, counters: int, most: int) -> DataFrame:
    """The rows of the stored ``keys`` with their winners; those of frequent digests are not shuffled."""
    likely = stage(frequent(keys.select("digest"), counters, most), "frequent-digests")
    hot = stage(_winners(keys.join(F.broadcast(likely), "digest", "left_semi")), "frequent-winners")
    cold = keys.join(F.broadcast(likely), "digest", "left_anti")
    return keys.join(F.broadcast(hot), "digest").unionByName(cold.join(_winners(cold), "digest"))


def exact_duplicates(docs: DataFrame, counters: int = 3000, most: int = 1000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``, the digest.

    Texts are equal when they are the same without the six characters of ASCII white space; null
    counts as empty, so null, empty and blank texts are one group. Of a group stays the row with
    the most code points in its original text, then the one with the smallest id (null after all
    others). Of rows equal in both, one stays. An empty table gives no rows; other columns of
    ``docs`` are not read.

    Ids, lengths and digests are stored once, and only they move. A digest that holds a third of
    all rows is never shuffled: its rows meet a broadcast of at most ``most`` winners. A digest
    below the sketch's sight, 3.5 / ``counters`` of the rows, is shuffled after partial aggregation.
    """
    keys = stage(_keys(docs, id_col, text_col), "digests")
    return _decide(keys, counters, most).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, counters: int = 3000, most: int = 1000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, as ``exact_duplicates`` chooses it, with the columns of ``docs``.

    The rows are stored once with their digests; the dropped ones, a row number each, meet them there.
    """
    rows = stage(_keys(docs, id_col, text_col, F.struct("*").alias("doc")), "digested-documents")
    lost = _decide(rows.drop("doc"), counters, most).where("row <> keep_row").select("row")
    return rows.join(lost, "row", "left_anti").select("doc.*")
