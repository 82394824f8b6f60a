"""Hard negatives of anchors from exact integer scores.

Anchors and candidates are dealt into tiles; every tile is one int64 product, multiplied by
Strassen's recursion on halves padded with zeros. Integer additions are exact in any order, so the
scores are too. A first pass keeps a heap of the best positives for each anchor, a second one a
heap for each positive's window of scores; heaps of tiles are merged by Spark.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from phasewright.llm import vectors
from phasewright.session import stage

LEAST = np.iinfo(np.int64).min
COLUMNS = 2048  # candidates multiplied at once inside a tile: bounds the memory of a task
ROWS = 256  # anchors multiplied at once


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = 32) -> np.ndarray:
    """The product of two int64 matrices by seven products of their halves, down to sides of ``leaf``."""
    n, k = a.shape
    m = b.shape[1]
    if min(n, k, m) <= leaf:
        return a @ b
    a = np.pad(a, ((0, n % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, m % 2)))
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * j), np.int64)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def first_of_each(owner: np.ndarray, score: np.ndarray, place: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` best entries of each owner: higher scores first, then lower places."""
    order = np.lexsort((place, -score, owner))
    owner = owner[order]
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
    return order[rank < most]


def _heap(scores: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``most`` best allowed columns of each row; lower columns first among equals."""
    limit = np.full(len(scores), LEAST)
    if scores.shape[1] > most:
        limit = np.partition(np.where(allowed, scores, LEAST), -most, axis=1)[:, -most]
    row, column = np.nonzero(allowed & (scores >= limit[:, None]))
    best = first_of_each(row, scores[row, column], column, most)
    return row[best], column[best]


def _in_order(table: pa.Table) -> np.ndarray:
    """Positions by id, null last, then row: the order of ties."""
    ids = table["vec_id"]
    return np.lexsort((table["row"].to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))


def _tile_of_positives(most: int, width: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def tile(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.take(_in_order(rows))
        own, other = vectors.matrix(anchors["comps"], width), vectors.matrix(rows["comps"], width).T
        label, other_label = anchors["label"].to_numpy(), rows["label"].to_numpy()
        key, other_key = anchors["row"].to_numpy(), rows["row"].to_numpy()
        found = []
        for top in range(0, len(own), ROWS):
            heap = [np.empty(0, np.int64)] * 3
            for left in range(0, other.shape[1], COLUMNS):
                there, here = slice(top, top + ROWS), slice(left, left + COLUMNS)
                scores = strassen(own[there], other[:, here])
                allowed = (label[there, None] == other_label[None, here]) & (key[there, None] != other_key[None, here])
                row, column = _heap(scores, allowed, most)
                heap = [np.concatenate(x) for x in zip(heap, (row, column + left, scores[row, column]))]
                best = first_of_each(heap[0], heap[2], heap[1], most)
                heap = [x[best] for x in heap]
            found.append((heap[0] + top, heap[1], heap[2]))
        row, column, score = (np.concatenate(x) for x in zip(*found))
        return pa.table({
            "anchor": anchors["row"].take(row), "anchor_id": anchors["vec_id"].take(row), "id": rows["vec_id"].take(column),
            "row": rows["row"].take(column), "score": pa.array(score, pa.int64())})

    return tile


def _tile_of_windows(most: int, low: int, high: int, width: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def tile(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.take(_in_order(rows))
        own, other = vectors.matrix(anchors["comps"], width), vectors.matrix(rows["comps"], width).T
        label, other_label = anchors["label"].to_numpy(), rows["label"].to_numpy()
        slots = anchors["positives"].combine_chunks()
        counts = np.asarray(slots.value_lengths(), dtype=np.int64)
        base = np.cumsum(counts) - counts
        score_of = np.asarray(slots.flatten(), dtype=np.int64)
        found = []
        for top in range(0, len(own), ROWS):
            heap = [np.empty(0, np.int64)] * 3  # slot, column, score
            there = slice(top, top + ROWS)
            for left in range(0, other.shape[1], COLUMNS):
                here = slice(left, left + COLUMNS)
                scores = strassen(own[there], other[:, here])
                differs = label[there, None] != other_label[None, here]
                for slot in range(int(counts[there].max(initial=0))):
                    has = np.flatnonzero(counts[there] > slot)
                    positive = score_of[base[there][has] + slot][:, None]
                    allowed = differs[has] & (low * positive <= 100 * scores[has]) & (100 * scores[has] <= high * positive)
                    row, column = _heap(scores[has], allowed, most)
                    made = (base[there][has[row]] + slot, column + left, scores[has[row], column])
                    heap = [np.concatenate(x) for x in zip(heap, made)]
                best = first_of_each(heap[0], heap[2], heap[1], most)
                heap = [x[best] for x in heap]
            found.append(heap)
        slot, column, score = (np.concatenate(x) for x in zip(*found))
        owner = np.repeat(np.arange(len(counts)), counts)[slot]
        return pa.table({
            "anchor": anchors["row"].take(owner), "slot": pa.array(slot - base[owner], pa.int32()), "id": rows["vec_id"].take(column),
            "row": rows["row"].take(column), "score": pa.array(score, pa.int64())})

    return tile


def _best(heaps: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Heaps of tiles merged: the ``most`` best rows of each key, with their ``rank``."""
    order = W.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _tiles(anchors: DataFrame, rows: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    return anchors.groupBy("slice", "block").cogroup(rows.groupBy("slice", "block")).applyInArrow(work, schema)


def _unless_empty(work: Callable[[pa.Table, pa.Table], pa.Table], names: list[str], types: list[pa.DataType]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def guarded(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if anchors.num_rows and rows.num_rows:
            return work(anchors, rows)
        return pa.schema(zip(names, types)).empty_table()

    return guarded


def mine(
    rows: DataFrame, is_anchor: Column | None = None, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", slice_anchors: int = 2048, block_rows: int = 8192,
) -> DataFrame:
    """Hard negatives: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Rows with a null label, a null vector or a null, NaN or infinite component take no part. A
    score is the inner product of the components floor(``scale`` * x); of equal scores the smaller
    id comes first, null last. Anchors are the rows that ``is_anchor`` (on the columns of ``rows``)
    marks; by default those whose id is divisible by 100. The positives of an anchor are its first
    ``positives`` other rows of the same label. For each of them come the first ``negatives`` rows
    of another label with ``low`` * positive <= 100 * negative <= ``high`` * positive; a negative
    positive score has none. Rows with equal ids are separate rows, anchors included, and may be
    each other's positives. Vectors shorter than the longest count as ending in zeros. A table
    without rows or anchors gives no rows. Components too large for exact 64-bit scores raise ValueError.

    ``slice_anchors`` and ``block_rows`` bound a tile: every slice of anchors meets every block of
    rows in a task of its own, and nothing but their heaps leaves it. Which slice and block a row is in
    follows from a row number, so neither a frequent id nor a frequent label makes a tile large.
    """
    marked = F.col(id_col) % 100 == 0 if is_anchor is None else is_anchor
    kept = rows.where(vectors.usable(F.col(vector_col)) & F.col(label_col).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
        F.coalesce(marked, F.lit(False)).alias("anchor"), vectors.scaled(F.col(vector_col), scale).alias("comps"))
    kept = stage(kept, "scored-vectors")
    n, width, largest = vectors.reach(kept, "comps")
    if 100 * max(1, width) * max(1, largest) ** 2 >= 2**63:
        raise ValueError(f"components up to {largest} do not leave room for exact 64-bit scores")
    n_anchors = kept.where("anchor").count()
    slices, blocks = max(1, -(-n_anchors // slice_anchors)), max(1, -(-n // block_rows))
    place = F.xxhash64("row")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    anchors = kept.where("anchor").select("row", "vec_id", "label", "comps", F.pmod(place, F.lit(slices)).cast("int").alias("slice"))
    dealt = kept.toDF(*kept.columns).select("row", "vec_id", "label", "comps", F.pmod(place, F.lit(blocks)).cast("int").alias("block")).withColumn("slice", spread(slices))
    long, whole = pa.int64(), pa.int32()
    work = _unless_empty(_tile_of_positives(positives, width), ["anchor", "anchor_id", "id", "row", "score"], [long] * 5)
    heaps = _tiles(anchors.withColumn("block", spread(blocks)), dealt, work, "anchor long, anchor_id long, id long, row long, score long")
    chosen = stage(_best(heaps, ["anchor"], positives), "positives")
    scores = chosen.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("positives"))
    asked = anchors.join(scores.withColumnRenamed("anchor", "row"), "row").withColumn("block", spread(blocks))
    work = _unless_empty(_tile_of_windows(negatives, low, high, width), ["anchor", "slot", "id", "row", "score"], [long, whole, long, long, long])
    heaps = _tiles(asked, dealt, work, "anchor long, slot int, id long, row long, score long")
    mined = _best(heaps, ["anchor", "slot"], negatives).select("anchor", (F.col("slot") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = chosen.select("anchor", "anchor_id", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(mined, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
