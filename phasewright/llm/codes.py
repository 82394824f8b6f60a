"""Vector codes by product quantisation, in whole numbers throughout.

A vector is cut into parts, and every part is replaced by the index of the nearest entry of its
position's codebook. Parts and entries are padded with zeros to a power of two and sent through the
integer Walsh-Hadamard transform, which multiplies every squared distance by that power. Squared
differences are added up in sequency order, a few coefficients at a time: what is gathered never
exceeds the whole distance, so an entry above the bound that a first guess has set is out, and most
entries never see their last coefficients. All of it is integer arithmetic; ties are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from phasewright.llm import vectors
from phasewright.session import stage

CHUNK = 256  # parts compared with a codebook at once: bounds the memory of a task
SPARSE = 2  # pairs are looked up one by one when fewer than one in so many is left


def sequency_order(size: int) -> np.ndarray:
    """Position s holds the Hadamard row with s sign changes: the reversed bits of the Gray code of s. ``size`` is a power of two."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    out = np.zeros(size, np.int64)
    for bit in range(bits):
        out |= ((gray >> bit) & 1) << (bits - 1 - bit)
    return out


def walsh_hadamard(rows: np.ndarray) -> np.ndarray:
    """The unscaled transform of every row in sequency order, rows padded with zeros to a power of two."""
    n, width = rows.shape
    size = 1 << max(0, width - 1).bit_length()
    out = np.zeros((n, size), np.int64)
    out[:, :width] = rows
    half = 1
    while half < size:
        pairs = out.reshape(n, size // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return out[:, sequency_order(size)]


def nearest(parts: np.ndarray, entries: np.ndarray, step: int = 4) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry of each part, the squared distance, and how many coefficients were compared.

    Both come transformed. Distances are exact; of equal ones the lowest index wins. While most
    entries are still in, a step works on the whole table of parts and entries; then on the pairs left.
    """
    n, size = parts.shape
    index, scaled, compared = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    reach = int(np.abs(parts).max(initial=0)) + int(np.abs(entries).max(initial=0))
    kind = np.int32 if size * reach**2 < 2**31 else np.int64
    columns = np.ascontiguousarray(entries.T.astype(kind))
    for start in range(0, n, CHUNK):
        own = parts[start : start + CHUNK].astype(kind)
        here = np.arange(len(own))
        gathered, part = np.zeros((len(own), len(entries)), kind), np.empty((len(own), len(entries)), kind)
        bound = np.full(len(own), np.iinfo(kind).max, kind)
        done, alive = 0, None
        while done < size and (alive is None or alive.sum() * SPARSE > alive.size):
            for k in range(done, min(done + step, size)):
                np.subtract(own[:, k, None], columns[k], out=part)
                np.multiply(part, part, out=part)
                gathered += part
            compared += gathered.size * (min(done + step, size) - done)
            done += step
            guess = gathered.argmin(axis=1)
            bound = np.minimum(bound, gathered[here, guess] + ((own[:, done:] - columns.T[guess, done:]) ** 2).sum(axis=1, dtype=kind))
            alive = gathered <= bound[:, None]
        row, entry = np.nonzero(alive)
        total = gathered[row, entry]
        for k in range(done, size, step):
            total += ((own[row, k : k + step] - columns.T[entry, k : k + step]) ** 2).sum(axis=1, dtype=kind)
            compared += len(row) * min(step, size - k)
            left = total <= bound[row]
            row, entry, total = row[left], entry[left], total[left]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        least = np.minimum.reduceat(total, first)
        at = np.flatnonzero(total == least[row])
        best = at[np.r_[True, row[at][1:] != row[at][:-1]]]
        index[start : start + len(own)], scaled[start : start + len(own)] = entry[best], least
    return index, scaled // size, compared


class Codebooks(NamedTuple):
    """Entries of each part position: an array (parts, entries, width of a part)."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _cut(column: pa.Array, books: np.ndarray) -> list[np.ndarray]:
    parts, _, width = books.shape
    whole = vectors.matrix(column, parts * width)
    return [whole[:, p * width : (p + 1) * width] for p in range(parts)]


def _partial_sums(books: np.ndarray):
    """Per task, what each entry's parts add up to."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transformed = [walsh_hadamard(b) for b in books]
        count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for p, part in enumerate(_cut(batch.column("comps"), books)):
                index, _, _ = nearest(walsh_hadamard(part), transformed[p])
                count[p] += np.bincount(index, minlength=books.shape[1])
                np.add.at(total[p], index, part)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "n": pa.array(count[p, e], pa.int64()),
            "sums": pa.array(total[p, e].tolist(), pa.list_(pa.int64()))})

    return add


def _assigned(books: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transformed = [walsh_hadamard(b) for b in books]
        for batch in batches:
            found = [nearest(walsh_hadamard(part), transformed[p]) for p, part in enumerate(_cut(batch.column("comps"), books))]
            hexed = ["".join(f"{i:02x}" for i in row) for row in zip(*(index.tolist() for index, _, _ in found))]
            error = sum((distance for _, distance, _ in found), np.zeros(batch.num_rows, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(hexed, pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"])

    return assign


def integer_vectors(rows: DataFrame, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id``, ``label`` and ``comps`` (floor of ``scale`` times each component) of the usable rows."""
    return rows.where(vectors.usable(F.col(vector_col))).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), vectors.scaled(F.col(vector_col), scale).alias("comps"))


def fit(rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> Codebooks:
    """Codebooks of the stored ``rows`` (``vec_id``, ``comps``): the first ids' parts, moved ``rounds`` times to the mean of what is nearest.

    The driver holds the codebooks only, ``entries`` vectors; every round is one pass over all
    rows with exact integer sums, so a task that runs again changes nothing.
    """
    _, longest, largest = vectors.reach(rows, "comps")
    width = max(1, -(-longest // parts))
    size = 1 << (width - 1).bit_length()
    if size * width * (2 * largest) ** 2 >= 2**63:
        raise ValueError(f"components up to {largest} do not leave room for exact 64-bit distances")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "comps").select("comps").limit(entries).collect()
    start = np.zeros((len(first), parts * width), np.int64)
    for i, row in enumerate(first):
        start[i, : len(row[0])] = row[0]
    books = np.stack([start[:, p * width : (p + 1) * width] for p in range(parts)])
    for _ in range(rounds if len(first) else 0):
        sums = rows.select("comps").mapInArrow(_partial_sums(books), "part int, entry int, n long, sums array<long>")
        flat = sums.select("part", "entry", "n", F.posexplode("sums").alias("place", "value"))
        moved = books.copy()
        for part, entry, place, n, value in flat.groupBy("part", "entry", "place").agg(F.sum("n"), F.sum("value")).collect():
            moved[part, entry, place] = value // n
        books = moved
    return Codebooks(books)


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``code`` and ``error`` of every row of ``rows`` (``vec_id``, ``label``, ``comps``)."""
    schema = StructType([rows.schema["vec_id"], rows.schema["label"], StructField("code", StringType()), StructField("error", LongType())])
    if not books.entries.shape[1]:
        return rows.sparkSession.createDataFrame([], schema)
    return rows.select("vec_id", "label", "comps").mapInArrow(_assigned(books.entries), schema)


def compress(
    rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Per usable row: ``vec_id``, ``code`` (two hex digits a part), ``error``, ``label_error`` and ``codebooks_sha256``.

    Rows with a null vector or a null, NaN or infinite component take no part. ``error`` is the
    squared distance between the vector's integers and its code's entries; ``label_error`` is the
    sum over equal labels, null labels together (null where it leaves 64 bits). Vectors shorter
    than the longest, and the last part of a length that ``parts`` does not divide, end in zeros.
    Rows with equal ids are separate rows; as starting entries they stand in the order of their
    components, and null ids come last. An empty table gives no rows.
    """
    if entries > 256:
        raise ValueError("two hex digits name 256 entries")
    own = stage(integer_vectors(rows, scale, id_col, vector_col, label_col), "integer-vectors")
    books = fit(own, parts, entries, rounds)
    coded = stage(encode(own, books), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))
