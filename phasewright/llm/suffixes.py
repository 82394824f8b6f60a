"""Removal of byte strings that occur elsewhere, by sorting suffixes in shards.

Every 200-byte window names the 32-byte gram in it with the least hash, its anchor: equal
windows name equal anchors, so windows can be dealt by anchor and no match crosses shards.
Windows in a row with the same anchor travel as one segment. Anchors that occur once need no
sorting. Equal segments are folded into one that carries its count, which bounds what a
passage shared by many documents sends; then the suffixes of each shard are sorted by external
induced sorting, and a window repeats if it shares 200 bytes with a neighbour in the order or
its segment was folded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewright.llm.induced import suffix_order
from phasewright.llm.text import id_key, id_of, whole
from phasewright.session import stage

GRAM = 32  # bytes of an anchor
BUFFER = 1 << 19  # bytes hashed at once
SHARD = 1 << 20  # bytes sorted at once; an anchor is never split
QUEUE = 100_000  # tuples of a sort that wait in memory, a fraction of a shard's; the others wait on disk
SINGLE = 50_000  # windows of hot anchors sent on at once
HOT = 4096  # different segments of an anchor beyond which its windows are dealt singly
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 24) - 1)


_known_powers: dict[int, tuple] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, and a 64-bit value for each byte."""
    if n in _known_powers:
        return _known_powers[n]
    base = 0xD1342543DE82EF95
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    values = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
    _known_powers.clear()
    _known_powers[n] = np.multiply.accumulate(up), np.multiply.accumulate(down), values
    return _known_powers[n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return x ^ (x >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row: of the end of one block and the start of the next."""
    n = len(x)
    padded = np.append(x, np.full(-n % width, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def segments(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int):
    """Runs of windows with one anchor in a buffer of several pieces.

    Returns arrays: piece, first window (offset in the piece), number of windows, anchor, hash
    of the bytes. Pieces shorter than a window have none.
    """
    empty = np.empty(0, np.int64)
    n = len(buffer)
    if n < window:
        return empty, empty, empty, empty, empty
    up, down, values = _powers(BUFFER + (1 << 16) if n <= BUFFER + (1 << 16) else n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[buffer] * up[:n], out=sums[1:])
    grams = _mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    at = np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_min((grams & ~_LOW) | at, window - GRAM + 1) & _LOW).astype(np.int64)
    usable = np.zeros(len(anchor) + 1, np.int32)
    long = lengths >= window
    np.add.at(usable, starts[long], 1)
    np.add.at(usable, np.minimum(starts[long] + lengths[long] - window + 1, len(anchor)), -1)
    usable = np.cumsum(usable[:-1]) > 0
    new = usable.copy()
    new[1:] &= ~usable[:-1] | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(new)
    ends = np.zeros(len(anchor), bool)
    ends[:-1] = usable[:-1] & (~usable[1:] | new[1:])
    ends[-1:] = usable[-1:]
    last = np.flatnonzero(ends)
    piece = np.searchsorted(starts, first, side="right") - 1
    hashed = _mix((sums[last + window] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return piece, first - starts[piece], last - first + 1, grams[anchor[first]].view(np.int64), hashed.view(np.int64)


def _pieces(texts, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of whole texts; a text above the buffer's size is cut, with pieces that overlap by a window less one byte."""
    parts, rows, offsets, size = [], [], [], 0

    def done():
        lengths = np.array([len(p) for p in parts], np.int64)
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lengths) - lengths, lengths, np.array(rows), np.array(offsets)

    for row, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        step = BUFFER - window + 1
        for offset in range(0, max(1, len(raw) - window + 1), step):
            part = raw[offset : offset + BUFFER]
            if size + len(part) > BUFFER and parts:
                yield done()
                parts, rows, offsets, size = [], [], [], 0
            parts.append(part)
            rows.append(row)
            offsets.append(offset)
            size += len(part)
    if parts:
        yield done()


def _cut(batches: Iterator[pd.DataFrame], window: int, places: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids, keys = batch["doc_id"].to_numpy(), batch["text_key"].to_numpy()
        for buffer, starts, lengths, rows, offsets in _pieces(batch["text"], window):
            piece, first, n, anchor, hashed = segments(buffer, starts, lengths, window)
            if not places:
                yield pd.DataFrame({"anchor": anchor})
                continue
            at = rows[piece] if len(piece) else piece
            yield pd.DataFrame({
                "anchor": anchor, "segment": hashed, "doc_id": ids[at], "text_key": keys[at],
                "first": first + (offsets[piece] if len(piece) else 0), "n": n.astype(np.int32)})


_CUT = "anchor long, segment long, doc_id long, text_key long, first long, n int"


def _repeats(texts: list[bytes], counts: np.ndarray, windows: np.ndarray, window: int, memory_rows: int) -> list[list[tuple[int, int]]]:
    """For each segment the runs (from, to) of its windows that occur more than once in the shard."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    symbols = np.zeros(int(lengths.sum()) + len(texts), np.int32)
    mask = np.ones(len(symbols), bool)
    mask[starts + lengths] = False
    symbols[mask] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int32) + 1
    order, shared = suffix_order(symbols, memory_rows=memory_rows, most=window)
    long = np.append(shared >= window, False)
    repeated = np.zeros(len(symbols) + 1, bool)
    repeated[order[long[:-1] | long[1:]]] = True
    for i in np.flatnonzero(counts > 1):
        repeated[starts[i] : starts[i] + windows[i]] = True
    repeated[starts + windows] = False
    step = np.diff(np.concatenate([[False], repeated]).astype(np.int8))
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    owner = np.searchsorted(starts, begin, side="right") - 1
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for i, lo, hi in zip(owner.tolist(), begin.tolist(), end.tolist(), strict=True):
        out[i].append((lo - int(starts[i]), hi - int(starts[i])))
    return out


def _sort_shards(batches: Iterator[pd.DataFrame], window: int, memory_rows: int) -> Iterator[pd.DataFrame]:
    """Sort whole anchors, about ``SHARD`` bytes at a time. Rows come ordered by anchor."""

    def result(rows: pd.DataFrame) -> pd.DataFrame:
        runs = _repeats(rows["bytes"].tolist(), rows["count"].to_numpy(), rows["n"].to_numpy().astype(np.int64), window, memory_rows)
        found = pd.DataFrame({"anchor": rows["anchor"].to_numpy(), "segment": rows["segment"].to_numpy(), "runs": [[{"a": a, "b": b} for a, b in r] for r in runs]})
        return found[[len(r) > 0 for r in runs]]

    waiting, size = [], 0
    for batch in batches:
        if not len(batch):
            continue
        waiting.append(batch)
        size += int(batch["bytes"].map(len).sum())
        if size >= SHARD:
            rows = pd.concat(waiting, ignore_index=True)
            whole_anchors = rows["anchor"] != rows["anchor"].iloc[-1]
            if whole_anchors.any():
                yield result(rows[whole_anchors].reset_index(drop=True))
            waiting = [rows[~whole_anchors].reset_index(drop=True)]
            size = int(waiting[0]["bytes"].map(len).sum())
    if waiting:
        yield result(pd.concat(waiting, ignore_index=True))


def _single_windows(batches: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    """The windows of hot anchors one by one, hashed to 128 bits, some ``SINGLE`` at a time."""
    names = ["anchor", "segment", "count", "i", "hash"]
    rows = []
    for batch in batches:
        for anchor, segment, count, raw, n in zip(batch["anchor"], batch["segment"], batch["count"], batch["bytes"], batch["n"], strict=True):
            for i in range(n):
                rows.append((anchor, segment, count, i, hashlib.blake2b(raw[i : i + window], digest_size=16).digest()))
                if len(rows) >= SINGLE:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
    yield pd.DataFrame(rows, columns=names)


def repeated_spans(docs: DataFrame, window: int = 200, id_col: str = "doc_id", text_col: str = "text", memory_rows: int = QUEUE) -> DataFrame:
    """``docs`` as ``doc_id``, ``text``, ``text_key`` (null ids as the least number) with ``spans``: array of (a, b) byte ranges that any repeated window covers.

    Ranges may touch or overlap; ``removed`` puts them together. ``spans`` is null where nothing
    repeats. Texts are UTF-8 bytes, a null one is empty; rows that repeat are repeats of each
    other, with or without ids. ``window`` must be longer than the 32-byte anchors.
    """
    if window <= GRAM:
        raise ValueError(f"window must be longer than {GRAM} bytes")
    rows = docs.select(id_key(F.col(id_col)).alias("doc_id"), whole(F.col(text_col)).alias("text")).withColumn("text_key", F.xxhash64("text"))
    long = rows.where(F.octet_length("text") >= window)
    cut = lambda places: (lambda batches: _cut(batches, window, places))
    # stored aggregates: a join on stored rows splits a hot anchor, one on an aggregate cannot
    often = stage(long.mapInPandas(cut(False), "anchor long").groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"), "anchors")
    parts = stage(long.mapInPandas(cut(True), _CUT).join(often, "anchor", "left_semi"), "segments")
    place = F.struct("doc_id", "text_key", "first", "n")
    folded = stage(parts.groupBy("anchor", "segment").agg(F.count("*").alias("count"), F.min(place).alias("place")), "folded")
    kinds = stage(folded.groupBy("anchor").agg(F.count("*").alias("kinds")), "kinds")
    known = folded.join(kinds, "anchor").select("anchor", "segment", "count", "place.*", "kinds")
    mixed = known.where("kinds > 1").withColumn("hot", F.col("kinds") > HOT)

    wanted = mixed.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("anchor", "segment", "count", "first", "n", "hot")).alias("own"))
    bytes_of = lambda s: F.substring(F.col("text").cast("binary"), (s["first"] + 1).cast("int"), s["n"] + window - 1)
    found = long.join(wanted, ["doc_id", "text_key"])
    texts = found.select(F.explode("own").alias("s"), "text").select("s.anchor", "s.segment", "s.count", "s.n", "s.hot", bytes_of(F.col("s")).alias("bytes"))
    texts = stage(texts, "segment-texts")
    once = texts.dropDuplicates(["anchor", "segment"])

    sort = lambda batches: _sort_shards(batches, window, memory_rows)
    runs = "runs array<struct<a: int, b: int>>"
    cold = once.where("NOT hot").repartition("anchor").sortWithinPartitions("anchor").mapInPandas(sort, f"anchor long, segment long, {runs}")
    singly = lambda batches: _single_windows(batches, window)
    single = once.where("hot").mapInPandas(singly, "anchor long, segment long, count long, i int, hash binary")
    repeats = single.groupBy("anchor", "hash").agg(F.sum("count").alias("c")).where("c > 1").select("anchor", "hash")
    hot = single.join(repeats, ["anchor", "hash"]).groupBy("anchor", "segment").agg(
        F.array_sort(F.collect_list(F.struct(F.col("i").alias("a"), (F.col("i") + 1).alias("b")))).alias("runs"))
    sorted_runs = cold.union(hot)
    alone = known.where("kinds = 1").select("anchor", "segment", F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"))).alias("runs"))
    verdicts = stage(sorted_runs.union(alone), "verdicts")

    spans = (
        parts.join(verdicts, ["anchor", "segment"]).select("doc_id", "text_key", "first", F.explode("runs").alias("r"))
        .select("doc_id", "text_key", F.struct((F.col("first") + F.col("r.a")).alias("a"), (F.col("first") + F.col("r.b") + window - 1).alias("b")).alias("s"))
        .groupBy("doc_id", "text_key").agg(F.collect_list("s").alias("spans"))
    )
    return rows.join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text", "text_key", "spans")


def merged(spans) -> list[tuple[int, int]]:
    """Maximal ranges covered by the spans; ranges that touch are one."""
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without(raw: bytes, spans) -> tuple[bytes, int, int]:
    """The bytes outside the spans, how many are removed, in how many maximal runs."""
    ranges = merged(spans if spans is not None else [])
    kept, at = [], 0
    for a, b in ranges:
        kept.append(raw[at:a])
        at = b
    kept.append(raw[at:])
    return b"".join(kept), sum(b - a for a, b in ranges), len(ranges)


def _removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            left, removed, n = without(raw, spans)
            rows.append((doc_id, len(raw), removed, n, left))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, window: int = 200, **columns) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the remaining bytes).

    Every byte is removed that a string of ``window`` bytes covers which also starts anywhere
    else, in the same document or another; strings are judged on the input. Kept bytes need not
    be valid UTF-8, as a span can begin inside a character. Empty tables give empty ones.
    """
    out = repeated_spans(docs, window, **columns).mapInPandas(_removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumn("doc_id", id_of(F.col("doc_id")))
