"""Benchmark passages in documents, found by the q-gram lemma and verified by banded alignment.

A passage of m characters within e edits of a text shares at least m - q + 1 - e * q of its
q-grams with it, all on diagonals that lie within e of each other. Shared q-grams are counted in
diagonal bands that overlap by half, so that one band holds the whole match; bands that reach
the bound are aligned. Nothing within the budget is lost. The benchmark is the query set: it is
read in blocks of bounded length, each against all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewright.llm.text import id_key, id_of, whole

_STEP = 1 << 32  # one edit, above any offset
_OUTSIDE = np.uint32(0xFFFFFFFF)
_SPACE = re.compile(r"\s")


def normal(text: str | None) -> str:
    """Lower case, every white-space character a space; as many characters as before."""
    text = text or ""
    low = text.lower()
    low = low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return _SPACE.sub(" ", low)


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hashes of the q-grams of an array of code points, put together from halves: grams of 1, 2, 4, ... and the rest."""
    if len(codes) < q:
        return np.empty(0, np.uint32)
    power, width, done, out = codes, 1, 0, None
    while True:
        if q & width:
            out = power.copy() if out is None else _join(out, power, done)
            done += width
        width *= 2
        if width > q:
            return out[: len(codes) - q + 1]
        power = _join(power, power, width // 2)


def _join(left: np.ndarray, right: np.ndarray, gap: int) -> np.ndarray:
    n = min(len(left), len(right) - gap)
    out = (left[:n] ^ (left[:n] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + right[gap : gap + n] * np.uint32(0x9E3779B1)
    return out ^ (out >> np.uint32(13))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Index:
    """The q-grams of a block of passages."""

    def __init__(self, items: list[tuple[int, str]], q: int, rate: float):
        self.q = q
        self.items = [(i, text) for i, text in items if len(text) >= q]
        lengths = np.array([len(text) for _, text in self.items], np.int64)
        # the largest budget whose bound is at least one shared q-gram
        self.budget = np.minimum((lengths * rate).astype(np.int64), np.maximum(0, (lengths - q) // q))
        self.bound = lengths - q + 1 - self.budget * q
        self.width = np.maximum(8, 2 * self.budget)
        found = [grams(codes(text), q) for _, text in self.items]
        hashed = np.concatenate(found) if found else np.empty(0, np.uint32)
        order = np.argsort(hashed, kind="stable")
        self.keys, self.first, self.count = np.unique(hashed[order], return_index=True, return_counts=True)
        self.owner = np.repeat(np.arange(len(found)), [len(g) for g in found])[order]
        self.place = np.concatenate([np.arange(len(g)) for g in found])[order] if found else np.empty(0, np.int64)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.keys & np.uint32((1 << 22) - 1)).astype(np.int64)] = True

    def bands(self, text: np.ndarray) -> list[tuple[int, int]]:
        """(item, band) pairs of one text that reach the bound of the item."""
        hashed = grams(text, self.q)
        at = np.flatnonzero(self.bits[(hashed & np.uint32((1 << 22) - 1)).astype(np.int64)])
        if not len(at):
            return []
        slot = np.minimum(np.searchsorted(self.keys, hashed[at]), len(self.keys) - 1)
        same = self.keys[slot] == hashed[at]
        at, slot = at[same], slot[same]
        if not len(at):
            return []
        n = self.count[slot]
        which = np.repeat(self.first[slot] - np.cumsum(n) + n, n) + np.arange(n.sum())
        item = self.owner[which]
        diagonal = np.repeat(at, n) - self.place[which]
        band = np.floor_divide(diagonal, self.width[item])
        # a band is two widths wide: each hit is in the band that begins in its width and the one before
        key = np.concatenate([item, item]) * (1 << 40) + np.concatenate([band, band - 1]) + (1 << 39)
        keys, counts = np.unique(key, return_counts=True)
        items = keys >> 40
        hit = counts >= self.bound[items]
        return list(zip(items[hit].tolist(), ((keys[hit] & ((1 << 40) - 1)) - (1 << 39)).tolist(), strict=True))


def align(passage: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """Best alignment of the whole passage with a part of ``text`` on diagonals ``low``..``high``: (edits, start, end), or None above the budget."""
    low, high = low - budget, high + budget
    width = high - low + 1
    diagonals = np.arange(low, high + 1)
    far = np.int64(1 << 60)
    steps = np.arange(width, dtype=np.int64) * _STEP
    state = np.where((diagonals >= 0) & (diagonals <= len(text)), np.maximum(diagonals, 0), far)  # edits above, start below
    padded = np.concatenate([np.full(max(0, -low), _OUTSIDE), text, np.full(max(0, high + len(passage) - len(text)) + 1, _OUTSIDE)])
    shift = max(0, -low)
    for i, symbol in enumerate(passage):
        here = padded[low + i + shift : high + i + 1 + shift]
        step = np.where(here == symbol, 0, np.where(here == _OUTSIDE, far >> 1, _STEP))
        moved = np.minimum(state + step, np.append(state[1:], far) + _STEP)
        column = diagonals + i + 1
        moved = np.where((column < 0) | (column > len(text)), far, moved)
        state = np.minimum(np.minimum.accumulate(moved - steps) + steps, far)
    best = int(state.argmin())
    edits, start = divmod(int(state[best]), _STEP)
    return (edits, start, int(diagonals[best]) + len(passage)) if edits <= budget else None


def _search(batches: Iterator[pd.DataFrame], items: list[tuple[int, str]], q: int, rate: float) -> Iterator[pd.DataFrame]:
    index = Index(items, q, rate)
    passages = [codes(text) for _, text in index.items]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            own = normal(text)
            own_codes = codes(own)
            if len(own_codes) < q:
                continue
            for item, band in index.bands(own_codes):
                width, budget = int(index.width[item]), int(index.budget[item])
                low, high = band * width, (band + 2) * width - 1
                passage = passages[item]
                begin = max(0, low - budget)
                at = own.find(index.items[item][1], begin, high + budget + len(passage))
                match = (0, at, at + len(passage)) if at >= 0 else align(passage, own_codes, low, high, budget)
                if match:
                    rows.append((doc_id, index.items[item][0], match[1], match[2], match[0]))
        found = pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "end", "edits"])
        yield found.astype("int64").drop_duplicates()


def _blocks(benchmark: DataFrame, chars: int) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for row in benchmark.toLocalIterator():
        text = normal(row["text"])
        if block and size + len(text) > chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


_MATCH = "doc_id long, item_id long, start long, end long, edits long"


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, q: int = 10, rate: float = 0.06, block_chars: int = 500_000,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Matches of benchmark passages: ``doc_id``, ``item_id``, ``start``, ``end`` (code points), ``edits``; one row for each band that holds one.

    A passage matches where it is at most ``rate`` of its length in edits away from a part of the
    document, after lower-casing and with all white space as spaces. Passages are read in blocks
    of ``block_chars`` characters, one search of all documents for each block. Passages shorter
    than ``q`` characters (and null ones) are no evidence and match nothing; null and empty
    documents hold none; repeated rows and items are reported as often as they occur.
    """
    rows = docs.select(id_key(F.col(id_col)).alias("doc_id"), whole(F.col(text_col)).alias("text"))
    items = benchmark.select(id_key(F.col(item_col)).alias("item_id"), whole(F.col(item_text_col)).alias("text"))
    found = None
    for block in _blocks(items, block_chars):
        search = lambda batches, block=block: _search(batches, block, q, rate)
        part = rows.mapInPandas(search, _MATCH)
        found = part if found is None else found.union(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], _MATCH)
    return found.withColumns({"doc_id": id_of(F.col("doc_id")), "item_id": id_of(F.col("item_id"))})


def leaks_by_document(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """One row for each document and passage it holds: the best match and the number of places."""
    found = find_leaks(docs, benchmark, **settings)
    best = F.min(F.struct("edits", "start", "end"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("m"), F.count_distinct("start").alias("n_places")).select(
        "doc_id", "item_id", "m.start", "m.end", "m.edits", "n_places")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """``docs`` without the documents that hold a passage; null ids are judged together."""
    held = find_leaks(docs, benchmark, id_col=id_col, **settings).select(id_key(F.col("doc_id")).alias("_held")).distinct()
    return docs.join(held, id_key(docs[id_col]) == held["_held"], "left_anti")
