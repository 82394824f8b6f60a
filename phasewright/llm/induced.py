"""External induced sorting of suffixes with common-prefix values.

The suffixes that start a rise (LMS) are named, sorted by recursion on the string of names, and
induce all others in two sweeps over the alphabet: first the falling (L) suffixes upwards, then
the rising (S) ones downwards. A queue on disk carries the tuples of a sweep: leading symbol,
rank of the suffix that induced it, position. A bucket is taken from the queue in bulk, so each
step works on arrays; what it has in memory is one bucket and the queue's buffer, and texts may
be memory-mapped. Common prefixes come with the order: two suffixes induced one after the other
share one symbol more than what lies between their inducers.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

BULK_ALPHABET = 4096  # symbols up to which bucket steps are worth their fixed cost
PREFIXES = 1 << 18  # neighbours compared at once
MOST = 1 << 30  # common prefixes are told apart up to here


class DiskQueue:
    """Tuples (symbol, rank, position), taken out by symbol and in the order of their ranks.

    At most ``memory_rows`` wait in memory; beyond that they are sorted by (symbol, rank) and
    written as one run. Each bucket is a slice of every run.
    """

    def __init__(self, folder: str, memory_rows: int):
        self.folder, self.memory_rows = folder, memory_rows
        self.held: dict[int, list[np.ndarray]] = {}
        self.rows, self.runs, self.written = 0, [], 0

    def push(self, symbol: np.ndarray, rank: np.ndarray, position: np.ndarray) -> None:
        if len(symbol) == 0:
            return
        # small numbers are sorted by counting
        order = np.argsort(symbol.astype(np.uint16) if symbol.max() < 1 << 16 else symbol, kind="stable")
        symbol, rows = symbol[order], np.stack([rank[order], position[order]])
        first = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
        for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(symbol)], strict=True):
            self.held.setdefault(int(symbol[lo]), []).append(rows[:, lo:hi])
        self.rows += len(symbol)
        if self.rows > self.memory_rows:
            self._spill()

    def _spill(self) -> None:
        symbols = sorted(self.held)
        rows = np.concatenate([self._in_order(self.held[x]) for x in symbols], axis=1)
        bounds = np.cumsum([0, *[sum(part.shape[1] for part in self.held[x]) for x in symbols]]).tolist()
        path = os.path.join(self.folder, f"run-{id(self)}-{self.written}.npy")
        np.save(path, rows)
        self.runs.append((np.load(path, mmap_mode="r"), dict(zip(symbols, zip(bounds[:-1], bounds[1:], strict=True), strict=True))))
        self.held, self.rows, self.written = {}, 0, self.written + 1

    @staticmethod
    def _in_order(parts: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(parts, axis=1) if len(parts) > 1 else parts[0]
        return rows[:, np.argsort(rows[0], kind="stable")]

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and positions of all tuples with this symbol, ascending by rank."""
        found = self.held.pop(symbol, [])
        self.rows -= sum(part.shape[1] for part in found)
        for run, slices in self.runs:
            if symbol in slices:
                lo, hi = slices.pop(symbol)
                found.append(np.array(run[:, lo:hi]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(self._in_order(found))


def _small(n: int) -> type:
    """The integers that positions and prefixes of ``n`` symbols need: half the memory for all but very large texts."""
    return np.int32 if n < MOST else np.int64


def _rising(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one. The last is: it stands before all."""
    n = len(text)
    step = np.empty(n, np.int8)
    step[:-1] = (text[1:] > text[:-1]).astype(np.int8) - (text[1:] < text[:-1])
    step[-1] = 1
    # inside a run of equal symbols the step that ends the run decides
    ends = np.flatnonzero(step).astype(_small(n))
    return np.repeat(step[ends] > 0, np.diff(ends, prepend=-1))


def _runs(text: np.ndarray) -> np.ndarray:
    """Length of the run of equal symbols from each position on."""
    kind = _small(len(text))
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), len(text) - 1).astype(kind)
    out = np.repeat(ends + 1, np.diff(ends, prepend=-1))
    out -= np.arange(len(text), dtype=kind)
    return np.minimum(out, MOST, out=out)


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Symbols that the suffixes at ``a`` and ``b`` share, at most ``most``; a separator (0) equals no other."""
    out, n = np.zeros(len(a), np.int64), len(text)
    packed = None
    if n and text.max() < 512:
        packed, clear = np.zeros(n + 7, np.int64), np.ones(n + 7, bool)
        clear[max(0, n - 6) :] = False
        for i in range(min(7, n)):  # seven symbols in one number; none of them a separator or past the end
            packed[: n - i] <<= 9
            packed[: n - i] |= text[i:]
            clear[: n - i] &= text[i:] != 0
    for start in range(0, len(a), PREFIXES):
        live = every = np.arange(start, min(start + PREFIXES, len(a)))
        while packed is not None and len(live):
            x, y = a[live] + out[live], b[live] + out[live]
            live = live[(packed[x] == packed[y]) & clear[x] & clear[y] & (out[live] < most)]
            out[live] += 7
        live = every
        while len(live):
            x, y = a[live] + out[live], b[live] + out[live]
            inside = (x < n) & (y < n) & (out[live] < most)
            live, x, y = live[inside], x[inside], y[inside]
            live = live[(text[x] == text[y]) & (text[x] != 0)]
            out[live] += 1
    return np.minimum(out, most)


def _names(text: np.ndarray, starts: np.ndarray, separators: bool) -> np.ndarray:
    """Ranks of the substrings from each start to the next, both ends included; separators rank by position.

    A substring that is the beginning of another comes after it (a fall sorts before a rise), hence the filler above all symbols.
    """
    n, filler = len(text), int(text.max()) + 1
    ends = np.append(starts[1:], n - 1)
    rank = text[starts].astype(np.int64)
    if separators:
        at = np.flatnonzero(rank == 0)
        rank += len(at)
        rank[at] = np.arange(len(at))
    base, depth = filler + 1, 1
    live = np.flatnonzero(text[starts] != 0) if separators else np.arange(len(starts))
    while len(live):
        key = np.zeros(len(live), np.int64)
        for i in range(depth, depth + 4 if base < 2048 else depth + 1):
            at = starts[live] + i
            key = key * base + np.where(at <= ends[live], text[np.minimum(at, n - 1)], filler)
        order = np.lexsort((key, rank[live]))
        r, k = rank[live][order], key[order]
        new = np.append(True, (r[1:] != r[:-1]) | (k[1:] != k[:-1]))
        group = np.cumsum(new) - 1
        # ranks grow by position in the order: gaps are left so that the others keep theirs
        first = np.append(True, r[1:] != r[:-1])
        inner = group - np.maximum.accumulate(np.where(first, group, 0))
        width = np.bincount(rank, minlength=rank.max() + 1)
        offset = np.cumsum(np.maximum(width, 1)) - np.maximum(width, 1)
        rank = offset[rank]
        changed = np.empty(len(live), np.int64)
        changed[order] = inner
        rank[live] += changed
        depth += 4 if base < 2048 else 1
        goes_on = starts[live] + depth <= ends[live]
        size, some = np.bincount(group), np.bincount(group, weights=goes_on[order])
        again = np.empty(len(live), bool)
        again[order] = ((size > 1) & (some > 0))[group]
        live = live[again]
    return np.unique(rank, return_inverse=True)[1]


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names: by 1, 2, 4, ... names, each time those that still share a rank.

    A rank is the number of suffixes in smaller groups, so a group is refined without touching others.
    """
    n = len(names)
    live = np.argsort(names, kind="stable")
    rank, key, width = np.zeros(n, np.int64), names[live], 1
    while len(live):
        old, at = rank[live], np.arange(len(live))
        new = np.append(True, key[1:] != key[:-1])
        group = np.append(True, old[1:] != old[:-1])
        rank[live] = old + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        live = live[~(new & np.append(new[1:], True))]
        after = live + width
        key = rank[live] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        live, key, width = live[order], key[order], width * 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def _sorted_starts(text: np.ndarray, starts: np.ndarray, separators: bool, folder: str, memory_rows: int) -> np.ndarray:
    names = _names(text, starts, separators)
    if len(starts) and names.max() + 1 == len(starts):
        return np.argsort(names)
    if len(names) and names.max() < BULK_ALPHABET and len(names) > 4 * BULK_ALPHABET:
        return suffix_order(names + 1, False, folder, memory_rows)[0]
    return _by_doubling(names)


class _Sweep:
    """Suffixes in the order a sweep meets them, with the common prefix of each with the one before."""

    def __init__(self, n: int):
        self.shared = np.zeros(n + 1, np.int32)
        self.met, self.kind = 0, _small(n + 1)

    def add(self, shared: np.ndarray) -> np.ndarray:
        ranks = np.arange(self.met, self.met + len(shared), dtype=self.kind)
        self.shared[ranks] = shared
        self.met += len(shared)
        return ranks

    def between(self, inducers: np.ndarray, before: int) -> np.ndarray:
        """One more than the least common prefix between one inducer and the next; ``before`` is the inducer of the suffix before, or -1."""
        out = np.zeros(len(inducers), np.int32)
        if before >= 0:
            out[0] = 1 + self.shared[before + 1 : inducers[0] + 1].min()
        if len(inducers) > 1:
            out[1:] = 1 + np.minimum.reduceat(self.shared[: inducers[-1] + 1], inducers[:-1] + 1)
        return np.minimum(out, MOST)


def suffix_order(
    text: np.ndarray, separators: bool = True, folder: str | None = None, memory_rows: int = 4_000_000, most: int = MOST
) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``text`` and the common prefix of each suffix with the one before it, up to ``most``.

    Symbols are not negative. With ``separators`` every 0 is a symbol of its own, ordered by
    position, so that no common prefix crosses one; the last symbol then must be 0. Without, a
    suffix that ends stands before all that go on. An empty text gives empty arrays.
    """
    if folder is None:
        with tempfile.TemporaryDirectory(prefix="induced-") as own:
            return suffix_order(text, separators, own, memory_rows, most)
    if not separators:
        text = np.append(text, 0)  # an end below all symbols; taken off again
        if text[:-1].size and text[:-1].min() <= 0:
            text[:-1] += 1
    n = len(text)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kind = _small(n + 1)
    rising, run = _rising(text), _runs(text)
    starts = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    if rising[0] and text[0] == 0:
        starts = np.append(0, starts)
    order = starts[_sorted_starts(text, starts, True, folder, memory_rows)].astype(kind)
    shared = np.zeros(len(order), np.int32)
    if len(order) > 1:
        shared[1:] = common_prefix(text, order[:-1], order[1:], most)
    first = text[order]
    symbols = np.unique(text)

    # upwards: falling suffixes, bucket by bucket, each bucket before its rising starts
    sweep, queue = _Sweep(n), DiskQueue(folder, memory_rows)
    falling: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def induce(sweep: _Sweep, ranks: np.ndarray, at: np.ndarray, up: bool, symbol: int):
        """Push the suffixes one to the left that belong to this sweep; those of the same bucket are returned."""
        ok = at > 0
        left, ranks = at[ok] - 1, ranks[ok]
        mine = ~rising[left] if up else rising[left]
        left, ranks = left[mine], ranks[mine]
        same = text[left] == symbol
        queue.push(text[left[~same]], ranks[~same], left[~same])
        return ranks[same], left[same]

    def bucket(sweep: _Sweep, symbol: int, up: bool) -> tuple[np.ndarray, np.ndarray]:
        inducers, at = queue.pop(symbol)
        parts, prefixes, before = [], [], -1
        while len(at):
            shared = sweep.between(inducers, before)
            before = inducers[-1]
            ranks = sweep.add(shared)
            parts.append(at)
            prefixes.append(shared)
            inducers, at = induce(sweep, ranks, at, up, symbol)
        if not parts:
            return np.empty(0, kind), np.empty(0, np.int32)
        return np.concatenate(parts), np.concatenate(prefixes)

    bounds = np.searchsorted(first, [*symbols, symbols[-1] + 1])
    for i, symbol in enumerate(symbols.tolist()):
        at, prefixes = falling[symbol] = bucket(sweep, symbol, True)
        here = order[bounds[i] : bounds[i + 1]]
        if len(here):
            own = shared[bounds[i] : bounds[i + 1]].copy()
            own[0] = min(run[at[-1]], run[here[0]]) if len(at) else 0
            if symbol == 0:
                own[:] = 0
            induce(sweep, sweep.add(own), here, True, symbol)

    # downwards: rising suffixes, each bucket from its end, then its falling ones
    sweep, queue = _Sweep(n), DiskQueue(folder, memory_rows)
    out, lcp = np.empty(n, kind), np.zeros(n, np.int32)
    end = n
    for symbol in symbols[::-1].tolist():
        if symbol == 0:
            at, prefixes = np.flatnonzero(text == 0)[::-1].astype(kind), np.zeros(int((text == 0).sum()), np.int32)
            sweep.add(prefixes)
        else:
            at, prefixes = bucket(sweep, symbol, False)
        out[end - len(at) : end] = at[::-1]
        # prefixes[k] is shared by the k-th from the end and the one after it
        if len(at) > 1:
            lcp[end - len(at) + 1 : end] = prefixes[1:][::-1]
        border = end - len(at)
        down, own = falling.pop(symbol)
        if len(down):
            if len(at):
                lcp[border] = min(run[down[-1]], run[at[-1]])
            out[border - len(down) : border] = down
            lcp[border - len(down) + 1 : border] = own[1:]
            back = np.empty(len(down), np.int32)
            back[0] = lcp[border] if len(at) else 0
            back[1:] = own[1:][::-1]
            induce(sweep, sweep.add(back), down[::-1], False, symbol)
        end = border - len(down)
    if not separators:
        out, lcp = out[1:], lcp[1:]
        if len(lcp):
            lcp[0] = 0
    return out, lcp
