"""Near-duplicate documents by an LSH forest over MinHash signatures.

Documents with equal shingle sets are one class. Each class enters several sorted orders of its
signature; in each order a class is compared with its neighbours by longest common prefix. How
deep a prefix must be depends on the region: where few classes share the first digits all of
them are compared; in dense regions a class meets those next to it, which share the longest
prefixes, if their whole signatures allow for a link. The few strongest candidates of each class
are confirmed on full sets first; of the others only those between different components are.
Then every two classes of a dense region that are still in different components are compared:
regions are cut into blocks, and pairs of blocks that hold more than one component are tasks of
their own. Where their signatures rule out nearly all pairs, the rest become candidates; where
they do not (pages of one template just below the limit), the tasks count on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from phasewright.llm.components import connected
from phasewright.llm.text import id_key, id_of, whole
from phasewright.session import stage

WORDS = 5  # words of a shingle
TREES = 32  # sorted orders
LEAST_DEPTH = 4  # common digits that make two neighbours candidates
DEPTH = 8  # digits of an order
HASHES = TREES * LEAST_DEPTH
REGION = 9  # classes that are all compared with each other
NEAREST = 2  # rows before one in a dense region that are candidates at once
BLOCK = 2_000_000  # shingles of a block of a dense region, each class with PER_CLASS more
PER_CLASS = 1_000
PER_ROW = 4  # candidates for each row of two blocks above which they are compared on full sets
STRONGEST = (2, 4)  # candidates of a class confirmed in the first rounds
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text; empty without words.

    A-Z are lower-cased. A text with fewer words than a shingle has one: the whole sequence.
    """
    own = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    width = min(words, len(own))
    n = len(own) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = (out ^ hashed[i : i + n]) * _GOLDEN
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(own: np.ndarray, hashes: int = HASHES, seed: int = 7) -> bytes:
    """MinHash digits of a set, 16 bits each: the low bits of the least hash under each function."""
    draw = np.random.default_rng(seed)
    a = (draw.integers(0, 2**32, hashes, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
    b = draw.integers(0, 2**32, hashes, dtype=np.uint64).astype(np.uint32)[:, None]
    folded = (own ^ (own >> np.uint64(32))).astype(np.uint32)
    least = np.full(hashes, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(folded), 4096):
        least = np.minimum(least, (folded[None, i : i + 4096] * a + b).min(axis=1))
    return (least & np.uint32(0xFFFF)).astype(">u2").tobytes()


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            own = shingles(text)
            rows.append((doc_id, len(own), xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None, signature(own) if len(own) else None))
        yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "class", "digits"])


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, wanted in zip(batch["text"], batch["class"], strict=True):
            own = shingles(text)
            if xxhash.xxh3_128_digest(own.tobytes()) == wanted:
                rows.append((wanted, own.view(np.int64)))
        yield pd.DataFrame(rows, columns=["class", "hashes"])


def _common(keys: np.ndarray, trees: np.ndarray) -> np.ndarray:
    """Digits that each row shares with the row before it, 0 across trees."""
    equal = np.cumprod(keys[1:] == keys[:-1], axis=1).sum(axis=1)
    return np.concatenate([[0], np.where(trees[1:] == trees[:-1], equal, 0)])


def _walk(batches: Iterator[pd.DataFrame], least: float | None) -> Iterator[pd.DataFrame]:
    """Candidate pairs of a sorted order, its dense rows, and the first and last rows of the task.

    Without ``least``: all pairs of the regions of at most ``REGION`` rows; rows of larger ones
    are handed on as dense. With it: each row and the nearest before it, if at least that share
    of their whole signatures is equal. ``REGION`` rows are kept from one batch to the next and
    at the edges, so a region that is cut has enough rows there to be seen as dense.
    """
    back, last, first = REGION, None, True
    for batch in batches:
        if first and len(batch):
            yield _rows(batch.head(back), "edge")
            first = False
        rows = batch if last is None else pd.concat([last, batch], ignore_index=True)
        known = 0 if last is None else len(last)
        if len(rows) > 1:
            yield from _found(rows, known, least)
        last = rows.tail(back)
    if last is not None and len(last):
        yield _rows(last.tail(back), "edge")


_FOUND = "kind string, tree int, key binary, a binary, b binary, digits binary"
_COLUMNS = ["kind", "tree", "key", "a", "b", "digits"]


def _rows(rows: pd.DataFrame, kind: str) -> pd.DataFrame:
    return rows.rename(columns={"class": "a"}).assign(kind=kind, b=None)[_COLUMNS]


def _found(rows: pd.DataFrame, known: int, least: float | None) -> Iterator[pd.DataFrame]:
    n, at = len(rows), np.arange(len(rows))
    keys = np.frombuffer(b"".join(rows["key"]), ">u2").reshape(n, DEPTH)
    common = _common(keys, rows["tree"].to_numpy())
    region = np.cumsum(common < LEAST_DEPTH)
    small = np.bincount(region)[region] <= REGION
    own = rows["class"].to_numpy()
    whole_signatures = None if least is None else np.frombuffer(b"".join(rows["digits"]), ">u2").reshape(n, HASHES)
    left, right = [], []
    for lag in range(1, min(REGION if least is None else NEAREST + 1, n)):
        i = at[lag:]
        i = i[(i >= known) & (np.minimum.reduce([common[i - k] for k in range(lag)]) >= LEAST_DEPTH)]
        if least is None:
            i = i[small[i]]
        else:
            i = i[(whole_signatures[i] == whole_signatures[i - lag]).mean(axis=1) >= least]
        left.append(own[i - lag])
        right.append(own[i])
    yield _pairs(np.concatenate(left), np.concatenate(right))
    if least is None:
        yield _rows(rows[~small], "dense")


def _pairs(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    swap = np.array([x > y for x, y in zip(a, b, strict=True)], bool)
    pairs = pd.DataFrame({"a": np.where(swap, b, a), "b": np.where(swap, a, b)}, dtype=object).drop_duplicates()
    return pairs.assign(kind="pair", tree=0, key=None, digits=None)[_COLUMNS]


_CELL = ["tree", "prefix", "i", "j"]


def _placed(rooted: DataFrame) -> DataFrame:
    """Rows of the dense regions that hold several components, with their blocks.

    Small components share blocks; one larger than a block has several.
    """
    region = ["tree", "prefix"]
    own = stage(rooted.groupBy(*region, "root").agg(F.sum(F.col("n_shingles") + PER_CLASS).alias("own")), "own")
    sizes = own.groupBy(*region).agg(F.sum("own").alias("all"), F.count("*").alias("roots")).where("roots > 1")
    group = F.pmod(F.xxhash64("root"), F.ceil(F.col("all") / BLOCK))
    cuts = stage(own.join(sizes, region).select(*region, "root", group.alias("group"), F.ceil(F.col("own") / BLOCK).alias("parts")), "cuts")
    block = F.shiftleft("group", 24) + F.pmod(F.xxhash64("class"), F.col("parts"))
    return stage(rooted.join(cuts, [*region, "root"]).select(*region, block.alias("block"), "class", "root", "digits"), "placed")


def _cells(placed: DataFrame) -> DataFrame:
    """Pairs of blocks of one region that hold more than one component."""
    blocks = stage(placed.groupBy("tree", "prefix", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi")), "blocks")
    other = blocks.select("tree", "prefix", F.col("block").alias("j"), F.col("lo").alias("lo_j"), F.col("hi").alias("hi_j"))
    several = "block <= j AND (lo <> hi OR lo_j <> hi_j OR lo <> lo_j)"
    return blocks.withColumnRenamed("block", "i").join(other, ["tree", "prefix"]).where(several.replace("block", "i")).select(*_CELL)


def _in_cells(placed: DataFrame, cells: DataFrame) -> DataFrame:
    sides = cells.withColumn("block", F.col("i")).union(cells.where("i <> j").withColumn("block", F.col("j")))
    return placed.join(sides, ["tree", "prefix", "block"])


def _alike(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Pairs of two blocks whose signatures allow for a link, or the blocks themselves if these are too many.

    A pair counts in the first order in which its classes share a region.
    """
    tree, prefix, i, j = rows.loc[0, _CELL]
    left, right = (rows[rows["block"] == block] for block in (i, j))
    x, y = (np.frombuffer(b"".join(side["digits"]), ">u2").astype(np.uint16).reshape(-1, HASHES) for side in (left, right))
    roots = pd.factorize(rows["root"])[0]
    rx, ry = (roots[rows["block"] == block] for block in (i, j))
    step, found, n = max(1, (1 << 24) // (len(y) * HASHES)), [], 0
    for at in range(0, len(x), step):
        equal = x[at : at + step, None, :] == y[None, :, :]
        good = (equal.sum(axis=2) >= least * HASHES) & (rx[at : at + step, None] != ry[None, :])
        a, b = np.nonzero(good)
        before = equal[a, b].reshape(len(a), TREES, LEAST_DEPTH)[:, :tree].all(axis=2).any(axis=1)
        a, b = a[~before] + at, b[~before]
        if i == j:
            a, b = a[a < b], b[a < b]
        found.append((a, b))
        n += len(a)
        if n > PER_ROW * len(rows):
            return pd.DataFrame([("cell", tree, prefix, i, j, None, None)], columns=["kind", *_CELL, "a", "b"])
    a, b = (np.concatenate(ends) for ends in zip(*found, strict=True))
    pairs = _pairs(left["class"].to_numpy()[a], right["class"].to_numpy()[b])[["a", "b"]]
    return pairs.assign(kind="pair", tree=0, prefix=None, i=0, j=0)[["kind", *_CELL, "a", "b"]]


def _shared(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Size of the intersection of every set of ``left`` with every one of ``right``."""
    flat = [np.concatenate(sets) for sets in (left, right)]
    common = np.intersect1d(*flat)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(common):
        return out
    held = []
    for sets, values in zip((left, right), flat, strict=True):
        at = np.minimum(np.searchsorted(common, values), len(common) - 1)
        hit = common[at] == values
        row, at = np.repeat(np.arange(len(sets)), [len(own) for own in sets])[hit], at[hit]
        order = np.argsort(at, kind="stable")
        held.append((row[order], at[order]))
    for begin in range(0, len(common), columns):
        sides = []
        for n, (row, at) in zip(out.shape, held, strict=True):
            part = slice(*np.searchsorted(at, [begin, begin + columns]))
            side = np.zeros((n, min(columns, len(common) - begin)), np.float32)
            side[row[part], at[part] - begin] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _linked(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between components of two blocks, as many as join what any link joins."""
    i, j = rows.loc[0, ["i", "j"]]
    at = [np.flatnonzero(rows["block"] == block) for block in (i, j)]
    sets = rows["hashes"].tolist()
    x, y = ([sets[k] for k in side] for side in at)
    n = _shared(x, y).astype(np.int64)
    both = np.array([len(own) for own in x])[:, None] + np.array([len(own) for own in y])[None, :]
    good = n * 100 >= (both - n) * percent
    root, own, links = pd.factorize(rows["root"])[0], rows["class"].to_numpy(), []
    for k, row in zip(at[0], good, strict=True):
        others = at[1][row]
        others = others[root[others] != root[k]]
        for other in others[np.unique(root[others], return_index=True)[1]]:
            links.append((own[k], own[other]))
            root[root == root[other]] = root[k]
    return pd.DataFrame(links, columns=["a", "b"], dtype=object)


def _across(rooted: DataFrame, sets: DataFrame, least: float, percent: int) -> tuple[DataFrame, DataFrame]:
    """Candidates and links between different components of the dense regions."""
    placed = _placed(rooted)
    alike = lambda rows: _alike(rows, least)
    linked = lambda rows: _linked(rows, percent)
    schema = "kind string, tree int, prefix binary, i long, j long, a binary, b binary"
    found = stage(_in_cells(placed, _cells(placed)).groupBy(*_CELL).applyInPandas(alike, schema), "across")
    full = _in_cells(placed.drop("digits"), found.where("kind = 'cell'").select(*_CELL)).join(sets, "class")
    links = full.groupBy(*_CELL).applyInPandas(linked, "a binary, b binary").distinct()
    return found.where("kind = 'pair'").select("a", "b"), stage(links, "links")


def _neighbours(ordered: DataFrame, least: float | None, name: str) -> DataFrame:
    """Pairs (and dense rows) of the sorted orders. Ranges of an order meet at their edges in a
    table of at most 2 x 9 rows for each task, which is walked in turn."""
    walk = lambda batches: _walk(batches, least)
    sort = ["tree", "key", "class"]
    ranged = ordered.repartitionByRange(*sort).sortWithinPartitions(*sort)
    found = stage(ranged.mapInPandas(walk, _FOUND), name)
    edges = found.where("kind = 'edge'").select("tree", "key", F.col("a").alias("class"), "digits").distinct()
    meeting = edges.coalesce(1).sortWithinPartitions(*sort).mapInPandas(walk, _FOUND)
    return found.union(meeting).where("kind <> 'edge'")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("class").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("class").alias("b"), F.col("hashes").alias("hb"))
    shared = F.size(F.array_intersect("ha", "hb"))
    sized = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", shared.alias("n"), (F.size("ha") + F.size("hb")).alias("both"))
    return sized.where(F.col("n") * 100 >= (F.col("both") - F.col("n")) * percent).select("a", "b")


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    ra, rb = roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    return pairs.join(ra, "a", "left").join(rb, "b", "left").where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).drop("ra", "rb")


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Texts are linked if their sets of 5-word shingles have 100 * intersection >= percent * union.
    ``component_id`` is the smallest id reachable over links, ``kept`` marks the rows with that id.

    A text without words (null, empty, white space) has no shingles and is linked with nothing.
    Rows with equal ids are one document with several texts. A null id is never the smallest; a
    component of null ids has a null one and its rows are kept.
    Two texts at exactly 85 % miss each other's region in all 32 orders with probability 5e-11;
    in dense regions their signatures are 6 standard deviations too different with 1e-8.
    """
    rows = docs.select(id_key(F.col(id_col)).alias("doc_id"), whole(F.col(text_col)).alias("text"))
    signed = rows.mapInPandas(_signed, "doc_id long, n_shingles long, class binary, digits binary")
    signed = stage(signed.withColumn("doc_id", id_of(F.col("doc_id"))), "signed")
    classes = signed.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first_id"), F.min("digits").alias("digits"), F.min("n_shingles").alias("n_shingles"))
    part = lambda digit, t: F.substring(F.col("digits"), (digit % HASHES) * 2 + 1, F.lit(2 * LEAST_DEPTH))
    t = F.col("tree")
    none = F.lit(None).cast("binary")
    ordered = classes.select("class", "digits", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).select(
        "tree", F.concat(part(t * LEAST_DEPTH, t), part(t * LEAST_DEPTH + HASHES // 2, t)).alias("key"), "class", none.alias("digits"))
    found = _neighbours(ordered, None, "forest")
    # in dense regions whole signatures tell which neighbours are worth confirming at once: 4.5 standard deviations below the limit
    share = percent / 100
    deviation = (share * (1 - share) / HASHES) ** 0.5
    dense = found.where("kind = 'dense'").select("tree", "key", F.col("a").alias("class")).distinct().join(classes.select("class", "digits", "n_shingles"), "class")
    dense = stage(dense.select("tree", "key", "class", "digits", "n_shingles"), "dense")
    nearest = _neighbours(dense.drop("n_shingles"), share - 4.5 * deviation, "nearest")
    pairs = found.where("kind = 'pair'").select("a", "b").union(nearest.where("kind = 'pair'").select("a", "b"))
    counted = stage(pairs.groupBy("a", "b").agg(F.count("*").alias("n")), "candidates")

    wanted = counted.select(F.col("a").alias("class")).union(counted.select(F.col("b").alias("class"))).union(dense.select("class")).distinct()
    first = classes.join(wanted, "class", "left_semi").select("class", id_key(F.col("first_id")).alias("doc_id"))
    texts = rows.join(first, "doc_id").select("text", "class")
    sets = texts.mapInPandas(_sets, "class binary, hashes array<bigint>").groupBy("class").agg(F.first("hashes").alias("hashes"))
    sets = stage(sets, "sets")

    # strongest candidates first: what they join needs no further pairs
    links, tried, roots = None, None, None
    for strongest in STRONGEST:
        left = counted if tried is None else _between(counted, roots).join(tried, ["a", "b"], "left_anti")
        # a class has at most 2 x 8 candidates in each order, which bounds the windows
        ends = left.select(F.col("a").alias("class"), "a", "b", "n").union(left.select(F.col("b").alias("class"), "a", "b", "n"))
        place = F.row_number().over(W.partitionBy("class").orderBy(F.desc("n"), "a", "b"))
        picked = stage(ends.withColumn("_place", place).where(F.col("_place") <= strongest).select("a", "b").distinct(), "picked")
        tried = picked if tried is None else tried.union(picked)
        new = stage(_confirm(picked, sets, percent), "links")
        links = new if links is None else links.union(new)
        roots = connected(links)

    prefix = F.substring("key", 1, 2 * LEAST_DEPTH)
    rooted = dense.join(roots, dense["class"] == roots["node"], "left")
    rooted = stage(rooted.select("tree", prefix.alias("prefix"), "class", "digits", "n_shingles", F.coalesce("root", "class").alias("root")), "rooted")
    across, joined = _across(rooted, sets, share - 6 * deviation, percent)
    late = _between(counted.select("a", "b").union(across).distinct(), roots).join(tried, ["a", "b"], "left_anti")
    roots = connected(links.union(joined).union(stage(_confirm(late, sets, percent), "links")))

    placed = classes.select("class", "first_id").join(roots, classes["class"] == roots["node"], "left").select("class", "first_id", F.coalesce("root", "class").alias("root"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = placed.join(least, "root").select("class", "component_id")
    out = signed.join(labels, "class", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near duplicates, the one with the smallest id."""
    kept = near_duplicates(docs, percent, id_col, text_col).where("kept").select(id_key(F.col("doc_id")).alias("_kept")).distinct()
    return docs.join(kept, id_key(docs[id_col]) == kept["_kept"], "left_semi")
