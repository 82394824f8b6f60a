"""Exact duplicates, hard negatives and vector codes: parts against plain arithmetic, operators against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import connect, oracle_rows, rows_of
from phasewright.llm import codes, exact, negatives, vectors

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, row long, anchor string, comps int, positives int, slice int, block int, code int, error int"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_exact_dedup", "op13_vector_codes"])
def test_query_equals_its_sql(spark, name):
    got = rows_of(entry.queries()[name](spark, SMALL))
    assert got == oracle_rows(connect(SMALL), entry.oracle_sql()[name])


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (64, 64, 64), (65, 33, 70), (130, 64, 201), (40, 1, 90)])
def test_strassen_is_exact(shape):
    draw = np.random.default_rng(sum(shape))
    n, k, m = shape
    a, b = draw.integers(-(2**28), 2**28, (n, k)), draw.integers(-(2**28), 2**28, (k, m))
    assert (negatives.strassen(a, b, leaf=4) == a @ b).all()
    assert negatives.strassen(np.zeros((0, 3), np.int64), np.zeros((3, 2), np.int64)).shape == (0, 2)


@pytest.mark.parametrize("size", [1, 2, 8, 16, 64])
def test_transform_keeps_scaled_distances_in_sequency_order(size):
    rows = codes.walsh_hadamard(np.eye(size, dtype=np.int64)).T  # row s is the s-th Walsh function
    assert [int((row[1:] != row[:-1]).sum()) for row in rows] == list(range(size))
    draw = np.random.default_rng(size)
    x = draw.integers(-999, 999, (2, max(1, size - 1)))
    y = codes.walsh_hadamard(x)
    padded = y.shape[1]
    assert ((y[0] - y[1]) ** 2).sum() == padded * ((x[0] - x[1]) ** 2).sum()


@pytest.mark.parametrize("width,step", [(1, 4), (3, 1), (16, 4), (20, 8)])
def test_nearest_entry_with_ties_and_early_ends(width, step):
    draw = np.random.default_rng(width)
    parts, entries = draw.integers(-3, 3, (5000, width)), draw.integers(-3, 3, (40, width))
    entries[7] = entries[30]
    index, error, compared = codes.nearest(codes.walsh_hadamard(parts), codes.walsh_hadamard(entries), step)
    every = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all() and (error == every.min(axis=1)).all()
    assert compared <= every.size * codes.walsh_hadamard(parts[:1]).shape[1]


def test_low_sequencies_settle_most_entries_of_smooth_parts():
    draw = np.random.default_rng(3)
    parts, entries = draw.integers(-3, 4, (3000, 16)).cumsum(axis=1), draw.integers(-3, 4, (64, 16)).cumsum(axis=1)
    index, _, compared = codes.nearest(codes.walsh_hadamard(parts), codes.walsh_hadamard(entries))
    every = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all() and compared < 0.4 * every.size * 16


def odd_vectors(spark):
    draw = random.Random(11)
    rows = [(i * 10, [draw.uniform(-1, 1) for _ in range(8)], i % 3) for i in range(200)]
    rows += [rows[0], rows[10], (None, rows[0][1], 1), (None, rows[3][1], 0), (100, rows[5][1], 2), (5, rows[0][1], 0), (6, rows[0][1], 0)]
    rows += [(7, None, 1), (8, [1.0, None] * 4, 1), (9, [float("nan")] * 8, 1), (11, [float("inf")] * 8, 1), (12, rows[4][1], None), (300, [0.0] * 8, 1)]
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4, 5, 6, 7) for r in rows], VECTORS), rows


def fine(vector):
    return vector is not None and all(x is not None and abs(x) < float("inf") for x in vector)


def brute_negatives(rows):
    kept = [(i, label, [int(np.floor(256 * x)) for x in v], n) for n, (i, v, label) in enumerate(rows) if fine(v) and label is not None]
    out = Counter()
    for i, label, own, n in kept:
        if i is None or i % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(own, c)), j is None, j or 0, other, m) for j, other, c, m in kept if m != n), key=lambda x: x[:3])
        for score, none, j, _, _ in [x for x in scored if x[3] == label][:5]:
            fit = [x for x in scored if x[3] != label and 30 * -score <= 100 * -x[0] <= 90 * -score][:10]
            out.update((i, None if none else j, rank, None if x[1] else x[2], -score, -x[0]) for rank, x in enumerate(fit, 1))
    return out


@pytest.mark.parametrize("tile", [(2048, 8192), (5, 40)])
def test_hard_negatives_equal_all_pairs(spark, tile):
    table, rows = odd_vectors(spark)
    got = Counter(tuple(r) for r in negatives.mine(table.repartition(3), slice_anchors=tile[0], block_rows=tile[1]).collect())
    assert got == brute_negatives(rows) and len(got) > 300


def test_hard_negatives_of_a_label_with_most_rows_and_one_repeated_vector(spark):
    draw = random.Random(12)
    same = [draw.uniform(0, 1) for _ in range(5)]
    rows = [(i, same if i % 3 else [draw.uniform(0, 1) for _ in range(5)], 1 if i % 4 else i % 7) for i in range(2500)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = Counter(tuple(r) for r in negatives.mine(table, slice_anchors=10, block_rows=700).collect())
    assert got == brute_negatives(rows)


def test_hard_negatives_of_nothing_and_of_too_large_components(spark):
    table, _ = odd_vectors(spark)
    assert negatives.mine(table.limit(0)).count() == negatives.mine(table.where("vec_id % 100 <> 0")).count() == negatives.mine(table.where("label IS NULL")).count() == 0
    with pytest.raises(ValueError):
        negatives.mine(table.withColumn("embedding", F.transform("embedding", lambda x: x * 1e12)))


def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = sorted((r[0] is None, r[0] or 0, [int(np.floor(1024 * x)) for x in r[1]], r[2]) for r in rows if fine(r[1]))
    whole = np.array([r[2] for r in kept])
    width = whole.shape[1] // parts
    books, index, error = [], [], 0
    for p in range(parts):
        own = whole[:, p * width : (p + 1) * width]
        book = own[:entries].copy()
        for _ in range(rounds):
            near = ((own[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
            book = np.array([own[near == e].sum(axis=0) // (near == e).sum() if (near == e).any() else book[e] for e in range(len(book))])
        every = ((own[:, None] - book[None]) ** 2).sum(axis=2)
        index.append(every.argmin(axis=1))
        error = error + every.min(axis=1)
        books.append(book)
    digest = hashlib.sha256(",".join(str(int(x)) for x in np.array(books).ravel()).encode()).hexdigest()
    by_label = defaultdict(int)
    for (_, _, _, label), e in zip(kept, error):
        by_label[label] += int(e)
    return Counter((None if none else i, "".join(f"{x[n]:02x}" for x in index), int(error[n]), by_label[label], digest) for n, (none, i, _, label) in enumerate(kept))


def test_codes_equal_brute_force(spark):
    table, rows = odd_vectors(spark)
    rows = [r if len(r) == 3 else r[:3] for r in rows]
    got = Counter(tuple(r) for r in codes.compress(table.repartition(3), entries=30).collect())
    # a null label cannot be compared with a number in the brute-force sort, so it counts as -1 there
    assert got == brute_codes([(i, v, -1 if label is None else label) for i, v, label in rows], entries=30)
    assert codes.compress(table.limit(0)).count() == codes.compress(table.where("embedding IS NULL")).count() == 0
    few = codes.compress(table.where("vec_id = 20")).collect()
    assert [(r["code"], r["error"]) for r in few] == [("00000000", 0)]


def test_codes_of_uneven_lengths(spark):
    rows = [(1, [0.5] * 5, 1), (2, [0.25], None), (3, [], None), (4, [0.5] * 6, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in codes.compress(table, entries=4).collect()}
    assert len(got) == 4 and all(r["error"] == 0 for r in got.values())
    own = vectors.scaled(F.col("embedding"), 1024)
    assert [list(r[0]) for r in table.orderBy("vec_id").select(own).collect()] == [[512] * 5, [256], [], [512] * 6]


def brute_exact(rows):
    groups = defaultdict(list)
    for n, (i, text) in enumerate(rows):
        plain = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        groups[hashlib.sha256(plain.encode()).hexdigest()].append((-len(text or ""), i is None, i or 0, n))
    out = Counter()
    for digest, held in groups.items():
        best = min(held)
        out.update((None if h[1] else h[2], None if best[1] else best[2], len(held), h == best, digest) for h in held)
    return out


def test_exact_duplicates_equal_brute_force(spark):
    draw = random.Random(13)
    rows = [(i, draw.choice(["same text", "same  text ", "sametext", f"own {i}", f"twice {i // 2}", "same text", "\U0001f600 a", "\U0001f600a"])) for i in range(900)]
    rows += [(1, None), (2, ""), (3, " \n\t\x0b\x0c\r"), (None, "same text"), (None, None), (5, "long " * 50_000), (6, "long" * 50_000), (7, "SAME text"), (7, "SAME text"), (8, "SAME text")]
    table = spark.createDataFrame([(*r, 1, "d", 2, 3) for r in rows], "doc_id long, text string, row int, digest string, keep_id int, n_chars int").repartition(5)
    want = brute_exact(rows)
    for counters in (3000, 50):
        got = exact.exact_duplicates(table, counters=counters)
        assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        assert Counter(tuple(r) for r in got.collect()) == want
    kept = exact.drop_exact_duplicates(table)
    assert kept.columns == table.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(x[0] for x, n in want.items() for _ in range(n) if x[3])
    assert exact.exact_duplicates(table.limit(0)).count() == exact.drop_exact_duplicates(table.limit(0)).count() == 0


def test_rows_of_frequent_digests_are_not_shuffled(spark):
    table = spark.range(60_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("own "), "id")).alias("text"))
    hot = exact.frequent(exact._keys(table, "doc_id", "text").select("digest"))
    assert [r[0] for r in hot.collect()] == [hashlib.sha256(b"hot").hexdigest()]
    out = exact.exact_duplicates(table)
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    first = plan.split("Union")[1].split("SortMergeJoin")[0].split("ShuffledHashJoin")[0]
    assert "BroadcastHashJoin" in first and "hashpartitioning" not in first.split("BroadcastExchange")[0]
    assert {(r["group_size"], r["kept"]): r["n"] for r in out.groupBy("group_size", "kept").agg(F.count("*").alias("n")).collect()} == {(20_000, True): 1, (20_000, False): 19_999, (1, True): 40_000}
