"""Hard negatives against plain integer products of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pledgeflow.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, score string, rank string, block string"


def brute(rows, wanted, positives=5, negatives=10, low=30, high=90):
    kept = []
    for i, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((i, [math.floor(256 * x) for x in vector], label))
    order = lambda s: (-s[1], s[0] is None, s[0] or 0)
    out = []
    for n, (i, a, label) in enumerate(kept):
        if i is None or not wanted(i):
            continue
        scores = [(j, sum(x * y for x, y in zip(a, c)), of) for m, (j, c, of) in enumerate(kept) if m != n]
        alike = sorted(((j, s) for j, s, of in scores if of == label), key=order)[:positives]
        for p, ps in alike:
            near = sorted(((j, s) for j, s, of in scores if of != label and low * ps <= 100 * s <= high * ps), key=order)
            out += [(i, p, r, j, ps, s) for r, (j, s) in enumerate(near[:negatives], 1)]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SCHEMA)


def vectors(seed, n, dim, size=1.0):
    r = random.Random(seed)
    return [(i, [r.uniform(-0.2, 1) * size for _ in range(dim)], r.randrange(3)) for i in range(n)]


AWKWARD = [
    (None, [0.5] * 6, 1), (100, [0.5] * 6, 1), (100, [0.5] * 6, 1), (101, [0.5] * 6, 1), (102, None, 1), (103, [0.5] * 6, None),
    (104, [0.5, None, 0.1, 0.0, 0.0, 0.0], 0), (105, [float("nan")] * 6, 0), (106, [float("-inf")] * 6, 0), (107, [], 1),
    (110, [0.3, 0.4], 2), (120, [0.0] * 6, 0), (130, [-0.5] * 6, 2), (140, [0.25] * 6, 0), (140, [0.25] * 6, 0), (141, [0.25] * 6, 2),
]


@pytest.mark.parametrize("size", [1.0, 1e4])
def test_all_pairs(spark, monkeypatch, size):
    monkeypatch.setattr(H, "LEAST_ROWS", 40)
    monkeypatch.setattr(H, "ANCHOR_ROWS", 7)
    monkeypatch.setattr(H, "TILE", 3)
    rows = vectors(1, 150, 6, size) + AWKWARD
    made = H.mine(frame(spark, rows).repartition(3), F.col("vec_id") % 10 == 0)
    assert made.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows, lambda i: i % 10 == 0)
    assert sorted(map(tuple, made.collect()), key=str) == want and len(want) > 300


def test_a_third_of_all_rows_equal(spark, monkeypatch):
    monkeypatch.setattr(H, "LEAST_ROWS", 20)
    rows = vectors(2, 60, 4) + [(10, [0.5, 0.5, 0.1, 0.2], 1)] * 30
    made = H.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, made.collect()), key=str) == brute(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("size", [3, 200, 10**6, 10**9])
def test_products_are_exact(size):
    r = random.Random(size)
    a, c = ([[r.randint(-size, size) for _ in range(5)] for _ in range(n)] for n in (3, 11))
    want = [[sum(x * y for x, y in zip(p, q)) for q in c] for p in a]
    assert H.products(np.array(a), np.array(c)).tolist() == want
    # several candidates share an integer where the fields are narrow enough
    assert (H.EXACT_BITS // H.field_bits(5, size, size) > 1) == (size <= 200)


def test_scores_outside_64_bits_are_the_nearest_long():
    assert H.products(np.array([[1e30]]), np.array([[1e30], [-1e30], [2.0]])).tolist()[0][:2] == [(1 << 63) - 1, -(1 << 63)]
    assert H.best(np.array([5, -(1 << 63), 7, 7]), 4).tolist() == [2, 3, 0, 1]


def test_no_partners_and_empty_tables(spark):
    alone = [(10, [1.0], 1), (11, [1.0], 2)]
    for rows in ([], alone, [(i, [1.0], 1) for i in range(12)]):
        assert H.mine(frame(spark, rows), F.col("vec_id") % 10 == 0).count() == 0
