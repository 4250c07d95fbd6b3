"""Operator 11: hard negatives against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import negatives

SCHEMA = "vec_id long, label string, vector array<long>, score string, `a.b` string, row string"


def brute(rows, positives=5, k=10, low=30, high=90):
    """``rows``: (vec_id, label, vector, is_anchor); of each anchor row its result, ids None last among ties."""
    good = [r for r in rows if r[1] is not None and r[2] and all(x is not None for x in r[2])]
    out = []

    def ranked(found):
        return sorted(found, key=lambda f: (-f[0], negatives.NO_ID if f[1] is None else f[1]))

    for at, a in enumerate(good):
        if not a[3]:
            continue
        others = [(sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for n, r in enumerate(good) if n != at and len(r[2]) == len(a[2])]
        for ps, pid, _ in ranked([o for o in others if o[2] == a[1]])[:positives]:
            bad = ranked([o for o in others if o[2] != a[1] and low * ps <= 100 * o[0] <= high * ps])[:k]
            out += [(a[0], pid, n + 1, nid, ps, s) for n, (s, nid, _) in enumerate(bad)]
    return sorted(out, key=str)


def table(seed, n, dim=8, spread=40):
    rng = random.Random(seed)
    centres = [[rng.randint(-spread, spread) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        label = rng.choice(["a", "a", "a", "b", "c"])
        rows.append((i, label, [x + rng.randint(-6, 6) for x in rng.choice(centres)]))
    rows += [rows[0], rows[10], rows[10]]  # repeated rows, an anchor's too
    rows += [(n + i, rng.choice("abc"), rows[5][2]) for i in range(40)]  # ties
    rows += [(2000, "a", [0] * dim), (2010, "b", [-x for x in rows[3][2]]), (2020, "solo", rows[7][2])]
    rows += [(2030, None, rows[1][2]), (2040, "a", None), (2050, "a", []), (2060, "a", [1, None, 3]), (None, "a", rows[2][2]), (None, "b", rows[2][2])]
    rows += [(2070 + i, "ab"[i % 2], [rng.randint(-9, 9) for _ in range(3)]) for i in range(12)]  # another length
    return [(*r, r[0] is not None and r[0] % 10 == 0) for r in rows]


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r[:3], "s", "d", "w") for r in rows], SCHEMA).repartition(4)
    got = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("seed, options", [(1, {}), (2, dict(shard_rows=32, block_rows=8, codewords=4, sample_rows=50)), (3, dict(shard_rows=7, block_rows=3))])
def test_against_brute_force(spark, seed, options):
    rows = table(seed, 300)
    want = brute(rows)
    assert run(spark, rows, **options) == want and len(want) > 500


def test_large_numbers_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i, "ab"[i % 2], [rng.randint(-1 << 29, 1 << 29) for _ in range(6)], i % 10 == 0) for i in range(80)]
    assert run(spark, rows) == brute(rows)


def test_empty_and_no_anchor(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(1, "a", [1, 2], "s", "d", "w")], SCHEMA)
    assert negatives.hard_negatives(one, F.col("vec_id") % 10 == 0).count() == 0


def test_cells_come_by_bound_and_are_skipped():
    rng = np.random.default_rng(5)
    centres = rng.integers(-300, 300, (40, 16))
    x = (centres[rng.integers(0, 40, 4000)] + rng.integers(-4, 5, (4000, 16))).astype(np.int64)
    books = negatives._codebook(x[:, :8], 32), negatives._codebook(x[:, 8:], 32)
    codes = np.stack([negatives._nearest(x[:, :8].astype(float), books[0]), negatives._nearest(x[:, 8:].astype(float), books[1])], axis=1).astype(np.int32)
    cells = negatives.Cells(x, codes, np.arange(4000), np.arange(4000), books)
    a = x[17]
    seen, last = 0, float("inf")
    for bound, s, e in cells.walk(a.astype(float)):
        assert bound <= last and (cells.x[s:e] @ a <= bound + 1e-6).all()
        last, seen = bound, seen + e - s
    assert seen == 4000
    asked = []
    score = negatives._scores
    negatives._scores = lambda x, a, exact: asked.append(len(x)) or score(x, a, exact)
    try:
        got = cells.search(a, 17, [(negatives.LEAST, negatives.MOST, negatives.LEAST)], 10, batch=64)
    finally:
        negatives._scores = score
    s = np.delete(x @ a, 17)
    assert sorted(g[3] for g in got) == sorted(np.sort(s)[-10:].tolist()) and sum(asked) < 1500  # most rows are never scored
