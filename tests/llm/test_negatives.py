"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from netsift.llm import negatives, queries

from ..conftest import SMALL

SCHEMA = "vec_id long, label int, vector array<double>"


def brute(rows, anchor, k=5, n=3, low=50, high=95):
    good = [(i, c, [math.floor(256 * x) for x in v]) for i, c, v in rows if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, c, v in good:
        if not anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, u)), j, d) for j, d, u in good if j != i)
        for ps, p, d in [s for s in scored if s[2] == c][:k]:
            window = [s for s in scored if s[2] != c and low * -ps <= 100 * -s[0] <= high * -ps][:n]
            out += [(i, p, r + 1, j, -ps, -s) for r, (s, j, _) in enumerate(window)]
    return sorted(out)


def mined(spark, rows, step=5, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("w", "i", "score", "rank", "n")}).repartition(3)
    return sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % step == 0, **options).collect())


def vectors(rng, n, dims=12, labels=3, spread=1.0):
    return [(i, rng.randrange(labels), [rng.gauss(0, spread) / (1 + d) for d in range(dims)]) for i in range(n)]


def test_the_query_equals_brute_force(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in queries.op13_hard_negatives(spark, SMALL).collect())
    assert got == brute(rows, lambda i: i % 50 == 0) and got


def test_sql(spark, duck):
    wanted = duck.sql(queries.ORACLE_SQL["op13_hard_negatives"])
    got = queries.op13_hard_negatives(spark, SMALL)
    assert sorted(wanted.columns) == sorted(got.columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(wanted.fetchall())


@pytest.mark.parametrize("seed", range(3))
def test_families_of_copies_and_ties(spark, seed):
    """Two thirds of the rows are copies of three vectors, in coarse steps so that scores tie."""
    rng = random.Random(seed)
    base = [[rng.randrange(-3, 4) / 4 for _ in range(8)] for _ in range(3)]
    rows = [(i, rng.randrange(3), base[i % 3] if i % 3 else [rng.randrange(-3, 4) / 4 for _ in range(8)]) for i in range(400)]
    assert mined(spark, rows, 20) == brute(rows, lambda i: i % 20 == 0)


def test_several_passes_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(negatives, "PASS_ANCHORS", 7)
    monkeypatch.setattr(negatives, "CELLS", 200)
    rows = vectors(random.Random(5), 120)
    got = mined(spark, rows, 6, n_positives=2, n_negatives=4, low=20, high=90)
    assert got == brute(rows, lambda i: i % 6 == 0, 2, 4, 20, 90) and len({r[0] for r in got}) > 7


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = vectors(rng, 40)
    rows += [(100, None, [1.0] * 12), (105, 1, None), (110, 1, [1.0, None]), (115, 1, [float("nan")] * 12), (120, 1, [float("inf")]), (None, 1, [1.0] * 12), (125, 1, []), (130, 2, [0.5, 0.25]), (135, 9, [1.0] * 12), (140, 1, [2.0] * 14), (145, 1, [0.0] * 12), (150, 0, [-1.0] * 12), (155, 2, [1e6] * 12), (156, 2, [1e5] * 12), (157, 1, [7e4] * 12), (158, 1, [9e5] * 11)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_repeated_rows_each_take_part(spark):
    rows = vectors(random.Random(2), 60)
    assert mined(spark, rows + rows[:30]) == brute(rows + rows[:30], lambda i: i % 5 == 0)


@pytest.mark.parametrize("rows", [[], [(0, 1, [1.0])], [(0, 1, [1.0]), (1, 1, [1.0])], [(0, 1, [1.0]), (1, 2, [1.0])], [(0, 1, []), (1, 1, []), (2, 2, [])]])
def test_few_rows(spark, rows):
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


@pytest.mark.parametrize("seed", range(20))
def test_pairs_over_thresholds(seed):
    """The indexed join finds the pairs that all products find, whatever the thresholds."""
    rng = np.random.default_rng(seed)
    scale = 10.0 ** rng.integers(0, 5)
    a, x = (np.floor(scale * rng.normal(size=(n, 16)) / (1 + np.arange(16)) ** rng.integers(0, 3)) for n in (9, 300))
    block = negatives.Block(np.arange(9), ["a"] * 9, a)
    scores = (block.vectors @ x[:, block.order].T).astype(np.int64)
    least = np.quantile(scores, rng.uniform(0.3, 1, 9), axis=1).diagonal().copy()
    least[0], least[1] = np.inf, -np.inf
    ai, xi, got = negatives.pairs_over(block, x[:, block.order], least)
    assert sorted(zip(ai, xi, got)) == sorted((i, j, scores[i, j]) for i in range(9) for j in range(300) if scores[i, j] >= least[i])


def test_scores_beyond_64_bits_are_cut_off(spark):
    rows = [(0, 1, [1e12] * 2), (1, 1, [1e12] * 2), (2, 2, [1e8] * 2), (3, 2, [1.0] * 2)]
    assert [r[4] for r in mined(spark, rows, low=0)] == [2**63 - 1]
