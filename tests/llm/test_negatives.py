"""op13 against plain Python: ties, several digits, bounds, odd tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrain.llm import negatives as ng

KIND = "vec_id long, label int, embedding array<double>, v string, `a.b` int"


def brute(rows, is_anchor, positives=5, negatives=3, least=50, most=95):
    able = {}
    for i, label, e in sorted((r for r in rows if r[0] is not None and r[1] is not None and r[2] and all(x is not None and math.isfinite(x) for x in r[2])), key=str):
        v = [math.floor(256 * x) for x in e]
        if sum(x * x for x in v) < ng.LENGTH:
            able[i] = min(able.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in able.items():
        if is_anchor(a):
            s = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, (m, w) in able.items() if i != a and len(w) == len(v))
            for ps, p, _ in [x for x in s if x[2] == label][:positives]:
                fit = [x for x in s if x[2] != label and least * -ps <= 100 * -x[0] <= most * -ps][:negatives]
                out += [(a, p, r + 1, n, -ps, -ns) for r, (ns, n, _) in enumerate(fit)]
    return sorted(out)


def vectors(seed, n, dim, size=1.0):
    r = random.Random(seed)
    e = [[r.gauss(0, size) for _ in range(dim)] for _ in range(12)]
    rows = [(i, r.randrange(4), [x + r.choice([0, 0, r.gauss(0, size / 5)]) for x in r.choice(e)]) for i in range(n)]
    odd = [(900, 1, None), (901, None, e[0]), (902, 1, [None] + e[0][1:]), (903, 1, [math.nan] + e[0][1:]), (904, 2, [math.inf] + e[0][1:]), (905, 1, []), (906, 2, e[0][:-1]), (None, 1, e[0]), (907, 1, [0.0] * dim), (908, 1, [1e30] * dim)]
    return rows + rows[:5] + [(3, 0, e[1])] + odd


@pytest.mark.parametrize("seed,dim,size,bits", [(1, 3, 1.0, 9), (2, 5, 0.02, 3), (3, 2, 400_000.0, 9)])
def test_mine_equals_brute_force(spark, monkeypatch, seed, dim, size, bits):
    monkeypatch.setattr(ng, "BITS", bits)
    monkeypatch.setattr(ng, "ANCHORS", 10)
    monkeypatch.setattr(ng, "ROWS", 37)
    rows = vectors(seed, 120, dim, size)
    df = spark.createDataFrame([(*x, "x", 0) for x in rows], KIND)
    want = brute(rows, lambda i: i % 5 == 0)
    assert sorted(map(tuple, ng.mine(df, F.col("vec_id") % 5 == 0).collect())) == want and want


def test_ties_go_to_small_ids(spark, monkeypatch):
    monkeypatch.setattr(ng, "ROWS", 50)
    rows = [(i, i % 2, [1.0, 0.5] if i % 3 else [1.0, 0.0]) for i in range(400)]
    want = brute(rows, lambda i: i in (0, 7))
    got = ng.mine(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"), F.col("vec_id").isin(0, 7)).collect()
    assert sorted(map(tuple, got)) == want and want


def test_few_rows_and_empty_tables(spark):
    kind = "vec_id long, label int, embedding array<float>"
    assert ng.mine(spark.createDataFrame([], kind), F.col("vec_id") % 5 == 0).collect() == []
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.75, 0.0])]
    got = ng.mine(spark.createDataFrame(rows, kind), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 65536, 49152)]
    assert ng.mine(spark.createDataFrame(rows[:1], kind), F.col("vec_id") == 0).collect() == []


def test_counts_reach_down_to_the_kth_digit():
    d, n = ng.top_counts(np.array([5, 1, 9, 9, 7, 7, 7, 0]), 3)
    assert dict(zip(d.tolist(), n.tolist())) == {7: 3, 9: 2}
