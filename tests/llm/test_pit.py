"""op12 against plain Python: trees, stretches over many chunks, skewed and odd tables."""

import random

import numpy as np
import pytest

from tidegrain.llm import pit


def brute(questions, versions):
    out = []
    for source, at, n in questions:
        able = [(e, a, i, p or "", s) for s, e, a, x, i, p in versions if s is not None and s == source and None not in (e, a, x, at) and e <= at and a <= at < x]
        best = max(able, default=None)
        out.append((source, at, n, *(best[:3] + (best[3] or None,) if best else (None,) * 4)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,most,longest", [(1, 2, 9), (2, 8, 400), (3, 10_000, 60), (4, 1, 5000)])
def test_join_equals_brute_force(spark, seed, most, longest):
    r = random.Random(seed)
    versions = []
    for i in range(300):
        e = r.randint(-500, 1500)
        versions.append((r.choice(["a", "a", "a", "b", "", None]), e, e + r.randint(-5, 20), e + r.randint(-3, longest), r.randint(0, 250), r.choice(["x", "y", None])))
    versions += versions[:20] + [("a", None, 1, 5, 900, "x"), ("a", 7, None, 50, 901, "x"), ("a", 7, 7, None, 902, "x"), ("a", 10, 10, 900, None, "z")]
    versions = [v for v in versions if v[4] is not None]
    questions = [(r.choice(["a", "a", "b", "", "c", None]), r.choice([None, *range(-600, 1700, 7)]), i) for i in range(400)] + [("a", 10, 1000), ("a", 10, 1000)]
    q = spark.createDataFrame(questions, "source string, at long, n int")
    v = spark.createDataFrame(versions, "source string, event long, arrival long, expiry long, id long, p string")
    got = pit.join(q, v, ["p"], most=most).select("source", "at", "n", "event", "arrival", "id", "p").collect()
    assert sorted(map(tuple, got), key=str) == brute(questions, versions)


def test_trees_give_every_stabbed_interval(monkeypatch):
    monkeypatch.setattr(pit, "FRONTIER", 50)
    rng = np.random.default_rng(1)
    sizes = [0, 1, 2, 37, 400]
    start = np.concatenate([np.sort(rng.integers(0, 100, n)) for n in sizes])
    end = start + rng.integers(1, 40, len(start))
    hi = np.cumsum(sizes)
    lo = hi - sizes
    top = pit.tops(end, lo[1:], hi[1:])
    tree, at = rng.integers(0, len(sizes), 500), rng.integers(-5, 150, 500)
    got = sorted((int(a), int(b)) for q, i in pit.stab(start, end, top, at, lo[tree], hi[tree]) for a, b in zip(q, i, strict=True))
    assert got == [(q, i) for q in range(500) for i in range(lo[tree[q]], hi[tree[q]]) if start[i] <= at[q] < end[i]]


def test_one_source_and_one_time_for_all(spark):
    """No width of chunks parts them: chunks of one unit have no tree."""
    v = spark.range(5000).selectExpr("'s' source", "10 event", "10L + id % 3 arrival", "10L + id % 50 expiry", "id")
    v = v.select("source", *[v[c].cast("long") for c in ("event", "arrival", "expiry", "id")])
    q = spark.range(80).selectExpr("'s' source", "id at")
    got = {r["at"]: (r["arrival"], r["id"]) for r in pit.join(q, v, most=20).collect()}
    for t in range(80):
        assert got[t] == max(((10 + i % 3, i) for i in range(5000) if 10 + i % 3 <= t < 10 + i % 50), default=(None, None))


def test_empty_and_odd_tables(spark):
    q, v = spark.createDataFrame([], "source string, at long"), spark.createDataFrame([], "source string, event long, arrival long, expiry long, id long")
    assert pit.join(q, v).collect() == []
    assert [r["id"] for r in pit.join(spark.createDataFrame([("a", 1)], q.schema), v).collect()] == [None]
    docs = spark.createDataFrame([(1, None, "en", "s", 3, 0), (None, "x", None, "s", None, 0), (2, "", "no", None, 1, 0)], "doc_id long, text string, lang string, source string, n_chars long, `a.b` int")
    got = pit.features(docs, spark.createDataFrame([(1, 1), (2, 1), (3, 0), (None, 1), (1, 0)], "doc_id long, quality int")).collect()
    assert len(got) == 5 and {r["status"] for r in got} <= {"none", "stale", "fresh"}
