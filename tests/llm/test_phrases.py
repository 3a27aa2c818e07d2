"""op11 against plain Python: exact places, proximity, and odd tables."""

import hashlib
import random
import re

import pytest

from tidegrain.llm import phrases as ph

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans(ph.UPPER, ph.LOWER)


def words(text):
    return WORD.findall((text or "").translate(LOW))


def wins(w, n):
    return [(i, tuple(w[i : i + n])) for i in range(max(1, len(w) - n + 1))] if w else []


def brute(docs, tests, n):
    out = []
    for d, text in docs:
        w = words(text)
        hit, items = set(), set()
        for item, t in tests:
            for _, x in wins(words(t), n):
                for i in range(len(w) - len(x) + 1):
                    if tuple(w[i : i + len(x)]) == x:
                        hit |= set(range(i, i + len(x)))
                        items |= {str(item)} - {"None"}
        out.append((d, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def corpus(seed, n_docs=60, vocabulary=9):
    r = random.Random(seed)
    some = lambda n: " ".join(r.choice("aA b C d É ñ x1 9 zz".split()[:vocabulary]) + r.choice(["", ",", " --"]) for _ in range(n))
    tests = [(i, some(r.randint(1, 9))) for i in range(12)] + [(3, some(5)), (None, some(2)), (40, ""), (41, None), (42, "..")]
    docs = [(i, some(r.randint(0, 40))) for i in range(n_docs)] + [(5, "a b c"), (None, "a b"), (7, None), (8, ""), (9, "," + tests[0][1] * 3)]
    return docs + docs[:2], tests


@pytest.mark.parametrize("seed,n,vocabulary", [(1, 4, 9), (2, 3, 2), (3, 1, 9)])
def test_contamination_equals_brute_force(spark, monkeypatch, seed, n, vocabulary):
    if seed == 2:  # the ways beyond what may be broadcast
        monkeypatch.setattr(ph, "BROADCAST", 0)
        monkeypatch.setattr(ph, "BLOCK", 4)
    docs, tests = corpus(seed, vocabulary=vocabulary)
    d = spark.createDataFrame([(*x, 1, "t") for x in docs], "doc_id long, text string, k int, `a.b` string")
    got = ph.contamination(d, spark.createDataFrame(tests, "item_id long, text string"), n).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, tests, n)


def test_index_of_all_words_serves_any_phrase(spark):
    docs, _ = corpus(4)
    d = spark.createDataFrame([(i, t or "") for i, (_, t) in enumerate(docs)], "k long, text string")
    index = ph.build(d)
    assert sorted(map(tuple, index.postings.join(index.terms, "t").select("word", "k", "pos").collect())) == sorted((w, i, p) for i, (_, t) in enumerate(docs) for p, w in enumerate(words(t)))
    asked = [(1, ["a", "b"]), (2, ["c", "a", "c"]), (3, ["nowhere", "a"]), (4, ["zz"])]
    got = ph.phrases(index, spark.createDataFrame(asked, "win long, words array<string>")).collect()
    want = [(n, i, s, len(x)) for n, x in asked for i, (_, t) in enumerate(docs) for s in range(len(words(t))) if words(t)[s : s + len(x)] == x]
    assert sorted(map(tuple, got)) == sorted(want) and want


@pytest.mark.parametrize("span", [3, 7])
def test_proximity_equals_brute_force(spark, span):
    docs, _ = corpus(5)
    index = ph.build(spark.createDataFrame([(i, t or "") for i, (_, t) in enumerate(docs)], "k long, text string"))
    asked = [(1, ["a", "ñ"]), (2, ["c", "a", "c", "zz"]), (3, ["nowhere"]), (4, ["9"])]
    want = set()
    for n, x in asked:
        for i, (_, t) in enumerate(docs):
            w = words(t)
            for lo in range(len(w)):
                hi = next((h for h in range(lo, min(len(w), lo + span)) if set(x) <= set(w[lo : h + 1])), None)
                if w[lo] in x and hi is not None:
                    want.add((n, i, lo, hi))
    assert {tuple(r) for r in ph.near(index, spark.createDataFrame(asked, "win long, words array<string>"), span).collect()} == want and want


def test_empty_tables(spark):
    d, t = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert ph.contamination(d, t).collect() == []
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert ph.contamination(d, spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []
    assert [tuple(r)[:4] for r in ph.contamination(some, t).collect()] == [(1, 2, 0, 0)]


def test_native(spark):
    docs, tests = corpus(6, 5)
    df = ph.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string"), 3)
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())
