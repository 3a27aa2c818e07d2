"""A quality classifier without given labels: heuristic labellers, their accuracies by EM, a hashed linear scorer.

Ten overlapping labellers look at a whole text and vote good (1), bad (-1) or nothing (0). All documents' votes are
counted by pattern (at most 3^10 patterns, whatever the table's size); expectation-maximisation over these counts gives
each labeller's chances of its votes for good and bad documents, and so each pattern's posterior. A logistic scorer over
hashed word shapes and text statistics is then fitted to the posteriors of a bounded sample (``SAMPLE`` distinct texts, taken
by a hash of the text, each weighed by its copies) and scores every document.

Given labels play no part in the fit; they serve to measure it. A null or empty text has no votes but "too short" and is
rejected; texts are read whole, however long; repeated rows get equal results, and count as often as they are there; an empty table gives an empty result; extra columns are
left out.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.llm.common import docs_of, mapped, tidied

#: Distinct texts that the scorer is fitted on, about so many and twice as many at most; everything else covers all documents.
SAMPLE = 6000
BITS, SEED = 12, 7
#: Signs that running text hardly has.
ODD = frozenset(b"#$%&*+<=>@[\\]^_`{|}~")


class Reader(dict):
    """Statistics and hashed features of texts; what depends on a word alone is held per word, up to a limit: the number of
    its kind, as words alike share one row of numbers."""

    LIMIT = 300_000

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.kinds: dict[tuple, int] = {}
        self.plain: dict[tuple, int] = {}  # kinds of small letters with perhaps a comma or full stop, by length and end
        self.rows = np.zeros((256, 6), np.int64)

    def __missing__(self, w: bytes) -> int:
        core = w[:-1] if w[-1:] in (b".", b",") else w
        if not core.isascii():
            core = core.decode("utf-8", "replace")
        if core.isalpha() and core.islower():  # most words
            tail = w[-1:] if w[-1:] in (b".", b",") else b""
            kind = self.plain.get((len(core), tail))
            if kind is None:
                kind = self.plain[len(core), tail] = self.kind((0, len(core), 0, tail == b".", False, "a", len(core) + len(tail), tail.decode()))
        else:
            kind = self.kind(self.word(w))
        self[w] = kind
        return kind

    @staticmethod
    def word(w: bytes) -> tuple:
        """(capitals, letters, odd signs, ends a sentence, doubled end sign, kind of letters, size, end sign)"""
        t = w.decode("utf-8", "replace")
        letters, caps, odd = sum(map(str.isalpha, t)), sum(map(str.isupper, t)), sum(c in ODD for c in w)
        tail = t[-1:] if not t[-1:].isalnum() else ""
        doubled = len(t) > 1 and t[-1] == t[-2] and not t[-1].isalnum()
        kind = "A" if letters and caps == letters and letters > 1 else "a" if letters and not caps else "Aa" if letters and t[:1].isupper() and caps == 1 else "mix" if letters else "0" if t.isdigit() else "-"
        return caps, letters, odd, t[-1:] in (".", "?", "!", ";", ":"), doubled, kind, len(t), tail

    def kind(self, key: tuple) -> int:
        """The number of the row (capitals, letters, odd signs, ends a sentence, doubled end sign, shape's feature)."""
        at = self.kinds.get(key)
        if at is None:
            caps, letters, odd, stop, doubled, kind, size, tail = key
            shape = f"{kind} {min(size, 24) // 4} {tail}{'x' if doubled else ''} {min(odd, 3)}"
            at = self.kinds[key] = len(self.kinds)
            if at == len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[at] = caps, letters, odd, stop, doubled, xxhash.xxh3_64_intdigest(shape) >> (64 - BITS)
        return at

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Statistics, and counts of hashed shapes."""
        raw = text.encode("utf-8", "replace")
        words = raw.split()
        n = len(words)
        if not n:
            return np.zeros(9), np.zeros(1 << BITS, np.float32)
        if len(self) > self.LIMIT or len(self.kinds) > self.LIMIT // 8:
            self.forget()
        code: defaultdict[bytes, int] = defaultdict()
        code.default_factory = code.__len__  # numbers in order of appearance
        seq = np.fromiter(map(code.__getitem__, words), np.int64, n)
        k = np.bincount(seq)
        kinds = np.fromiter(map(self.__getitem__, code), np.int64, len(k))
        per = self.rows.take(kinds, axis=0)
        caps, letters, odd, stops, doubled = k @ per[:, :5]
        feats = np.bincount(per[:, 5], weights=k, minlength=1 << BITS).astype(np.float32) / n
        same = int((seq[1:] == seq[:-1]).sum())
        lines = Counter(x for x in raw.split(b"\n") if len(x) > 20)
        total = sum(len(x) * c for x, c in lines.items())
        again = sum(len(x) * (c - 1) for x, c in lines.items())
        three = np.sort((seq[:-2] * len(k) + seq[1:-1]) * len(k) + seq[2:]) if n > 2 else seq[:0]
        twin = three[1:] == three[:-1]
        top = int(twin.sum() + (np.diff(np.concatenate([[0], twin.astype(np.int8)])) == 1).sum())
        stats = np.array([n, caps / max(letters, 1), odd / max(len(raw), 1), doubled / n, same / n, again / max(total, 1), len(k) / n, stops / n, top / max(n - 2, 1)])
        return stats, feats


def votes(s: np.ndarray) -> list[int]:
    """The labellers, from the statistics of Reader.read()."""
    n, caps, odd, doubled, same, again, distinct, stops, top = s
    if not n:
        return [0] * 9 + [-1]
    pick = lambda x, good, bad: 1 if x <= good else -1 if x >= bad else 0
    return [
        pick(caps, 0.12, 0.4) if n > 4 else 0,  # shouting
        pick(odd, 0.006, 0.03),  # odd signs
        pick(doubled, 0.01, 0.15),  # words that end in a doubled sign
        pick(same, 0.03, 0.15),  # one word again and again
        pick(again, 0.05, 0.3) if n > 60 else 0,  # lines again and again
        pick(-distinct, -0.45, -0.2) if n < 2000 else pick(-distinct, -0.3, -0.05),  # few different words
        0 if n < 30 else pick(abs(stops - 0.09), 0.085, 0.3),  # sentences of usual length
        pick(top, 0.15, 0.5) if n > 60 else 0,  # three words in a row again and again
        pick(caps + 10 * odd + same + (again if n > 60 else 0), 0.15, 0.5) if n > 4 else 0,  # all of these together
        pick(-n, -10, 0),  # long enough to tell; a text without words is bad
    ]


def pattern(v: list[int]) -> int:
    out = 0
    for x in v:
        out = out * 3 + x + 1
    return out


def votes_of(p: int, m: int = 10) -> list[int]:
    out = []
    for _ in range(m):
        p, r = divmod(p, 3)
        out.append(r - 1)
    return out[::-1]


def expectation_maximisation(counts: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], np.ndarray]:
    """The chance of being good for each pattern, and for each labeller the chances of its votes (-1, 0, 1) in bad and good documents."""
    if not counts:
        return {}, np.zeros((0, 2, 3))
    keys = sorted(counts)
    v = np.array([votes_of(p) for p in keys]) + 1
    c = np.array([counts[p] for p in keys], float)
    m = v.shape[1]
    # Kinds of junk differ, so each trips few labellers: to begin with, one bad vote makes a document suspect.
    good = np.where((v == 0).any(1), 0.1, 0.95)
    for _ in range(rounds):
        w = np.stack([c * (1 - good), c * good])
        prior = (w.sum(1) + 1) / (c.sum() + 2)
        p = np.empty((m, 2, 3))
        for j in range(m):
            for k in (0, 1):
                p[j, k] = np.bincount(v[:, j], weights=w[k], minlength=3) + 0.5
        p /= p.sum(2, keepdims=True)
        for j in range(m):  # a bad vote never speaks for good, nor a good vote for bad
            for x, low, high in ((0, 1, 0), (2, 0, 1)):
                if p[j, low, x] > p[j, high, x]:
                    p[j, :, x] = p[j, :, x] @ prior
        p /= p.sum(2, keepdims=True)
        log = np.log(prior)[:, None] + sum(np.log(p[j][:, v[:, j]]) for j in range(m))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return dict(zip(keys, good.tolist(), strict=True)), p


def inputs(stats: np.ndarray, feats: np.ndarray) -> np.ndarray:
    """The scorer's inputs: hashed shapes' shares and bounded statistics."""
    n, rest = stats[..., :1], stats[..., 1:]
    return np.concatenate([np.sqrt(feats), np.minimum(rest, 1.0), np.log1p(n) / 10, np.ones_like(n)], axis=-1)


def fit(x: np.ndarray, y: np.ndarray, c: np.ndarray, rounds: int = 300, rate: float = 2.0, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels y of rows that count c times, by gradient descent with momentum."""
    c = (c / c.sum()).astype(np.float32)
    w, speed = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        speed = np.float32(0.9) * speed - np.float32(rate) * (x.T @ ((p - y) * c) + np.float32(ridge) * w)
        w = w + speed
    return w


def posteriors(docs: DataFrame) -> tuple[dict[int, float], np.ndarray, int]:
    """The posteriors of all vote patterns, the labellers' chances, and the number of documents."""

    def run(batches):
        r = Reader()
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pattern(votes(r.read(t)[0])) for t in b.column(0).to_pylist()], pa.int32())], names=["p"])

    rows = docs_of(docs).select("text").mapInArrow(tidied(run), "p int").groupBy("p").count().collect()
    counts = {r[0]: r[1] for r in rows}
    return *expectation_maximisation(counts), sum(counts.values())


def train(docs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The scorer's weights."""
    good, _, n = posteriors(docs)

    def run(batches):
        r = Reader()
        for b in batches:
            for t, c, h in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                s, f = r.read(t)
                i = np.flatnonzero(f)
                yield pa.RecordBatch.from_arrays([pa.array([h], pa.int64()), pa.array([c], pa.int64()), pa.array([pattern(votes(s))], pa.int32()), pa.array([s.tolist()], pa.list_(pa.float64())), pa.array([i.tolist()], pa.list_(pa.int32())), pa.array([f[i].tolist()], pa.list_(pa.float32()))], names=["h", "c", "p", "s", "i", "f"])

    d = docs_of(docs).withColumn("h", F.xxhash64(F.col("text"), F.lit(SEED)))
    if n > sample:
        d = d.where(F.pmod("h", F.lit(2**40)) < F.lit(int(2**40 * min(1.0, sample / n))))
    # copies of a text become one row where they lie; the order makes the limit's choice the same on each run
    d = d.groupBy("text", "h").agg(F.count("*").alias("c")).select("text", "c", "h")
    read = d.mapInArrow(tidied(run), "h long, c long, p int, s array<double>, i array<int>, f array<float>")
    own = [(*r[2:], r[1]) for r in read.orderBy("h", "c", "p").limit(2 * sample).collect()]
    if not own:
        return np.zeros((1 << BITS) + 10)
    own = sorted(own, key=lambda r: (r[0], r[1], r[2]))  # one order, so that sums are the same on each run
    cols = sorted({i for r in own for i in r[2]})  # shapes that occur, a few hundred
    place = {c: j for j, c in enumerate(cols)}
    x = np.zeros((len(own), len(cols)), np.float32)
    for k, r in enumerate(own):
        x[k, [place[i] for i in r[2]]] = r[3]
    w = fit(inputs(np.array([r[1] for r in own], np.float32), x), np.array([good[r[0]] for r in own], np.float32), np.array([r[4] for r in own], np.float32))
    out = np.zeros((1 << BITS) + 10)
    out[cols], out[1 << BITS :] = w[: len(cols)], w[len(cols) :]
    return out


def scores(texts: list[str | None], r: Reader, w: np.ndarray) -> list[float]:
    """0 to 1 for each text, 1 is good."""
    out = []
    for t in texts:
        s, f = r.read(t or "")
        out.append(float(1 / (1 + np.exp(-np.clip(inputs(s, f) @ w, -30, 30)))) if s[0] else 0.0)
    return out


def score(docs: DataFrame, weights: np.ndarray, threshold: float = 0.5) -> DataFrame:
    """doc_id, score and kept of every row."""

    def run(batches):
        r = Reader()
        for b in batches:
            out = scores(b.column(1).to_pylist(), r, weights)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64()), pa.array([x >= threshold for x in out], pa.bool_())], names=["doc_id", "score", "kept"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(tidied(run), "doc_id long, score double, kept boolean")


def kept(docs: DataFrame, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs, in all their columns, that the classifier keeps."""
    weights, at = train(docs, sample), docs.columns.index("text")

    def run(batches):
        r = Reader()
        for b in batches:
            yield b.filter(pa.array([x >= threshold for x in scores(b.column(at).to_pylist(), r, weights)], pa.bool_()))

    return mapped(docs, run, docs.schema)


def classify(docs: DataFrame, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """doc_id, score and kept of every row."""
    return score(docs, train(docs, sample), threshold)
