"""Exact nearest neighbours of a query set by a block matrix join.

Vectors are scaled to length one and quantised to int8 with one scale per vector, once, and packed in blocks; only int8
vectors, scales and error bounds travel. A tile is one query block against one candidate block: its int8 product gives
every cosine with a bound on the quantisation error. A tile passes on the pairs whose upper bound reaches its k-th lower
bound of their query, and of all tiles together those go on that reach the k-th of all. Their original vectors are fetched,
once each, their cosines computed again in double precision, and a heap per query keeps the k best.

Vectors that are null, of zero length, hold null or non-finite components or have another number of components than
the first block of their side take no part (a mixture of lengths is compared within equal lengths only). A query's own
row is never its neighbour; equal cosines go to the smaller vec_id; rows that repeat a vec_id and vector count once;
an empty table gives an empty result; fewer candidates than k give as many rows as there are; extra columns, whatever their
names, are left out.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrain.llm.common import save

#: Rows of a block: a tile holds two blocks and its product, whatever the table's size.
QUERY_BLOCK, CANDIDATE_BLOCK, GROUP = 1024, 4096, 8


def matrix(col) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that are whole and not zero, and their vectors (double): those of the most usual length when several are mixed."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    n = len(col)
    if n == 0:
        return np.zeros(0, int), np.zeros((0, 0))
    sizes = np.diff(col.offsets.to_numpy())
    ok = col.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0)
    flat = col.values.cast(pa.float64())
    whole = flat.is_valid().to_numpy(zero_copy_only=False)
    flat = flat.to_numpy(zero_copy_only=False)
    start = col.offsets.to_numpy()[:-1]
    total, full = (np.concatenate([[0], np.cumsum(x)]) for x in (~np.isfinite(flat) | ~whole, flat != 0))
    ok &= (total[start + sizes] == total[start]) & (full[start + sizes] > full[start])
    if not ok.any():
        return np.zeros(0, int), np.zeros((0, 0))
    d = np.bincount(sizes[ok]).argmax()
    ok &= sizes == d
    rows = np.flatnonzero(ok)
    return rows, flat[start[rows][:, None] + np.arange(d)]


def unit(x: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled by their largest component first, so that no square overflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fitted(x: np.ndarray) -> np.ndarray:
    """Vectors whose squares would leave the range of doubles, times a power of two, which changes no digit of a cosine."""
    top = np.abs(x).max(1)
    odd = (top > 1e120) | (top < 1e-120)
    if not odd.any():
        return x
    return np.ldexp(x, np.where(odd, -np.frexp(top)[1], 0)[:, None])


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, and the length of what quantisation loses."""
    scale = np.abs(u).max(1) / 127
    q = np.rint(u / scale[:, None]).astype(np.int8)
    lost = np.sqrt(((u - q * scale[:, None]) ** 2).sum(1)) + 1e-12
    return q, scale, lost


PARTS = ("ids", "names", "q8", "scale", "lost")
KINDS = {"ids": "<i8", "names": "<i8", "q8": "i1", "scale": "<f8", "lost": "<f8"}


def blocks(vectors: DataFrame, size: int, name: str) -> DataFrame:
    """Rows (block, dim, ids, names, q8, scale, lost) of up to size quantised vectors of one dimension, packed where they lie.

    vectors: vec_id, embedding and name, which together with the id names a vector.
    """

    def run(batches):
        from pyspark import TaskContext

        held: dict[int, list] = {}
        number = [0]

        def emit(d, own):
            block = TaskContext.get().partitionId() << 33 | number[0]
            number[0] += 1
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([d], pa.int32()), *(pa.array([x.astype(KINDS[p]).tobytes()], pa.binary()) for p, x in zip(PARTS, own, strict=True))], names=["block", "dim", *PARTS])

        def joined(own):
            return [np.concatenate(x) for x in zip(*own, strict=True)]

        for b in batches:
            ids, names = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            rest = np.arange(len(ids))
            while len(rest):
                rows, x = matrix(b.column(1).take(pa.array(rest)))
                if not len(rows):
                    break
                at = rest[rows]
                held.setdefault(x.shape[1], []).append((ids[at], names[at], *quantise(unit(x))))
                rest = np.delete(rest, rows)
            for d, own in held.items():
                while sum(len(x[0]) for x in own) >= size:
                    all_ = joined(own)
                    yield emit(d, [x[:size] for x in all_])
                    own[:] = [tuple(x[size:] for x in all_)]
        for d, own in held.items():
            if sum(len(x[0]) for x in own):
                yield emit(d, joined(own))

    return save(vectors.mapInArrow(run, "block long, dim int, ids binary, names binary, q8 binary, scale binary, lost binary"), name)


def tile(q: dict, c: dict, k: int):
    """Rows and columns of the pairs of a tile that may be among the k nearest of their query, and the cosines' bounds."""
    # products of int8 values in float32 are exact while they stay below 2^24
    kind = np.float32 if q["q8"].shape[1] * 127 * 127 < 2**24 else np.float64
    near = (q["q8"].astype(kind) @ c["q8"].astype(kind).T) * np.outer(q["scale"], c["scale"])
    # |uq.uc - near| <= |uq - q'| |uc| + |q'| |uc - c'|
    err = q["lost"][:, None] + (1 + q["lost"][:, None]) * c["lost"][None, :] + 1e-9
    near[q["ids"][:, None] == c["ids"][None, :]] = -np.inf
    low = near - err
    cut = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(low), -np.inf)
    rows, cols = np.nonzero((near + err >= cut[:, None]) & (near > -np.inf))
    return rows, cols, low[rows, cols], (near + err)[rows, cols]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for the k nearest rows of vectors (vec_id, embedding) to each row of queries (same columns)."""
    own = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"), F.xxhash64("embedding").alias("name")).where("vec_id is not null")
    # Of rows with one vector only the k + 1 smallest ids can be among anyone's k nearest, so that a much repeated vector stays small.
    whole = own(vectors).where(F.col("embedding").isNotNull()).dropDuplicates(["vec_id", "embedding"])
    alike = Window.partitionBy("embedding").orderBy("vec_id")
    few = save(whole.withColumn("rn", F.row_number().over(alike)).where(F.col("rn") <= k + 1).drop("rn"), "vectors")
    asked = save(own(queries).dropDuplicates(["vec_id", "embedding"]), "asked")
    cand, ask = blocks(few, candidate_block, "candidates"), blocks(asked, query_block, "queries")
    found = save(survivors(tiles(ask, cand, k), k), "found")
    return merged(scored(found, asked, few), k)


def tiles(ask: DataFrame, cand: DataFrame, k: int) -> DataFrame:
    """Rows (query_id, query, vec_id, name, low, high) of the grid of all query blocks by all candidate blocks.

    An equi-join on (group of query blocks, group of candidate blocks): blocks fall into groups by a hash of their name, as
    many groups as there are query blocks, and one for GROUP candidate blocks.
    """
    na, slots = max(1, ask.count()), max(1, -(-cand.count() // GROUP))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = ask.withColumn("slot", every(slots)).withColumn("qn", F.pmod(F.xxhash64("block"), F.lit(na))).select("qn", "slot", "dim", *PARTS)
    right = cand.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots))).withColumn("qn", every(na)).select("qn", "slot", "dim", *PARTS)

    def open_(t: pa.Table) -> list[dict]:
        out = []
        for d, *own in zip(*(t[f].to_pylist() for f in ("dim", *PARTS)), strict=True):
            x = {p: np.frombuffer(v, KINDS[p]) for p, v in zip(PARTS, own, strict=True)}
            out.append(x | {"q8": x["q8"].reshape(-1, d)})
        return out

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out, sides = [], open_(right)
        for q in open_(left):
            for c in sides:
                if q["q8"].shape[1] == c["q8"].shape[1]:
                    r, x, low, high = tile(q, c, k)
                    out.append((q["ids"][r], q["names"][r], c["ids"][x], c["names"][x], low, high))
        cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4 + [np.zeros(0)] * 2
        return pa.table(cols, names=["query_id", "query", "vec_id", "name", "low", "high"])

    by = ("qn", "slot")
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, "query_id long, query long, vec_id long, name long, low double, high double")


def survivors(found: DataFrame, k: int) -> DataFrame:
    """Of each query's pairs those whose upper bound reaches its k-th lower bound of all tiles; each tile gives k and a few."""
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("low"), "vec_id", "name")
    whole = best.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cut = F.coalesce(F.nth_value("low", k).over(whole), F.lit(float("-inf")))
    return found.withColumn("cut", cut).where("high >= cut").select("query_id", "query", "vec_id", "name")


def scored(found: DataFrame, asked: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rows (query_id, vec_id, score): the cosines of pairs, in double precision from the original vectors."""
    q = asked.select(F.col("vec_id").alias("query_id"), F.col("name").alias("query"), F.col("embedding").alias("q"))
    c = vectors.select("vec_id", "name", F.col("embedding").alias("c"))
    return cosines(found.join(q, ["query_id", "query"]).join(c, ["vec_id", "name"]).select("query_id", "vec_id", "q", "c"))


def cosines(pairs: DataFrame) -> DataFrame:
    """The first two columns of pairs (both long), and score: the cosine of their vectors q and c, summed in one fixed order."""
    names = pairs.columns[:2]

    def run(batches):
        for b in batches:
            out = np.zeros(b.num_rows)
            sizes = pa.compute.list_value_length(b.column(2)).to_numpy(zero_copy_only=False)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                x, y = (b.column(i).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d) for i in (2, 3))
                x, y = fitted(x), fitted(y)
                out[at] = np.einsum("ij,ij->i", x, y) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out)], names=[*names, "score"])

    return pairs.mapInArrow(run, f"{names[0]} long, {names[1]} long, score double")


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query's tiles: one heap at a time over rows sorted by query."""
    names, kinds = ["query_id", "rank", "vec_id", "score"], (pa.int64(), pa.int32(), pa.int64(), pa.float64())

    def out(done):
        flat = [(q, r + 1, -v, s) for q, h in done for r, (s, v) in enumerate(sorted(h, reverse=True))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat, strict=True) if flat else [()] * 4, kinds, strict=True)], names=names)

    def run(batches):
        now, heap = None, []
        for b in batches:
            done = []
            for q, v, s in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if q != now:
                    done.append((now, heap))
                    now, heap = q, []
                if (s, -v) not in heap:
                    (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, (s, -v))
            yield out(done)
        yield out([(now, heap)])

    return found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(run, "query_id long, rank int, vec_id long, score double")
