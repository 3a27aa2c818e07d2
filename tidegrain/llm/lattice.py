"""Embedding near-duplicates by lattice hashing.

Vectors are scaled to length one and projected by several random tables onto eight axes each; a projection is decoded
to its nearest point of the E8 lattice and to the next nearest ones around it, and vectors that share a point of a table
are compared by cosine. Vectors that are equal count as one with a multiplicity until the end, so copies never form
pairs. A lattice cell of any size is compared whole: it is cut into blocks, and every pair of blocks is a group of its
own, so no group is larger than two blocks.

To a cell goes a vector's int8 form with its scale and the bound of what that loses. The int8 product settles nearly all
pairs, as their cosine's bounds lie on one side of the limit; for the few others the original vectors are fetched and the
cosine is taken in double precision.

Vectors that are null, zero or hold null or non-finite components link with nothing: n_links 0, their own component.
Vectors of different lengths never link. Rows that repeat a vec_id and vector are one vector, with a result row for
each; a null vec_id is compared with nothing; an empty table gives an empty result; extra columns, whatever their names,
are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.llm.ann import cosines, matrix, quantise, unit
from tidegrain.llm.common import components, mix, save

TABLES, CELLS, WIDTH, BLOCK, SPREAD, SEED = 8, 4, 1.2, 512, 256, 20240501


def flipped(y: np.ndarray) -> np.ndarray:
    """The points of D8 (integers of even sum) nearest to each row of y: rows x 4 x 8."""
    r = np.rint(y)
    e = y - r
    worst = np.argsort(-np.abs(e), axis=1)[:, :4]
    step = np.where(e >= 0, 1.0, -1.0)
    odd = (r.sum(1) % 2) != 0
    n = np.arange(len(y))
    out = np.repeat(r[:, None, :], 4, axis=1)
    # odd sums: round one coordinate the other way; even sums: none, or two
    for k in range(4):
        i = worst[:, k]
        out[n[odd], k, i[odd]] += step[n[odd], i[odd]]
    even = n[~odd]
    for k, (a, b) in enumerate(((None, None), (0, 1), (0, 2), (1, 2))):
        if a is not None:
            for j in (a, b):
                i = worst[even, j]
                out[even, k, i] += step[even, i]
    return out


def points(y: np.ndarray, cells: int) -> np.ndarray:
    """The nearest points of E8 (D8 and D8 shifted by a half) to each row, doubled to integers: rows x cells x 8."""
    both = np.concatenate([flipped(y), flipped(y - 0.5) + 0.5], axis=1)
    far = ((both - y[:, None, :]) ** 2).sum(2)
    order = np.argsort(far, axis=1, kind="stable")[:, :cells]
    return (2 * np.take_along_axis(both, order[:, :, None], axis=1)).astype(np.int64)


def keys(u: np.ndarray, tables: int, cells: int, width: float) -> np.ndarray:
    """64-bit names of each unit vector's lattice cells: rows x (tables * cells)."""
    d = u.shape[1]
    out = []
    for t in range(tables):
        proj = np.random.default_rng([SEED, d, t]).standard_normal((d, 8))
        p = points(u @ proj / width, cells).astype(np.uint64)
        h = np.full(p.shape[:2], (t + 1) * 1_000_003 + d, np.uint64)
        for i in range(8):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + p[:, :, i])
        out.append(h)
    return np.concatenate(out, axis=1).view(np.int64)


def cells_of(vectors: DataFrame, tables: int, cells: int, width: float) -> DataFrame:
    """Rows (key, id, v): every vector with the name of each of its cells; v: scale, loss and the int8 vector, as bytes."""

    def run(batches):
        for b in batches:
            rest = np.arange(b.num_rows)
            ids = b.column(0).to_numpy(zero_copy_only=False)
            while len(rest):
                rows, x = matrix(b.column(1).take(pa.array(rest)))
                if not len(rows):
                    break
                for s in range(0, len(rows), 1024):
                    u = unit(x[s : s + 1024])
                    k = keys(u, tables, cells, width)
                    n = k.shape[1]
                    q, scale, lost = quantise(u)
                    raw = np.concatenate([scale[:, None].view("u1"), lost[:, None].view("u1"), q.view("u1")], axis=1)
                    size = raw.shape[1]
                    v = pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(raw) * n, [None, pa.py_buffer(np.repeat(raw, n, axis=0).tobytes())])
                    yield pa.RecordBatch.from_arrays([pa.array(k.ravel()), pa.array(np.repeat(ids[rest[rows[s : s + 1024]]], n), pa.int64()), v.cast(pa.binary())], names=["key", "id", "v"])
                rest = np.delete(rest, rows)

    return vectors.mapInArrow(run, "key long, id long, v binary")


def near_pairs(rows: DataFrame, least: float, block: int) -> DataFrame:
    """Rows (a, b, sure), a < b, of ids that share a key and may have a cosine of at least ``least``; sure: they have."""
    # a cell's rows are told its size in SPREAD places, so that a large one is cut before any task holds it
    rows = rows.withColumn("place", F.pmod(F.xxhash64("id"), F.lit(SPREAD)))
    per = rows.groupBy("key", "place").agg(F.count("*").alias("n"))
    sizes = per.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    cut = rows.join(per.select("key", "place").join(sizes, "key"), ["key", "place"]).withColumn("nb", F.ceil(F.col("n") / block)).withColumn("own", F.pmod(F.xxhash64("id"), F.col("nb")))
    pairs = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
    pairs = pairs.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.col("own"), "id", "v")

    def compare(ids, own, i, j, vs):
        size = np.array([len(v) for v in vs])
        for s in np.unique(size):  # vectors of one length
            at = np.flatnonzero(size == s)
            raw = np.frombuffer(b"".join(vs[n] for n in at), "u1").reshape(len(at), s)
            scale, lost = (np.ascontiguousarray(raw[:, k : k + 8]).view("<f8")[:, 0] for k in (0, 8))
            kind = np.float32 if (s - 16) * 127 * 127 < 2**24 else np.float64
            q = np.ascontiguousarray(raw[:, 16:]).view("i1").astype(kind)
            left, right = (np.flatnonzero(own[at] == x) for x in (i, j))
            near = (q[left] @ q[right].T) * np.outer(scale[left], scale[right])
            err = lost[left][:, None] + (1 + lost[left][:, None]) * lost[right][None] + 1e-9
            r, c = np.nonzero(near + err >= least)
            a, b = ids[at][left[r]], ids[at][right[c]]
            ok = a != b
            yield np.minimum(a, b)[ok], np.maximum(a, b)[ok], ((near - err)[r, c] >= least)[ok]

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            key, i, j = (held.column(n).to_numpy() for n in ("key", "i", "j"))
            edge = np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            if len(edge):
                yield from groups(held.slice(0, edge[-1]), np.concatenate([[0], edge]))
                held = held.slice(edge[-1])
        if held is not None and held.num_rows:
            yield from groups(held, np.array([0, held.num_rows]))

    def groups(t, edge):
        ids, own, i, j = (t.column(n).to_numpy() for n in ("id", "own", "i", "j"))
        vs = t.column("v").to_pylist()
        found = [x for s, e in zip(edge[:-1], edge[1:], strict=True) if e - s > 1 for x in compare(ids[s:e], own[s:e], i[s], j[s], vs[s:e])]
        if found:
            a, b, sure = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((~sure, b, a))  # of a pair that several cells show, a sure row first
            a, b, sure = a[order], b[order], sure[order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(x[new]) for x in (a, b, sure)], names=["a", "b", "sure"])

    dealt = pairs.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(run, "a long, b long, sure boolean").groupBy("a", "b").agg(F.bool_or("sure").alias("sure"))


def close_pairs(vectors: DataFrame, least: float, tables: int, cells: int, width: float, block: int) -> DataFrame:
    """Pairs (a < b) of ids of vectors (rep, embedding) that share a cell and have a cosine of at least ``least``; each once."""
    near = save(near_pairs(cells_of(vectors, tables, cells, width), least, block), "near")
    side = lambda id_, v: vectors.select(F.col("rep").alias(id_), F.col("embedding").alias(v))
    open_ = near.where("not sure").join(side("a", "q"), "a").join(side("b", "c"), "b").select("a", "b", "q", "c")
    exact = cosines(open_).where(F.col("score") >= least).select("a", "b")
    return near.where("sure").select("a", "b").union(exact)


def near_duplicates(vectors: DataFrame, least: float = 0.9, tables: int = TABLES, cells: int = CELLS, width: float = WIDTH, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors (vec_id, embedding)."""
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
    sound = F.col("embedding").isNotNull() & F.exists("embedding", lambda x: x != 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    ok = own.where(F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull()).distinct()
    # equal vectors: one stands for all, the smallest id
    reps = save(ok.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "reps")
    edges = save(close_pairs(reps.select("rep", "embedding"), least, tables, cells, width, block), "links")
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).toDF("rep", "other")
    far = both.join(reps.select(F.col("rep").alias("other"), "n"), "other").groupBy("rep").agg(F.sum("n").alias("far"))
    comp = components(edges).select(F.col("node").alias("rep"), "root")
    per = reps.join(far, "rep", "left").join(comp, "rep", "left").select("embedding", (F.col("n") - 1 + F.coalesce("far", F.lit(0))).alias("links"), F.coalesce("root", "rep").alias("root"))
    out = own.join(per, "embedding", "left")
    root = F.when(F.col("vec_id").isNotNull(), F.coalesce("root", "vec_id"))
    return out.select("vec_id", F.when(F.col("vec_id").isNull(), F.lit(0)).otherwise(F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), root.alias("component_id"), F.coalesce(root == F.col("vec_id"), F.lit(True)).alias("kept"))
