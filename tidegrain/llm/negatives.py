"""Hard negatives by distributed radix selection.

Vectors are quantised to integers, so that scores (inner products) are integers and selection is exact. A window asks for
the k best rows of an anchor whose scores lie between two bounds and whose label is, or isn't, the anchor's: one for
an anchor's positives, then one for each positive. Scores become numbers of DIGITS digits to the base 2^BITS. In a pass over the grid of
anchors and rows each task counts, for each of its windows, the scores by their next digit, from the top down only as far as its own k-th, as no
digit below can hold the k-th of all. Summed, the counts tell the bucket of the k-th score and how many of it are
wanted; the next pass looks only into that bucket. After the last digit the k-th score itself is known, and one more pass
gathers the rows above it and, of those that have it, the wanted number of smallest ids of each task.

Scale: the grid is an equi-join on hash groups of some thousand anchors and rows each; what a pass emits for a window is k
counts a task at most, summed before they are shuffled, and what is gathered is the result and ties. Scores are never stored, and computed
anew in each pass. Nothing is broadcast, and the driver sees two counts and the largest length.

Defined cases: rows without id, label or vector, with a null or non-finite component, without components, or of a squared length
of LENGTH or more once quantised take no part; of rows that share an id the one with the least label, then vector, counts; vectors
are compared with those of as many components; equal scores go to the smaller id; fewer rows than k give as many as there are;
empty tables give empty results; extra columns, whatever their names, are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrain.scratch import done, save

#: Bits of a digit; anchors and rows of a grid group, about; anchors whose scores a task holds at a time.
BITS, ANCHORS, ROWS, TILE = 9, 8192, 8192, 128
#: Squared lengths below it leave room for the bounds' factors in 64 bits.
LENGTH = 2**56
NO_LIMIT = 2**62


def quantised(rows: DataFrame, scale: int = 256) -> DataFrame:
    """Rows (vec_id, label, v) of the usable rows of (vec_id, label, embedding): components floor(scale * x), x as double."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float(LENGTH)))) & (F.size(x) > 0)
    v = rows.where("vec_id is not null and label is not null and embedding is not null").where(sound)
    v = v.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform(x, lambda c: F.floor(scale * c).cast("double")).alias("v"))
    v = v.where(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c) < LENGTH).withColumn("v", F.col("v").cast("array<int>"))
    return v.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("own")).select("vec_id", "own.*")


class Side:
    """Rows of a grid group: ids, labels and, by number of components, their places and vectors."""

    def __init__(self, t: pa.Table, exact: bool):
        self.ids, self.labels = t["vec_id"].to_numpy(), t["label"].to_numpy()
        v = t["v"].combine_chunks()
        flat, starts = v.flatten().to_numpy(zero_copy_only=False), np.asarray(v.offsets)
        starts = starts - starts[0]
        sizes = np.diff(starts)
        self.of = {}
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            self.of[int(d)] = at, flat[starts[at][:, None] + np.arange(d)].astype(np.float64 if exact else np.int64)


def scored(left: pa.Table, right: pa.Table, most: int):
    """Yields (anchor, its windows, ids, labels alike, scores) of each anchor against the rows of a group that have its length.

    Doubles hold every partial sum exactly while squared lengths stay below 2^53; beyond, products are of integers.
    """
    exact = most < 2**53
    a, r = Side(left, exact), Side(right, exact)
    windows = left["windows"].to_pylist()
    for d, (at, x) in a.of.items():
        if d not in r.of:
            continue
        there, y = r.of[d]
        ids, labels = r.ids[there], r.labels[there]
        for i in range(0, len(at), TILE):
            for n, s in zip(at[i : i + TILE], x[i : i + TILE] @ y.T, strict=True):
                other = ids != a.ids[n]
                yield a.ids[n], windows[n], ids[other], labels[other] == a.labels[n], s[other].astype(np.int64)


def within(w: dict, alike: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.flatnonzero((s >= w["lo"]) & (s <= w["hi"]) & (alike == w["same"]))


def top_counts(digits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits and their counts, from the largest down as far as that of the k-th."""
    if len(digits) > k:
        digits = digits[digits >= np.partition(digits, len(digits) - k)[len(digits) - k]]
    return np.unique(digits, return_counts=True)


class Grid:
    """All anchors against all rows, in groups of both that meet once in each pass."""

    def __init__(self, anchors: DataFrame, rows: DataFrame):
        self.anchors, self.rows = anchors.select(*[F.col(c).alias(c) for c in anchors.columns]), rows  # columns of its own beside rows'
        self.groups, self.slots = (max(1, -(-df.count() // n)) for df, n in ((anchors, ANCHORS), (rows, ROWS)))
        length = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
        self.most = int(rows.agg(F.max(length)).first()[0] or 0) + 1024  # no score is larger; the sum is rounded to 2^-53 of it

    @property
    def digits(self) -> int:
        return -(-(2 * self.most).bit_length() // BITS)

    def over(self, windows: DataFrame, run, schema: str) -> DataFrame:
        """What run(left, right) gives for each pair of groups; anchors come with their windows and those without have gone."""
        each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        number = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
        own = windows.groupBy("vec_id").agg(F.collect_list(F.struct(*[c for c in windows.columns if c != "vec_id"])).alias("windows"))  # one for each positive
        left = self.anchors.join(own, "vec_id").withColumn("group", number(self.groups)).withColumn("slot", each(self.slots))
        right = self.rows.withColumn("slot", number(self.slots)).withColumn("group", each(self.groups))

        def both(key, left: pa.Table, right: pa.Table) -> pa.Table:
            return run(left, right)

        return left.groupBy("group", "slot").cogroup(right.groupBy("group", "slot")).applyInArrow(both, schema)


def counted(grid: Grid, windows: DataFrame, digit: int) -> DataFrame:
    """Rows (vec_id, w, digit, n): the scores of each window's bucket by their next digit."""
    most, shift = grid.most, BITS * (grid.digits - 1 - digit)

    def run(left, right):
        out = [[], [], [], []]
        for anchor, own, _, alike, s in scored(left, right, most):
            for w in own:
                u = s[within(w, alike, s)] + most
                if digit:
                    u = u[u >> (shift + BITS) == w["prefix"]]
                d, n = top_counts(u >> shift & (1 << BITS) - 1, w["k"])
                for o, x in zip(out, (np.full(len(d), anchor), np.full(len(d), w["w"]), d, n), strict=True):
                    o.append(x)
        return pa.table([pa.array(np.concatenate([np.zeros(0, np.int64), *o]).astype(np.int64)) for o in out], names=["vec_id", "w", "digit", "n"])

    return grid.over(windows, run, "vec_id long, w long, digit long, n long").groupBy("vec_id", "w", "digit").agg(F.sum("n").alias("n"))


def narrowed(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """windows with the bucket of their k-th score: prefix lengthened by its digit, k lessened by what lies above it. A window
    with fewer rows than k gets prefix -1: all of its rows are wanted."""
    down = Window.partitionBy("vec_id", "w").orderBy(F.desc("digit"))
    c = counts.join(windows, ["vec_id", "w"]).withColumn("upto", F.sum("n").over(down))
    all_ = F.sum("n").over(Window.partitionBy("vec_id", "w"))
    c = c.withColumn("short", all_ < F.col("k")).where((F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("n") < F.col("k")) | F.col("short"))
    prefix = F.when(F.col("short"), F.lit(-1)).otherwise(F.col("prefix") * 2**BITS + F.col("digit"))
    left = F.when(F.col("short"), F.col("k")).otherwise(F.col("k") - F.col("upto") + F.col("n"))
    return c.select("vec_id", "w", "same", "lo", "hi", "want", left.alias("k"), prefix.alias("prefix")).distinct()


def gathered(grid: Grid, windows: DataFrame) -> DataFrame:
    """Rows (vec_id, w, other, score, rank) of windows whose k-th scores are known."""
    most = grid.most

    def run(left, right):
        out = [[], [], [], []]
        for anchor, own, ids, alike, s in scored(left, right, most):
            for w in own:
                at = within(w, alike, s)
                u = s[at] + most
                above, ties = at[u > w["prefix"]], at[u == w["prefix"]]
                if len(ties) > w["k"]:
                    ties = ties[np.argpartition(ids[ties], w["k"] - 1)[: w["k"]]]
                at = np.concatenate([above, ties])
                for o, x in zip(out, (np.full(len(at), anchor), np.full(len(at), w["w"]), ids[at], s[at]), strict=True):
                    o.append(x)
        return pa.table([pa.array(np.concatenate([np.zeros(0, np.int64), *o]).astype(np.int64)) for o in out], names=["vec_id", "w", "other", "score"])

    found = grid.over(windows, run, "vec_id long, w long, other long, score long").join(windows.select("vec_id", "w", "want"), ["vec_id", "w"])
    rank = F.row_number().over(Window.partitionBy("vec_id", "w").orderBy(F.desc("score"), "other"))
    return found.withColumn("rank", rank).where(F.col("rank") <= F.col("want")).drop("want")


def selected(grid: Grid, windows: DataFrame) -> DataFrame:
    """Rows (vec_id, w, other, score, rank): the k best rows of each window (vec_id, w, same, lo, hi, k), scores between lo and hi."""
    own = save(windows.withColumns({"want": F.col("k"), "prefix": F.lit(0).cast("long")}), "windows")
    short = own.limit(0)
    for digit in range(grid.digits):
        now = save(narrowed(own, counted(grid, own, digit)), "windows")
        done(own)
        own = now
        if not digit:  # only the first pass can find too few rows
            short = own.where("prefix = -1")
            first = own
            own = save(own.where("prefix >= 0"), "windows")
    out = save(gathered(grid, own.unionByName(short)), "selected")
    done(own, first)
    return out


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row of (vec_id, label, embedding) for which
    ``anchors`` (of vec_id) holds, and each of its best rows of the same label, the best rows of other labels that score
    between least and most percent of the positive."""
    own = save(quantised(rows), "vectors")
    grid = Grid(own.where(anchors), own)
    free = {"w": F.lit(0).cast("long"), "same": F.lit(True), "lo": F.lit(-NO_LIMIT), "hi": F.lit(NO_LIMIT), "k": F.lit(positives).cast("long")}
    best = selected(grid, own.where(anchors).select("vec_id").withColumns(free))
    pos = best.select("vec_id", F.col("rank").cast("long").alias("w"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    lo, hi = F.expr(f"-((-{least} * positive_score - pmod(-{least} * positive_score, 100)) div 100)"), F.expr(f"({most} * positive_score - pmod({most} * positive_score, 100)) div 100")
    asked = pos.select("vec_id", "w", F.lit(False).alias("same"), lo.alias("lo"), hi.alias("hi"), F.lit(negatives).cast("long").alias("k")).where("lo <= hi")
    found = selected(grid, asked).join(pos, ["vec_id", "w"])
    return found.select(F.col("vec_id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
