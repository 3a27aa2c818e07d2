"""N-gram Jaccard join: documents whose sets of word shingles have a Jaccard similarity of 0.8 or more, exactly.

Size-aware heavy-light join. Sets are shingle hashes in one global order. Two similar sets share an element of their
prefixes (as many first elements as can be missing, plus one), and two elements of prefixes one longer.
  * Small sets (up to a boundary) enumerate the fixed-size subsets, pairs, of their longer prefix.
  * Large sets, and small ones near the boundary, go into inverted lists, one per element of the prefix.
  * The boundary is where enumerating subsets costs more rows than posting to lists and scanning them, summed over the
    sizes that occur.
The global order puts elements that many sets hold (passages that many texts share) last: each task counts the
elements of its own sets, and the DEMOTED ones with the largest sums of counts over two follow all others. Any one
order gives the same result; this one keeps unlike texts from meeting.

Lists of up to LIGHT sets give all their pairs of fitting sizes. Longer lists (groups of near copies) never do: all are
compared with the member whose elements the most others share, then with the first of those that are in another
component still; only pairs across components go on, and of these only the ones that the triangle inequality of the
Jaccard distance doesn't rule out. So no link that changes a component is lost, and no group is expanded. Before two texts are compared, their odd sketches
are: a bitmap in which each element flips one bit, so that the bits in which two sketches differ are at most the
elements in which the sets do. Two similar sets differ in a ninth of their sizes' sum at most, so a pair whose sketches
alone differ more is none; pairs across components are made under that condition. Folds of sketches are compared first,
whole sketches of the pairs that they leave.

On disk are the postings at most, while lists are scanned, then pairs with a fold of FOLD bits, and what pairs read: whole
sketches and texts of the others are left out before they are dealt (among()), and texts are compared in as many slices as
let one deal a SHARE-th of all shingles' texts. Each table's shuffles go when it is written.

Sets are compared as 64-bit hashes of whole shingles (two shingles of a pair collide once in 2^64); sets are named by 64
bits, and if a second hash tells that two of a name differ, all are named anew. Words are
[^\\x20\\x09-\\x0D]+ after lower-casing A-Z; a text of fewer than five words is one shingle; an empty or null text has no
shingle and links with nothing. Equal sets, of copies or repeated rows, count as one until the end. A null doc_id takes
part, but only names a component that has no other id. An empty table gives an empty result; extra columns, whatever their names, are left
out of the join and carried along by deduplicated().
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrain import scratch
from tidegrain.llm.common import LOWER, WordHash, components, alone, docs_of, done, grams, least_of, names, save, sweep, tidied

WORDS, LEAST, LIGHT, DEMOTED, FAN = 5, 80, 8, 2**17, 128
SEEN, COUNTED = 300_000, 2_000_000  # names and prefix elements that a task holds
FOLD, MOST_BITS = 1024, 2**16  # bits of the sketch that joins compare, and of the largest
SHARE, MAYBE = 2, 2**24  # of the texts that a slice of pairs deals; bits of the table that tells which rows are wanted


def shingles(text: bytes, h: WordHash, k: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    w = text.translate(LOWER).split()
    if not w:
        return np.zeros(0, np.uint64)
    if len(w) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(w), 1)], np.uint64)
    return np.unique(grams(h.of(w), k))


def name(s: np.ndarray, seed: int = 0) -> int:
    """A set's name: a signed 64-bit hash of its elements (and so of its size)."""
    return xxhash.xxh3_64_intdigest(s.tobytes(), seed) - 2**63


def odd_sketch(s: np.ndarray) -> np.ndarray:
    """A bitmap of at least four bits an element (a power of two, FOLD to MOST_BITS), as 64-bit words."""
    bits = min(MOST_BITS, max(FOLD, 1 << (4 * max(len(s), 1) - 1).bit_length()))
    flips = np.bincount((s >> np.uint64(8)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view("<i8")


def fold(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch of the same set with fewer bits."""
    while len(sketch) > words:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def need(n: int, least: int = LEAST) -> int:
    """Elements that a set of n shares with any similar set, at least."""
    return -(-least * n // 100)


def choose_boundary(sizes: dict[int, int], scan: float = 1.0, most: int = 200) -> int:
    """The largest size whose sets enumerate subsets. Costs: a row per subset; a row and ``scan`` rows read per list entry."""

    def cost(x: int) -> float:
        total = 0.0
        for n, c in sizes.items():
            p = n - need(n) + 1
            if n <= x:
                total += c * comb(p + 1, 2)
            if n > x or 100 * n >= LEAST * (x + 1):
                total += c * p * (1 + scan)
        return total

    return min(range(1, most + 1), key=lambda x: (cost(x), x))


def named_sets(docs: DataFrame, key: Column, seed: int) -> DataFrame:
    """doc_id, k, sig (the set's name; null for no shingles), n, sketch and its fold, and twin (a second hash of the set) of every
    row; and rows with a null n, in which sig is an element that k sets (three or more) of one task share."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
    columns = ["doc_id", "k", "sig", "n", "sketch", "fold", "twin"]

    def run(batches):
        h, seen, held, room = WordHash(), set(), [], 0

        def often():
            key, c = np.unique(np.concatenate(held), return_counts=True)
            key, c = key[c > 2], c[c > 2]
            none = [None] * len(key)
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((none, c, key.view(np.int64), none, none, none, none), kinds, strict=True)], names=columns)

        for b in batches:
            sig, n, sketch, folds, twin = [], [], [], [], []
            for t in b.column(2).cast(pa.binary()).to_pylist():
                s = shingles(t, h)
                sig.append(name(s, seed) if len(s) else None)
                twin.append(name(s, seed + 1) if len(s) else None)
                n.append(len(s))
                first = not len(s) or sig[-1] not in seen
                bits = odd_sketch(s) if first else None
                sketch.append(bits.tobytes() if first else None)
                folds.append(fold(bits, FOLD // 64).tolist() if first else None)
                if first and len(s):
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(sig[-1])
                    held.append(s | np.uint64(1))
                    room += len(s)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x, t) for x, t in zip((sig, n, sketch, folds, twin), kinds[2:], strict=True))], names=columns)
            if room > COUNTED:
                yield often()
                held, room = [], 0
        if held:
            yield often()

    return docs_of(docs, key).select("doc_id", "k", "text").mapInArrow(tidied(run), "doc_id long, k long, sig long, n long, sketch binary, fold array<long>, twin long")


def postings(docs: DataFrame, boundary: int, last: np.ndarray, seed: int) -> DataFrame:
    """Rows (key, sig, nr): subsets of small sets (even keys) and prefixes of large ones (odd keys). last: sorted odd keys of
    the elements that come last in the order. nr: the set's size, shifted by 32 bits, and the element's rank in it."""

    def run(batches):
        h, seen = WordHash(), set()
        for b in batches:
            keys, sigs, sizes = [], [], []
            for t in b.column(0).cast(pa.binary()).to_pylist():
                s = shingles(t, h)
                n = len(s)
                if n < 2:
                    continue
                sig = name(s, seed)
                if sig in seen:  # copies within a task post once
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(sig)
                p, single = n - need(n) + 1, n > boundary or 100 * n >= LEAST * (boundary + 1)
                if len(last):
                    odd = (s | np.uint64(1)).view(np.int64)
                    s = s[np.argsort(last[np.minimum(np.searchsorted(last, odd), len(last) - 1)] == odd, kind="stable")[: p + 1]]
                parts = []
                if n <= boundary:
                    i, j = np.triu_indices(p + 1, 1)
                    lo, hi = np.minimum(s[i], s[j]), np.maximum(s[i], s[j])
                    parts.append(((lo * np.uint64(0x9E3779B97F4A7C15) + hi * np.uint64(0xC2B2AE3D27D4EB4F)) & ~np.uint64(1), 0))
                if single:
                    parts.append((s[:p] | np.uint64(1), np.arange(p)))
                for x, r in parts:
                    keys.append(x)
                    sigs.append(np.full(len(x), sig, np.int64))
                    sizes.append(np.full(len(x), n << 32, np.int64) + r)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(sigs)), pa.array(np.concatenate(sizes))], names=["key", "sig", "nr"])

    return docs_of(docs).select("text").mapInArrow(tidied(run), "key long, sig long, nr long")


def scan_lists(post: DataFrame, light: int = LIGHT) -> DataFrame:
    """Rows (key, a, b, nr): pairs a < b of light lists (key null), and the members a, nr of longer ones (b null).

    Pairs must fit by size, and by rank: what precedes the first element that two sets share is in one of them only, so
    the ranks of that element add up to a ninth of the sizes' sum at most.
    """

    def out(key, a, b, nr):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (key, a, b, nr)], names=["key", "a", "b", "nr"])

    def pairs(key, sig, nr):
        """All fitting pairs of whole lists, and the members of long ones."""
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        size = np.repeat(np.diff(edge), np.diff(edge))
        big = size > light
        if big.any():
            yield out(key[big], sig[big], [None] * int(big.sum()), nr[big])
        keep = (size > 1) & ~big
        key, sig, n, r = key[keep], sig[keep], nr[keep] >> 32, nr[keep] & 0xFFFFFFFF
        a, b = [], []
        for d in range(1, light):
            if len(key) <= d:
                break
            same = key[:-d] == key[d:]
            if not same.any():
                break
            i = np.flatnonzero(same & (100 * np.minimum(n[:-d], n[d:]) >= LEAST * np.maximum(n[:-d], n[d:])) & (9 * (r[:-d] + r[d:]) <= n[:-d] + n[d:]))
            a.append(sig[i])
            b.append(sig[i + d])
        if a:
            p = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
            if len(p):
                yield out([None] * len(p), p[:, 0], p[:, 1], [None] * len(p))

    def run(batches):
        held, long = (np.zeros(0, np.int64),) * 3, None  # the list that the last rows belong to; its key if it is known to be long
        for b in batches:
            now = tuple(np.concatenate([x, b.column(i).to_numpy()]) for i, x in enumerate(held))
            key, sig, nr = now
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])])  # copies of other tasks
            key, sig, nr = key[new], sig[new], nr[new]
            if long is not None:
                own = key == long
                if own.any():
                    yield out(key[own], sig[own], [None] * int(own.sum()), nr[own])
                    key, sig, nr = key[~own], sig[~own], nr[~own]
                if len(key):
                    long = None
            if not len(key):
                held = (np.zeros(0, np.int64),) * 3
                continue
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield from pairs(key[:cut], sig[:cut], nr[:cut])
            held = key[cut:], sig[cut:], nr[cut:]
            if len(held[0]) > light:
                yield out(held[0], held[1], [None] * len(held[0]), held[2])
                long, held = int(key[-1]), (np.zeros(0, np.int64),) * 3
        if len(held[0]):
            yield from pairs(*held)

    return post.repartition("key").sortWithinPartitions("key", "sig").mapInArrow(tidied(run), "key long, a long, b long, nr long")


def among(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows of df whose column is in wanted's only one, and a few others.

    Wanted values are told by a broadcast table of MAYBE bits, 64 to a row, so that the other rows are dropped before df is
    dealt. Where so many are wanted that the table is full, all rows pass.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(MAYBE))
    bits = wanted.toDF("_wanted").select(bit("_wanted").alias("_bit")).groupBy(F.shiftright("_bit", 6).alias("_word")).agg(F.expr("bit_or(shiftleft(1L, CAST(_bit & 63 AS INT)))").alias("_bits"))
    told = df.withColumn("_bit", bit(column)).join(F.broadcast(bits), F.shiftright("_bit", 6) == F.col("_word"))
    return told.where("shiftright(_bits, CAST(_bit & 63 AS INT)) & 1 = 1").select(df.columns)


def compare(pairs: DataFrame, docs: DataFrame, key: Column, reps: DataFrame) -> DataFrame:
    """Rows (a, b, inter, total): shared and all shingles of each pair, from the texts.

    Each pair's second text goes to its first one's group; a first text with many partners is copied to one group per
    FAN of them.
    """
    wanted = pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b"))).distinct().join(reps.select("sig", "rep_k"), "sig")
    own = among(docs_of(docs, key).select("k", "text"), "k", wanted.select("rep_k"))
    texts = own.join(wanted.select(F.col("rep_k").alias("k"), "sig"), "k").groupBy("k").agg(F.first("sig").alias("sig"), F.first("text").alias("text")).select("sig", "text")
    fan = pairs.groupBy("a").agg(F.ceil(F.count("*") / FAN).alias("fan"))
    first = texts.join(fan, texts["sig"] == fan["a"]).select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("fan") - 1)).alias("slot"), F.lit(None).cast("long").alias("b"), "text")
    second = pairs.join(fan, "a").select("a", F.pmod(F.xxhash64("b"), "fan").alias("slot"), "b").join(texts, F.col("b") == texts["sig"]).select("a", "slot", "b", "text")

    def run(batches):
        h, now, own = WordHash(), None, None
        for x in batches:
            rows = []
            for a, b, t in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), x.column(2).cast(pa.binary()).to_pylist(), strict=True):
                s = shingles(t, h)
                if b is None:
                    now, own = a, s
                    continue
                if a != now:
                    raise ValueError("a pair without its first text")
                both = len(np.intersect1d(own, s, assume_unique=True))
                rows.append((a, b, both, len(own) + len(s) - both))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "inter", "total"])

    dealt = first.unionByName(second).repartition("a", "slot").sortWithinPartitions("a", "slot", F.col("b").asc_nulls_first())
    return dealt.select("a", "b", "text").mapInArrow(tidied(run), "a long, b long, inter long, total long")


def apart(x: Column | str, y: Column | str) -> Column:
    """The bits in which two folds differ."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda p, q: p + q)


def folded(pairs: DataFrame, folds: DataFrame) -> DataFrame:
    """Rows (a, b, differ, size, wide): pairs with the bits in which their folds differ, or the difference of their sizes if
    that is more, the sum of their sizes, and whether both have sketches of more bits. folds: sig, n, fold."""
    one, two = (folds.select(F.col("sig").alias(x), F.col("n").alias(f"n{x}"), F.col("fold").alias(f"f{x}")) for x in "ab")
    j = pairs.join(one, "a").join(two, "b")
    return j.select("a", "b", F.greatest(apart("fa", "fb").cast("long"), F.abs(F.col("na") - F.col("nb"))).alias("differ"), (F.col("na") + F.col("nb")).alias("size"), (F.least("na", "nb") > FOLD // 4).alias("wide"))


def prune(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Rows (a, b, differ, size): pairs with the bits in which their sketches differ and the sum of their sizes.

    sketches: sig, n, sketch, in any number of equal rows; those of no pair are left out.
    """
    wanted = pairs.select("a").union(pairs.select("b"))
    sketches = among(sketches, "sig", wanted).groupBy("sig").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    one = sketches.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = sketches.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    def run(batches):
        for x in batches:
            out = []
            for sa, sb in zip(x.column(3).to_pylist(), x.column(4).to_pylist(), strict=True):
                p, q = np.frombuffer(sa, "<i8"), np.frombuffer(sb, "<i8")
                words = min(len(p), len(q))
                out.append(int(np.bitwise_count((fold(p, words) ^ fold(q, words)).view(np.uint64)).sum()))
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(out, pa.int64()), x.column(2)], names=["a", "b", "differ", "size"])

    j = pairs.join(one, "a").join(two, "b").select("a", "b", (F.col("na") + F.col("nb")).alias("size"), "sa", "sb")
    return j.mapInArrow(tidied(run), "a long, b long, differ long, size long")


def least_first(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(docs: DataFrame, key: Column, named: DataFrame, seed: int) -> DataFrame:
    """Rows (a, b) of names of similar sets that span every component of the similarity graph, written to a table."""
    made: list[DataFrame] = []

    def save(df: DataFrame, name: str) -> DataFrame:
        made.append(scratch.save(df, name))
        sweep(docs.sparkSession)
        return made[-1]

    out = scratch.save(spanning(docs, key, named, seed, save), "links")
    scratch.done(*made)
    sweep(docs.sparkSession)
    return out


def spanning(docs: DataFrame, key: Column, named: DataFrame, seed: int, save: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """links(), from intermediate tables that save() writes."""
    by_size = named.where("n > 0").groupBy(F.least("n", F.lit(256)).cast("int")).agg(F.count("*"), F.sum("n")).collect()
    sizes, whole = {r[0]: r[1] for r in by_size}, sum(r[2] for r in by_size)
    reps = named.where("n > 0").groupBy("sig").agg(F.min("k").alias("rep_k"))
    sketches = named.where("n > 0 and sketch is not null")
    folds = sketches.groupBy("sig").agg(F.first("n").alias("n"), F.first("fold").alias("fold"))
    # a bounded number of 64-bit keys
    often = named.where("n is null").groupBy("sig").agg(F.sum("k").alias("c")).orderBy(F.desc("c"), "sig").limit(DEMOTED).collect()
    last = np.sort(np.array([r[0] for r in often], np.int64))
    lists = save(scan_lists(postings(docs, choose_boundary(sizes), last, seed)), "lists")
    near = F.col("differ") * 9 <= F.col("size")
    similar = F.col("inter") * 100 >= F.col("total") * LEAST

    def tried(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """What sketches and texts say of pairs, and the links."""
        rough, told = save(folded(least_first(pairs), folds), "folded"), ["a", "b", "differ", "size"]
        close = rough.where(near & F.col("wide"))
        fine = save(prune(close.select("a", "b"), sketches.select("sig", "n", "sketch")), "pruned")
        sketch = rough.where(~(near & F.col("wide"))).select(told).union(fine.select(told))
        left = save(sketch.where(near), "near")
        slices = -(-SHARE * (left.agg(F.sum("size")).first()[0] or 0) // max(whole, 1)) or 1
        slice_ = F.pmod(F.xxhash64("a", "b"), F.lit(slices))
        exact = reduce(DataFrame.union, [save(compare(left.where(slice_ == i).select("a", "b"), docs, key, reps), "compared") for i in range(slices)])
        return sketch, exact, exact.where(similar).select("a", "b")

    # members of long lists; the one whose elements the most others share stands for the list
    stars = lists.where("key is not null").select("key", F.col("a").alias("sig"), F.shiftright("nr", 32).alias("n"), F.col("nr").bitwiseAND(0xFFFFFFFF).alias("r"))
    score = stars.join(stars.groupBy("key").agg(F.count("*").alias("len")), "key").groupBy("sig").agg(F.sum("len").alias("score"))
    stars = save(stars.join(score, "sig"), "stars")
    lead = stars.groupBy("key").agg(F.max(F.struct("score", "sig"))["sig"].alias("lead"))
    stars = stars.join(lead, "key")
    spokes = stars.where("sig <> lead").select(F.col("lead").alias("a"), F.col("sig").alias("b"))
    sketch, exact, out = tried(lists.where("key is null").select("a", "b").union(spokes))
    if stars.isEmpty():
        return out

    def placed(edges: DataFrame) -> DataFrame:
        """Members with their components and that of their list's first."""
        c = save(components(edges), "parts")
        of = lambda col, name: c.select(F.col("node").alias(col), F.col("root").alias(name))
        p = stars.join(of("sig", "root"), "sig", "left").join(of("lead", "lead_root"), "lead", "left")
        return p.withColumn("root", F.coalesce("root", "sig")).withColumn("lead_root", F.coalesce("lead_root", "lead"))

    # a second one for lists whose members aren't all in the first one's component
    p = placed(out)
    lead2 = p.where("root <> lead_root").groupBy("key").agg(F.max(F.struct("score", "sig", "root")).alias("x")).select("key", F.col("x.sig").alias("a"), F.col("x.root").alias("root_a"))
    known = sketch.select("a", "b")
    again = least_first(p.join(lead2, "key").where("root <> root_a").select("a", F.col("sig").alias("b"))).join(known, ["a", "b"], "left_anti")
    sketch2, _, out2 = tried(again)
    out = out.union(out2)
    # what is left: pairs across components, unless their distances to the list's first rule a link out
    p = placed(out)
    lower = F.least(F.lit(1.0), F.col("differ") * 2 / (F.col("size") + F.col("differ")))
    told = sketch.join(exact, ["a", "b"], "left").select("a", "b", F.coalesce(1 - F.col("inter") / F.col("total"), lower).alias("d"), F.col("inter").isNotNull().alias("sure"))
    p = p.where("sig <> lead").withColumn("a", F.least("lead", "sig")).withColumn("b", F.greatest("lead", "sig")).join(told, ["a", "b"]).join(folds.select("sig", "fold"), "sig").select("key", "sig", "n", "r", "root", "lead_root", "d", "sure", "fold")
    away = save(p.where("root <> lead_root").drop("lead_root"), "away")
    other = p.select("key", *[F.col(c).alias(f"{c}_") for c in ("sig", "n", "r", "root", "d", "sure", "fold")])
    far, slack = F.lit(1 - LEAST / 100 + 1e-9), F.least("n", "n_") * 100 >= F.greatest("n", "n_") * LEAST
    fits = slack & ((F.col("r") + F.col("r_")) * 9 <= F.col("n") + F.col("n_")) & (F.col("root") != F.col("root_")) & (~F.col("sure_") | (F.col("d") <= F.col("d_") + far)) & (~F.col("sure") | (F.col("d_") <= F.col("d") + far))
    fits = fits & (apart("fold", "fold_") * 9 <= F.col("n") + F.col("n_"))
    more = least_first(away.join(other, "key").where(fits).select(F.col("sig").alias("a"), F.col("sig_").alias("b")))
    more = more.join(known.union(sketch2.select("a", "b")), ["a", "b"], "left_anti")
    return out.union(tried(more)[2])


def join(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, and k (the row's name) and root (its component's, null without shingles), of every row.

    The components are exact; not all links are formed (those of long lists span their components), so none are counted.
    """
    key, seed = names(docs) if key is None else key, 0
    told = save(named_sets(docs, key, seed), "sets")
    while not alone(told.where("n > 0"), "sig", "twin"):  # once in very many runs: two sets have one 64-bit name
        done(told)
        seed += 2
        told = save(named_sets(docs, key, seed), "sets")
    edges = links(docs, key, told, seed)
    named = told.where("n is not null").drop("sketch", "fold", "twin")
    comp = components(edges).select(F.col("node").alias("sig"), "root")
    per = named.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("least")).join(comp, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    least = per.groupBy("root").agg(F.min("least").alias("component_id"))
    per = per.join(least, "root").select("sig", "root", "component_id")
    out = named.join(per, "sig", "left")
    comp_id = F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp_id.alias("component_id"), "k", "root")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each component, in all columns of docs: the smallest doc_id's (nulls last).

    Rows without shingles stay; of rows that repeat an id and a text the least by their other columns stays.
    """
    key = names(docs)
    j = join(docs, key)
    best = j.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k")).alias("b")).select(F.col("b.k").alias("_jac_k"))
    stay = best.union(j.where("root is null").select("k").distinct())
    own = docs.withColumn("_jac_own", key)
    got = own.join(stay, F.col("_jac_own") == F.col("_jac_k")).groupBy("_jac_own").agg(least_of(docs, "_jac_doc"))
    return got.select("_jac_doc.*")
