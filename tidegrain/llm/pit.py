"""Point-in-time feature join by augmented interval trees, one for each chunk of a source's time.

A version is usable during [start, end): from its event and its arrival on until it expires. A chunk of a source's time holds
the versions that begin or end within it, in a balanced tree keyed by start with the largest end of each subtree; all
versions that a time stabs are enumerated, and the greatest by (event, arrival, id, further columns) wins. A version that
covers whole chunks isn't put into each of them: its chunks are cut into dyadic stretches, of each stretch only the greatest
version stays, and a chunk that is asked about gets the greatest of its stretches as one more interval of its tree.

Scale: the width of chunks follows the densest part of the data, so that a tree holds a bounded part of a task's share even
where one source has a third of all rows; where no width would do (all at one time), chunks of one unit have no tree at
all, only dyadic stretches, which are aggregated before they are shuffled. Times asked about are made distinct for each
source before they travel. Nothing is broadcast; the driver sees one count for each width tried.

Defined cases: a version without source, event, arrival, expiry or with start >= end is never usable; a question without source or
time gets no winner; of versions that agree in event, arrival and id the greatest by the further columns wins (nulls are least);
repeated questions get an answer each; empty tables give empty results (or questions without winner); extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidegrain.llm.common import parts
from tidegrain.scratch import done, save

#: Intervals of a tree at most and, where data are few, at least; pairs of a time and a tree's node that are looked at together.
MOST, LEAST, FRONTIER = 50_000, 64, 1 << 20
ORDER = ["event", "arrival", "id"]


# ---- the trees of a batch of chunks, as arrays


def levels(lo: np.ndarray, hi: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The nodes of balanced trees over the slices [lo, hi) of one array, from the roots down: a node of [lo, hi) is its middle."""
    out = []
    while len(lo):
        out.append((lo, hi))
        mid = (lo + hi) // 2
        lo, hi = np.concatenate([lo, mid + 1]), np.concatenate([mid, hi])
        keep = lo < hi
        lo, hi = lo[keep], hi[keep]
    return out


def tops(end: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The largest end of the subtree of each node, known by its middle."""
    top = end.copy()
    for lo_, hi_ in reversed(levels(lo, hi)):
        mid = (lo_ + hi_) // 2
        for a, b in ((lo_, mid), (mid + 1, hi_)):
            full = a < b
            top[mid[full]] = np.maximum(top[mid[full]], top[(a[full] + b[full]) // 2])
    return top


def stab(start: np.ndarray, end: np.ndarray, top: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Yields (question, interval) arrays: all intervals of the tree [lo, hi) of each time ``at`` that hold it."""
    # a few questions at a time, so that what is looked at stays bounded however many intervals a time stabs
    size = np.maximum(1, hi - lo)
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // FRONTIER, prepend=0))
    for own in np.split(np.arange(len(at)), cuts):
        q, a, b = own, lo[own], hi[own]
        while len(q):
            some = a < b
            q, a, b = q[some], a[some], b[some]
            mid = (a + b) // 2
            live = top[mid] > at[q]  # else all of the subtree has ended
            q, a, b, mid = q[live], a[live], b[live], mid[live]
            begun = start[mid] <= at[q]  # else the node and its right subtree begin later
            hit = begun & (end[mid] > at[q])
            yield q[hit], mid[hit]
            q, a, b = np.concatenate([q, q[begun]]), np.concatenate([a, mid[begun] + 1]), np.concatenate([mid, b[begun]])


def answered(t: pa.Table) -> pa.Table:
    """Questions of whole chunks, with the row of the version that wins each. t: source, chunk, at (of a question), start, end, ...
    sorted by source, chunk and then by what decides between versions, least first."""
    source = t["source"].combine_chunks().dictionary_encode()
    source = source.indices.to_numpy(zero_copy_only=False)
    chunk, at, start, end = (t[c].fill_null(0).to_numpy() for c in ("chunk", "at", "start", "end"))
    asks = t["at"].is_valid().to_numpy()
    group = np.cumsum((np.diff(source, prepend=-1) != 0) | (np.diff(chunk, prepend=chunk[:1]) != 0))
    held = np.flatnonzero(~asks)
    held = held[np.lexsort((start[held], group[held]))]  # by chunk and start; stable, so rows keep their order within
    s, e, g = start[held], end[held], group[held]
    first = np.flatnonzero(np.diff(g, prepend=-1))
    last = np.append(first[1:], len(g))
    top = tops(e, first, last)
    rows = np.flatnonzero(asks)
    lo, hi = np.searchsorted(g, group[rows], "left"), np.searchsorted(g, group[rows], "right")
    best = np.full(len(rows), -1)
    for q, i in stab(s, e, top, at[rows], lo, hi):
        np.maximum.at(best, q, held[i])  # rows come in the order that decides
    won = best >= 0
    asked = t.take(pa.array(rows[won])).select(["source", "at"])
    own = t.take(pa.array(best[won]))
    return pa.Table.from_arrays([*asked.columns, *(own[c] for c in own.column_names[5:])], names=["source", "at", *own.column_names[5:]])


# ---- in Spark


def usable(versions: DataFrame, columns: list[str]) -> DataFrame:
    v = versions.select("source", F.greatest("event", "arrival").alias("start"), F.col("expiry").alias("end"), *ORDER, *columns)
    return v.where("source is not null and event is not null and arrival is not null and start < end")


def edges(v: DataFrame, width: int) -> DataFrame:
    """A row for each chunk that a version begins or ends in without covering it."""
    a, b = F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width)
    covers = lambda c: (F.col("start") <= c * width) & (F.col("end") >= (c + 1) * width)
    return v.withColumn("chunk", F.explode(F.filter(F.array_distinct(F.array(a, b)), lambda c: ~covers(c))))


def width_of(v: DataFrame, most: int) -> int:
    """The largest power of two such that no source has more than ``most`` intervals in one chunk's tree; 1 at the least."""
    span = v.agg(F.min("start").alias("a"), F.max("end").alias("b")).first()
    if span["a"] is None:
        return 1
    width = 1 << max(0, (span["b"] - span["a"]).bit_length() - 1)
    while width > 1:
        now = edges(v, width).groupBy("source", "chunk").count().agg(F.max("count").alias("n")).first()["n"] or 0
        if now <= most:
            break
        width >>= max(1, min(4, (now // most).bit_length() - 1))  # halves wouldn't do: steps of up to 16
        width = max(1, width)
    return width


def stretches(v: DataFrame, width: int, columns: list[str]) -> tuple[DataFrame, int]:
    """The greatest version of each dyadic stretch of whole chunks that versions cover: (source, level, block, best); number of levels."""
    a, b = F.ceil(F.col("start") / width), F.floor(F.col("end") / width)
    long = v.withColumns({"a": a, "b": b}).where("a < b")
    most = long.agg(F.max(F.col("b") - F.col("a")).alias("n")).first()["n"]
    if most is None:
        return long, 0
    n = int(most).bit_length()

    def at_level(j: Column) -> Column:
        side = F.pow(F.lit(2), j).cast("long")
        lo, hi = F.ceil(F.col("a") / side), F.floor(F.col("b") / side)
        odd = lambda x: F.pmod(x, F.lit(2)) == 1
        some = F.array_compact(F.array(F.when(odd(lo), lo), F.when(odd(hi), hi - 1)))
        return F.when(lo < hi, F.transform(F.array_distinct(some), lambda x: F.struct(j.alias("level"), x.alias("block")))).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))

    each = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(n)), at_level))
    cover = long.select("source", F.struct(*ORDER, *columns).alias("own"), F.explode(each).alias("s"))
    return cover.groupBy("source", "s.level", "s.block").agg(F.max("own").alias("best")), n + 1


def join(questions: DataFrame, versions: DataFrame, columns: list[str] = (), most: int | None = None) -> DataFrame:
    """questions (source, at, and others) with event, arrival, id and ``columns`` of the version that was valid then, null where none was.

    versions: source (string), event, arrival, expiry, id (long) and ``columns``, whose types have an order.
    """
    spark, columns = questions.sparkSession, list(columns)
    v = save(usable(versions, columns), "versions")
    most = most or min(MOST, max(LEAST, v.count() // (4 * parts(spark))))
    width = width_of(v, most)
    asked = questions.where("source is not null and at is not null").select("source", "at").distinct()
    asked = save(asked.withColumn("chunk", F.floor(F.col("at") / width)), "asked")
    whole, n = stretches(v, width, columns)
    fields = ["source", "chunk", "at", "start", "end", *ORDER, *columns]
    rows = edges(v, width).withColumn("at", F.lit(None).cast("long")).select(*fields)
    rows = rows.unionByName(asked, allowMissingColumns=True)
    if n:
        above = asked.select("source", "chunk").distinct().withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        above = above.withColumn("block", F.floor(F.col("chunk") / F.pow(F.lit(2), "level").cast("long")))
        base = above.join(whole, ["source", "level", "block"]).groupBy("source", "chunk").agg(F.max("best").alias("best"))
        rows = rows.unionByName(base.select("source", "chunk", (F.col("chunk") * width).alias("start"), ((F.col("chunk") + 1) * width).alias("end"), "best.*"), allowMissingColumns=True)
    found = save(by_chunk(spark, rows.select(*fields), columns), "found")
    sound = questions.where("source is not null and at is not null").join(found, ["source", "at"], "left")
    out = sound.unionByName(questions.where("source is null or at is null"), allowMissingColumns=True)
    out = save(out, "answers")
    done(v, asked, found)
    return out


def by_chunk(spark: SparkSession, rows: DataFrame, columns: list[str]) -> DataFrame:
    """The winners of all questions among rows, in tasks that hold some whole chunks at a time."""
    kinds = {f.name: f for f in rows.schema}
    schema = StructType([StructField("source", StringType()), StructField("at", LongType()), *(kinds[c] for c in [*ORDER, *columns])])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= 2 * LEAST:
                t = pa.Table.from_batches(held)
                # the last chunk may go on in the next batch
                s, c = t["source"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False), t["chunk"].to_numpy()
                cut = np.flatnonzero((np.diff(s) != 0) | (np.diff(c) != 0))
                if len(cut):
                    yield from answered(t.slice(0, cut[-1] + 1)).to_batches()
                    held = t.slice(cut[-1] + 1).to_batches()
        if held:
            yield from answered(pa.Table.from_batches(held)).to_batches()

    dealt = rows.repartition(parts(spark), "source", "chunk").sortWithinPartitions("source", "chunk", *ORDER, *columns)
    return dealt.mapInArrow(run, schema)


def drawn(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n): the first four groups of eight hex digits of the SHA-256 of a document's decimal number."""
    digest = F.sha2(F.col("doc_id").cast("string"), 256)
    return docs.withColumn("n", F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]))


def features(docs: DataFrame, labels: DataFrame, fresh: int = 20) -> DataFrame:
    """The row of each label: what its document's source had as its latest usable version at the label's time.

    Of documents that share an id, each is a version; the least of their sources is asked about.
    """
    d = drawn(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.col("n_chars").cast("long").alias("n_chars"), "lang"))
    event = F.col("n")[0] % 200_000
    versions = d.select("source", event.alias("event"), (event - 60 + F.col("n")[1] % 1200).alias("arrival"), (event + F.col("n")[2] % 900).alias("expiry"), F.col("doc_id").alias("id"), "n_chars", "lang")
    sources = docs.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("source").alias("source"))
    asks = drawn(labels.select(F.col("doc_id").cast("long").alias("doc_id"))).select("doc_id", (F.col("n")[3] % 200_000).alias("at"))
    known = asks.where("doc_id is not null").join(sources.hint("merge"), "doc_id", "left")
    asks = known.unionByName(asks.where("doc_id is null"), allowMissingColumns=True)
    won = join(asks, versions, ["n_chars", "lang"])
    age = F.col("at") - F.col("event")
    status = F.when(F.col("id").isNull(), "none").when(age > fresh, "stale").otherwise("fresh")
    own = lambda c: F.when(F.col("status") == "fresh", F.col(c)).alias(c)
    return won.withColumns({"age": age, "status": status}).select("doc_id", F.col("at").alias("t"), F.col("id").alias("version_id"), "age", "status", own("n_chars"), own("lang"))
