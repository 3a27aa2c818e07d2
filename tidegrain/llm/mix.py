"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Slots 0, 1, 2, ... take the golden-ratio points frac(i * 0.618...), which are mapped through the cumulative target
shares of the sources: each stretch of slots then holds every source in proportion to its target. Slots are ranked
within their source, and the k-th slot of a source takes the k-th block of that source's stream: its documents in a
shuffled order (by a hash of the id), laid end to end twice and cut into blocks of equal numbers of words.

A source whose target is under FINE blocks, so that a few points more or less would miss it, isn't dealt by the points: its
own blocks are a part of 1/FINE of its target (a word at least), its last block is cut at the target, and its slots are
evenly spread, from a golden-ratio phase by source. The other sources' slots and blocks are as without it.

Targets: the total is ``share`` times all sizes; it is dealt out by weight, no source above ``most`` times its size, and
what a full source leaves is dealt to the rest by weight until none is above. Sources are in order of code points, null
last, with weights repeating. Sizes count words [^\\x20\\x09-\\x0D]+ of the whole text.

Defined cases: a null text has size 0 and is never taken; sources of size 0 get target 0; an empty table gives an empty
result; repeated rows are documents of their own; a source's stream is summed in pieces by hash range, so a source that
holds most rows is no single task; reruns agree, as order and points depend on the data alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrain.llm.common import least_of, names
from tidegrain.scratch import save

GOLDEN = 0.6180339887498949
#: Slots of the schedule: a target is met within a few parts of this many.
SLOTS = 2**18
#: Sources below this many blocks of the schedule get blocks of their own size.
FINE = 256
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, name: Column | None = None) -> DataFrame:
    """doc_id, source, size, the shuffle key and the name (of id and text) of every row."""
    name = names(docs) if name is None else name
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"), name.alias("name"))
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
    return d.select("doc_id", "source", "size", key.alias("h"), "name")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target, lo and hi (the source's stretch of [0, 1)), total: one row per source.

    Water filling in closed form: sources in order of their cap per weight; a source is full if the level that the
    sources after it would share, itself included, is at or above its cap.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    alone = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(alone) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.lit(most) * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    per = per.withColumn("total", F.lit(share) * F.sum("source_size").over(whole))
    per = per.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
    # levels of sources that aren't full are all one level: the first such, as those before it are full
    per = per.withColumn("full", F.col("level") * F.col("w") >= F.col("cap"))
    first = F.min_by(F.when(~F.col("full"), F.col("level")), F.when(~F.col("full"), F.col("cap") / F.col("w"))).over(whole)
    per = per.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(first * F.col("w")))
    at = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("hi", F.try_divide(F.sum("target").over(at.rowsBetween(Window.unboundedPreceding, 0)), F.sum("target").over(whole)))
    per = per.withColumn("lo", F.coalesce(F.lag("hi").over(at), F.lit(0.0)))
    last = F.row_number().over(Window.orderBy(F.col("source").desc_nulls_first())) == 1
    return per.select("source", "source_size", "target", "total", "lo", F.when(last, F.lit(1.0)).otherwise(F.col("hi")).alias("hi"))


def sizing(per: DataFrame, slots: int) -> DataFrame:
    """Adds step (words of a slot of the whole schedule), quota (a small source's words, else null) and block (words of a block)."""
    step = F.greatest(F.lit(1), F.ceil(F.col("total") / slots)).cast("long")
    # by its share, so that a small corpus, whose blocks are single words, is dealt by the points
    small = F.col("target") * slots < F.col("total") * FINE
    quota = F.when(small & (F.col("target") > 0), F.greatest(F.lit(1), F.round("target")).cast("long"))
    own = F.when(quota.isNotNull(), F.greatest(F.lit(1), F.floor(quota / FINE)).cast("long"))
    return per.withColumn("step", step).withColumn("quota", quota).withColumn("block", F.coalesce(own, F.col("step")))


def schedule(per: DataFrame, slots: int = SLOTS) -> DataFrame:
    """slot, source, k (rank of the slot in its source) and block (words of a block): the mix's order."""
    cells, per = 1024, sizing(per, slots)
    points = per.sparkSession.range(slots).select(F.col("id").alias("slot"), (F.col("id") * F.lit(GOLDEN) % 1.0).alias("u"))
    points = points.withColumn("cell", F.floor(F.col("u") * cells))
    # a source's stretch as the cells it touches: an equi-join instead of a range join
    spans = per.where("hi > lo and quota is null").withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * cells), F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)))))
    hit = points.join(spans, "cell").where("u >= lo and u < hi")
    # ranks in pieces: counts by stretch of slots, then within a stretch, so that no source is ranked in one task
    piece = (F.col("slot") / (slots // 64 + 1)).cast("long")
    hit = hit.select("slot", "source", piece.alias("piece"), "block", "total")
    hit = hit.where(F.col("slot") * F.col("block") < F.col("total")).drop("total")  # blocks are whole words: fewer slots may do
    ahead = hit.groupBy("source", "piece").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("source", "piece").orderBy("slot")) - 1
    hit = hit.withColumn("r", rank)
    same = (hit["source"].eqNullSafe(ahead["source"])) & (hit["piece"] == ahead["piece"])
    dealt = hit.join(ahead, same).select("slot", hit["source"], (F.col("base") + F.col("r")).alias("k"), "block")
    phase = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) * F.lit(GOLDEN) % 1.0
    n, used = F.ceil(F.col("quota") / F.col("block")), F.ceil(F.col("total") / F.col("step"))
    small = per.where("quota is not null").withColumn("phase", phase).withColumn("n", n).withColumn("used", used)
    small = small.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return dealt.unionByName(small.select(F.floor((F.col("k") + F.col("phase")) / F.col("n") * F.col("used")).alias("slot"), "source", "k", "block"))


def streams(sizes: DataFrame, cells: int) -> DataFrame:
    """Each document's place [c0, c1) in its source's shuffled stream; hash ranges are summed apart, then put in a row."""
    d = sizes.withColumn("cell", F.floor(F.col("h") / F.lit(float(2**60)) * cells))
    per = d.groupBy("source", "cell").agg(F.sum("size").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    up = F.sum("size").over(Window.partitionBy("source", "cell").orderBy("h", "doc_id", "name").rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("up", up).withColumn("row", F.row_number().over(Window.partitionBy("source", "cell").orderBy("h", "doc_id", "name")))
    same = d["source"].eqNullSafe(per["source"]) & (d["cell"] == per["cell"])
    c1 = F.col("base") + F.col("up")
    return d.join(per, same).select("doc_id", d["source"], "size", "h", "name", "row", (c1 - F.col("size")).alias("c0"), c1.alias("c1"))


def pieces(docs: DataFrame, slots: int = SLOTS, name: Column | None = None, **goal) -> DataFrame:
    """The mix: a row for each document that a taken block touches, with slot, epoch, and the words [w0, w1) that it gives.

    Columns doc_id, name, row, source, size, source_size, target, epoch, slot, w0, w1. Documents that aren't taken have one
    row with null slot and w0 = w1 = 0.
    """
    sizes = save(sized(docs, name), "sizes")  # some 40 bytes a document: texts are read once
    per = save(targets(sizes, **goal), "targets")
    n = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    s = streams(sizes, 64 * int(n)).alias("s")
    p = sizing(per, slots).alias("p")
    at = s.join(p, F.col("s.source").eqNullSafe(F.col("p.source"))).select("s.*", "source_size", "target", "quota", "block")
    twice = at.withColumn("epoch", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("b0", F.col("c0") + F.col("epoch") * F.col("source_size"))
    twice = twice.where("size > 0 and (quota is null or b0 < quota)").withColumn("b1", F.least(F.col("b0") + F.col("size"), F.col("quota")))
    cut = twice.withColumn("k", F.explode(F.sequence(F.expr("b0 div block"), F.expr("(b1 - 1) div block"))))
    cut = cut.withColumn("w0", F.greatest(F.lit(0), F.col("k") * F.col("block") - F.col("b0"))).withColumn("w1", F.least(F.col("b1"), (F.col("k") + 1) * F.col("block")) - F.col("b0"))
    plan = schedule(per, slots).select(F.col("source").alias("ps"), F.col("k").alias("pk"), "slot")
    got = cut.join(plan, F.col("source").eqNullSafe(F.col("ps")) & (F.col("k") == F.col("pk")), "inner")
    names = ["doc_id", "name", "row", "source", "size", "source_size", "target", "epoch", "slot", "w0", "w1"]
    rest = at.select("doc_id", "name", "row", "source", "size", "source_size", "target", F.lit(0).alias("epoch"), F.lit(None).cast("long").alias("slot"), F.lit(0).cast("long").alias("w0"), F.lit(0).cast("long").alias("w1"))
    return got.select(*names).unionByName(rest)


def taken(docs: DataFrame, slots: int = SLOTS, **goal) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) of every row."""
    p = pieces(docs, slots, **goal)
    out = p.groupBy("doc_id", "name", "source", "row", "size", "source_size", "target").agg(F.sum(F.col("w1") - F.col("w0")).alias("taken"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, slots: int = SLOTS, **goal) -> DataFrame:
    """The mixed corpus in the columns of docs: a row for each time that a document is taken.

    Where the last block of a source ends inside a document, that row's text is the words before the end, joined by one
    space, and n_chars, if there is such a column, its length. Rows that repeat an id and a text stand for as many documents.
    """
    name = names(docs)
    p = pieces(docs, slots, name, **goal).where("slot is not null")
    takes = p.groupBy("name", "row", "epoch", "size").agg(F.min("w0").alias("w0"), F.max("w1").alias("w1")).select(*[F.col(c).alias(f"_mix_{c}") for c in ("name", "size", "w0", "w1")])
    one = docs.groupBy(name.alias("_mix_own")).agg(least_of(docs, "_mix_doc"))
    got = one.join(takes, F.col("_mix_own") == F.col("_mix_name"))
    part = F.array_join(F.slice(F.regexp_extract_all(F.col("_mix_doc.text"), F.lit(WORD), F.lit(0)), (F.col("_mix_w0") + 1).cast("int"), (F.col("_mix_w1") - F.col("_mix_w0")).cast("int")), " ")
    text = F.when(F.col("_mix_w1") - F.col("_mix_w0") == F.col("_mix_size"), F.col("_mix_doc.text")).otherwise(part)
    out = got.withColumn("_mix_text", text)
    made = {"text": F.col("_mix_text"), "n_chars": F.length("_mix_text").cast("long")}
    return out.select(*[made.get(c, F.col(f"_mix_doc.`{c}`")).alias(c) for c in docs.columns])
