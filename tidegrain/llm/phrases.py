"""Benchmark decontamination by a positional inverted index of the corpus, in DataFrame operations only.

The index is a stored table of postings (term, document, position), each file of it sorted by term, document and position, and
a vocabulary with the length of every list. A phrase is looked up from its rarest term: the list of that term, shifted by
its offset in the phrase, gives the possible starts; the shifted list of the second rarest thins them out, and what is left
is intersected with the lists of the other terms, read only around places that are still possible. Proximity search goes the
same way, with stretches of positions instead of shifted ones.

An index holds the terms of the vocabulary that it is built with: all of a corpus, or (a filter on terms that no test asks
for) those of the tests. Terms are known by a 64-bit hash of which is checked that no two terms of the vocabulary share it; the
words of documents are compared with the vocabulary as text.

Scale: every join by term goes by broadcast only up to BROADCAST rows of the tests' side, and salted beyond, so that a
term, phrase or document that holds a third of all postings is no single task. Joins with lists are keyed by term, document
and position, which spreads them evenly. The places still possible are told to the lists' scan as a set of at most NEAR numbers.

Defined cases: words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after A-Z are lower-cased; a null or empty text has none and
neither hits nor is hit; a test of fewer words than a window is one window; equal windows of several tests are looked up once and
count for each; tests that share an id count as one, a test without an id hits words but is neither counted nor listed;
rows that repeat a document's id and text give a row each; a null doc_id is kept; empty tables give empty results (or rows
without hits); extra columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrain.llm.common import alone, docs_of, names
from tidegrain.scratch import done, save

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What lies between words, and words, before A-Z are lower-cased.
BETWEEN, WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[0-9A-Za-z\x80-\x{10FFFF}]+"
#: Rows of the tests' side that may be broadcast, salts of a larger one, and numbers for places still possible (of BLOCK words each).
BROADCAST, SALTS, NEAR, BLOCK = 200_000, 16, 2**20, 64


def plain(word: Column) -> Column:
    """The word with A-Z, and no other letters, in lower case."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), BETWEEN), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def tokens(docs: DataFrame) -> DataFrame:
    """Rows (k, pos, word) of docs (k, text), positions from 0."""
    cut = docs.select("k", F.split("text", BETWEEN).alias("w"))
    out = cut.select("k", (F.col("w")[0] == "").cast("int").alias("lead"), F.posexplode("w").alias("pos", "word"))
    return out.where("word <> ''").select("k", (F.col("pos") - F.col("lead")).alias("pos"), plain(F.col("word")).alias("word"))


def looked_up(rows: DataFrame, side: DataFrame, on: str, spread: Sequence[str]) -> DataFrame:
    """rows joined with side, whose rows are few for each value of ``on``: by broadcast up to BROADCAST rows, else with hot
    values dealt over SALTS tasks by the columns ``spread`` of rows."""
    if side.limit(BROADCAST + 1).count() <= BROADCAST:
        return rows.join(F.broadcast(side), on)
    salted = side.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS))).join(salted, [on, "salt"]).drop("salt")


def hashed(df: DataFrame, column: str, name: str) -> DataFrame:
    """df with a 64-bit name of a column's values, under a seed that gives no two values one name."""
    for seed in range(1, 9):
        own = df.withColumn(name, F.xxhash64(column, F.lit(seed)))
        if alone(own.select(name, F.xxhash64(F.lit(-seed), column).alias("second")), name, "second"):
            return own
    raise RuntimeError("no seed gives values names of their own")


def windows(tests: DataFrame, n: int = 10) -> DataFrame:
    """Rows (item_id, at, words): the windows of n consecutive words of tests (item_id, text), or all words of shorter ones."""
    w = tests.select("item_id", words_of(F.coalesce("text", F.lit(""))).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - n, F.lit(0)))
    return w.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", "at", F.slice("w", F.col("at") + 1, n).alias("words"))


def vocabulary(words: DataFrame) -> DataFrame:
    """Rows (word, t) of a frame with a column word."""
    return save(hashed(words.select("word").distinct(), "word", "t"), "vocabulary")


@dataclass
class Index:
    """postings: t, k, pos. terms: word, t, n (the length of the list)."""

    postings: DataFrame
    terms: DataFrame

    def drop(self) -> None:
        done(self.postings, self.terms)


def build(docs: DataFrame, terms: DataFrame | None = None) -> Index:
    """The index of docs (k, text) over the words of ``terms`` (word, t), or all words where none are given."""
    terms = vocabulary(tokens(docs)) if terms is None else terms
    found = looked_up(tokens(docs), terms, "word", ["k", "pos"]).select("t", "k", "pos")
    postings = save(found.sortWithinPartitions("t", "k", "pos"), "postings")
    lengths = postings.groupBy("t").agg(F.count("*").alias("n"))
    return Index(postings, save(terms.join(lengths, "t"), "terms"))


def _rarest_first(index: Index, phrases: DataFrame, at: Column) -> DataFrame:
    """Rows (win, size, probes) of phrases (win, words) all of whose words the index has: probes are (n, off, t), rarest
    first. ``at`` is the offset to keep of a word, from its position ``off``."""
    each = phrases.select("win", F.size("words").alias("size"), F.posexplode("words").alias("off", "word")).withColumn("off", at)
    known = looked_up(each.distinct(), index.terms, "word", ["win"])
    per = known.groupBy("win", "size").agg(F.sort_array(F.collect_list(F.struct("n", "off", "t"))).alias("probes"))  # a phrase's words
    return per


def _near(places: DataFrame, postings: DataFrame) -> DataFrame:
    """Of postings those that may lie in places (k, first, last)."""
    number = lambda k, block: F.pmod(F.xxhash64(k, block), F.lit(NEAR))
    block = lambda c: F.floor(F.col(c) / BLOCK)
    here = places.select("k", F.explode(F.sequence(block("first"), block("last"))).alias("block")).select(number("k", "block").alias("number")).distinct()
    return postings.withColumn("number", number("k", block("pos"))).join(F.broadcast(here), "number", "left_semi").drop("number")  # NEAR rows at most


def phrases(index: Index, wanted: DataFrame) -> DataFrame:
    """Rows (win, k, start, size): every place of the phrases (win, words) in the indexed documents."""
    per = _rarest_first(index, wanted, F.col("off"))
    per = save(per.where(F.size("probes") == F.col("size")), "probes")
    first, second = F.col("probes")[0], F.try_element_at("probes", F.lit(2))
    one = per.select("win", "size", first["t"].alias("t"), first["off"].alias("off"), second["t"].alias("t2"), second["off"].alias("off2"))
    starts = looked_up(index.postings, one, "t", ["k", "pos"]).withColumn("start", F.col("pos") - F.col("off")).where("start >= 0")
    starts = save(starts.select("win", "k", "start", "size", "t2", "off2"), "starts")
    # the shifted list of the second rarest word
    lists = looked_up(index.postings, one.select(F.col("t2").alias("t")).where("t is not null").distinct(), "t", ["k", "pos"])
    both = starts.where("t2 is not null").select("win", "k", "start", "size", F.col("t2").alias("t"), (F.col("start") + F.col("off2")).alias("pos"))
    both = save(both.join(lists, ["t", "k", "pos"]).select("win", "k", "start", "size"), "starts")
    # the lists of all other words, near what is left
    more = per.where("size > 2").select("win", F.slice("probes", 3, 2**30).alias("rest"))
    ask = looked_up(both, more, "win", ["k", "start"]).select("win", "k", "start", "size", F.explode("rest").alias("p"))
    ask = ask.select("win", "k", "start", "size", F.col("p.t").alias("t"), (F.col("start") + F.col("p.off")).alias("pos"))
    there = _near(both.select("k", F.col("start").alias("first"), (F.col("start") + F.col("size") - 1).alias("last")), index.postings)
    rest = ask.join(there, ["t", "k", "pos"]).groupBy("win", "k", "start", "size").agg(F.count("*").alias("n")).where("n = size - 2").drop("n")
    short = starts.where("size = 1").select("win", "k", "start", "size").unionByName(both.where("size = 2"))
    out = save(rest.unionByName(short), "places")
    done(per, starts, both)
    return out


def near(index: Index, wanted: DataFrame, span: int = 20) -> DataFrame:
    """Rows (win, k, lo, hi): the stretches of at most ``span`` words that hold all different words of a phrase (win, words) in any
    order, begin at one of them, and end where the last of them comes first."""
    sets = wanted.select("win", F.array_distinct("words").alias("words"))
    per = _rarest_first(index, sets, F.lit(0))
    per = save(per.where(F.size("probes") == F.col("size")).select("win", "size", F.transform("probes", lambda p: p["t"]).alias("ts")), "probes")
    one = per.select("win", F.col("ts")[0].alias("t"))
    hub = looked_up(index.postings, one, "t", ["k", "pos"]).select("win", "k", F.col("pos").alias("p"))
    hub = save(looked_up(hub, per, "win", ["k", "p"]), "hubs")

    def around(asked: DataFrame) -> DataFrame:
        """asked (win, k, p, t) with each position of t within span of p; a bucket of positions and its neighbours are looked up."""
        bucket = F.floor(F.col("pos") / span)
        lists = _near(asked.select("k", F.greatest(F.col("p") - span, F.lit(0)).alias("first"), (F.col("p") + span).alias("last")), index.postings).withColumn("bucket", bucket)
        at = asked.withColumn("bucket", F.explode(F.array(*[F.floor(F.col("p") / span) + i for i in (-1, 0, 1)])))
        return at.join(lists, ["t", "k", "bucket"]).where(F.abs(F.col("pos") - F.col("p")) < span).select("win", "k", "p", "t", "pos")

    # first the second rarest word alone, then all
    pairs = around(hub.where("size > 1").select("win", "k", "p", F.col("ts")[1].alias("t"))).select("win", "k", "p").distinct()
    left = save(hub.join(pairs, ["win", "k", "p"]).unionByName(hub.where("size = 1")), "hubs")
    found = around(left.select("win", "k", "p", F.explode("ts").alias("t")))
    seen = found.groupBy("win", "k", "p").agg(F.collect_list(F.struct("pos", "t")).alias("hits"))  # under two spans of positions
    seen = looked_up(seen, per, "win", ["k", "p"])
    far = F.lit(2**31 - 1)
    least = lambda lo, t: F.coalesce(F.array_min(F.transform(F.filter("hits", lambda y: (y["t"] == t) & (y["pos"] >= lo)), lambda y: y["pos"])), far)
    reach = F.transform("hits", lambda x: F.struct(x["pos"].alias("lo"), F.array_max(F.transform("ts", lambda t: least(x["pos"], t))).alias("hi")))
    kept = F.filter(reach, lambda r: (r["hi"] < r["lo"] + span) & (r["lo"] <= F.col("p")) & (r["hi"] >= F.col("p")))
    out = save(seen.select("win", "k", F.explode(kept).alias("r")).select("win", "k", "r.lo", "r.hi").distinct(), "stretches")
    done(per, hub, left)
    return out


def covered(places: DataFrame) -> DataFrame:
    """Rows (k, n_hit): words of a document inside any of its places (k, start, size)."""
    by = Window.partitionBy("k").orderBy("start")
    ends = places.groupBy("k", "start").agg(F.max(F.col("start") + F.col("size")).alias("end"))
    before = F.coalesce(F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = ends.withColumn("own", F.greatest(F.lit(0), F.col("end") - F.greatest("start", before)))
    return own.groupBy("k").agg(F.sum("own").alias("n_hit"))


def contamination(docs: DataFrame, tests: DataFrame, n: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of docs (doc_id, text), from the exact places of
    the windows of tests (item_id, text)."""
    name = names(docs)
    rows = docs_of(docs, name)
    own = save(windows(tests.select(F.col("item_id").cast("string").alias("item_id"), "text"), n), "windows")
    wanted = save(hashed(own.select("words").distinct(), "words", "win"), "phrases")
    texts = rows.select("k", "text")
    if not rows.groupBy("k").count().where("count > 1").isEmpty():  # rows that repeat an id and a text are indexed once
        texts = texts.dropDuplicates(["k"])
    index = build(texts, vocabulary(wanted.select(F.explode("words").alias("word"))))
    places = phrases(index, wanted)
    of = own.join(wanted, "words").select("win", "item_id").where("item_id is not null").distinct()
    items = looked_up(places.select("win", "k").distinct(), of, "win", ["k"]).select("k", "item_id").distinct()
    listed = items.groupBy("k").agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("item_id")), ","), 256).alias("items_sha256"))
    hit = covered(places).join(listed, "k", "left")
    out = rows.select("doc_id", "k", n_words(F.col("text")).alias("n_words")).join(hit, "k", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce("n_hit", zero) > 0).alias("contaminated")
    )
