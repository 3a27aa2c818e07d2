"""What several operators share: column access, word hashing, connected components; scratch tables are the package's own."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidegrain.scratch import done, save, sweep

__all__ = ["done", "save", "sweep"]
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def names(docs: DataFrame) -> Column:
    """A long that names a row's id and text: rows that share both have one name, and no others do.

    It is the id itself where no two rows share one and none is null, for which only ids are read. Otherwise it is a 64-bit
    hash with the first seed under which no two rows of one name differ in a second hash (128 bits in all).
    """
    id_, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    if docs.select(id_.alias("id")).groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null").isEmpty():
        return id_
    for seed in range(1, 9):
        name = F.xxhash64(id_, text, F.lit(seed))
        if alone(docs.select(name.alias("name"), F.xxhash64(text, id_, F.lit(-seed)).alias("second")), "name", "second"):
            return name
    raise RuntimeError("no seed gives rows names of their own")


def alone(df: DataFrame, name: str, second: str) -> bool:
    """Whether all rows of a name have one second hash."""
    return df.groupBy(name).agg(F.min(second).alias("a"), F.max(second).alias("b")).where("a <> b").isEmpty()


def docs_of(docs: DataFrame, name: Column | None = None) -> DataFrame:
    """doc_id (long), text (null: empty) and k, the row's name, if one is given; other columns, whatever their names, are left out."""
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")]
    return docs.select(*own, *([name.alias("k")] if name is not None else []))


def least_of(df: DataFrame, alias: str):
    """One of some rows, the least by its columns, as a struct in the columns' order, whatever their names; those of a kind
    that has no order (maps) are compared as JSON text."""
    ordered = F.struct(*[F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() or f.dataType.simpleString() == "variant" else F.col(f"`{f.name}`") for f in df.schema])
    return F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), ordered).alias(alias)


class WordHash(dict):
    """64-bit hashes of words; starts anew when LIMIT words are held, so its memory is bounded."""

    LIMIT = 200_000

    def __missing__(self, w: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        v = self[w] = xxhash.xxh3_64_intdigest(w)
        return v

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads sums of products over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: A multiplier for each position, without linear relations among them.
MULT = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def grams(a: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-grams of a sequence of word hashes."""
    n = len(a) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    s = np.zeros(n, np.uint64)
    for i in range(k):
        s += a[i : i + n] * MULT[i]
    return mix(s)


#: What a Python worker holds between tasks, by operator.
HELD: dict[str, dict] = {}


def forget(own: str) -> None:
    """Drops what other operators hold, and hands its memory back before the task takes its own."""
    if others := set(HELD) - {own}:
        for name in others:
            del HELD[name]
        hand_back()


def hand_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidied(run, own: str = ""):
    """run, on a worker that holds nothing of other operators, and with the memory that it freed handed back at the end of
    each task: workers live on between stages. (forget() is called by name: a nested function would get a copy of HELD.)"""

    def inner(batches):
        forget(own)
        yield from run(batches)
        hand_back()

    return inner


def mapped(df: DataFrame, run, schema: StructType) -> DataFrame:
    """df.mapInArrow(run, schema) for frames whose columns may have any names, such as ones with a dot: inside, all are numbered."""

    def numbered(batches):
        for b in run(batches):
            yield pa.RecordBatch.from_arrays(b.columns, names=[f"c{i}" for i in range(b.num_columns)])

    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    out = plain.mapInArrow(tidied(numbered), StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)]))
    return out.toDF(*schema.names)


def strings(col: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return col.cast(pa.binary()).to_pylist()


#: Nodes that so many edges or more meet, and how many of them, by number of edges, are joined by broadcast (16 bytes each).
HUB, HUBS = 1000, 2**16


def pointed(rows: DataFrame, low: DataFrame) -> DataFrame:
    """rows (u, v) with m, the least of u's neighbourhood. low: u, m, deg.

    The rows of a hub would meet in one task: the HUBS largest go by broadcast, whose size that bounds, and each smaller one has
    at most a HUBS-th of the rows.
    """
    hubs = low.where(F.col("deg") >= HUB).orderBy(F.desc("deg"), "u").limit(HUBS).collect()
    if not hubs:
        return rows.join(low.select("u", "m"), "u")
    few = F.broadcast(rows.sparkSession.createDataFrame([(r["u"], r["m"]) for r in hubs], "u long, m long"))
    return rows.join(few, "u").unionByName(rows.join(few, "u", "left_anti").join(low.select("u", "m"), "u"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a long, b long): rows (node, root) with the smallest node reachable, for nodes with an edge.

    Alternates large-star and small-star steps, each a groupBy whose map-side minimum comes first, until nothing
    changes; no list of neighbours is gathered, and a hub of any degree is spread over all tasks.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = save(e, "edges")
    last = None
    for _ in range(max_rounds):
        # large star: each larger neighbour of u points to the least of u's neighbourhood
        both = e.select("u", "v").union(e.select(F.col("v"), F.col("u"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("deg")).select("u", F.least("u", "m").alias("m"), "deg")
        big = save(pointed(both.where("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v")), "stars")
        # small star: each smaller neighbour of u, and u, points to the least of them
        low2 = big.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("deg"))
        small = pointed(big, low2).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = save(small.union(low2.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        done(e, big)
        e = new
        sign = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if sign == last:
            break
        last = sign
    else:
        raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
    sweep(e.sparkSession)
    roots = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    own = e.select(F.col("v").alias("node")).distinct().join(roots.select("node"), "node", "left_anti").select("node", F.col("node").alias("root"))
    return roots.union(own)
