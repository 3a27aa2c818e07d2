"""A corpus pipeline of five operators: documents in, digests of their token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A
stage works on all rows that the one before it returned.

  quality          rejects documents that the weak-label classifier scores below one half
  near_duplicates  keeps one document of each group of shingle Jaccard 0.8 or more
  substring_dedup  removes words of 20-word windows that start earlier in the corpus
  mix              takes documents by the low-discrepancy schedule, so sources meet their target weights: a row each
                   time that a document is taken
  bpe              encodes and decodes every text

A null text counts as empty: the quality stage rejects it, and any other text without words. A null doc_id or source is
kept and sorted last. Texts of any length are read whole. Of rows that repeat an id and a text, or share 0.8 of their
shingles, one stays, ties going to the smallest id and then the least by the other columns. An empty table gives an empty
result. Further columns, of any kind and name, are carried along up to the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrain.llm import bpe, fm, jaccard, mix
from tidegrain.llm import quality as labels
from tidegrain.llm.common import done, save, table
from tidegrain.llm.queries import BYTE_BPE, tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return labels.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicated(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fm.dedup(docs).select(*[f"`{c}`" for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # workers that have done the other stages share the executor's memory with what these left there
    return bpe.digest(docs, tokenizer(BYTE_BPE), held=150_000, room=1_000_000)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("mix", mix_sources),
    ("bpe", encode),
]

#: SQL has no EM, no shingle components and no BPE: tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        last, docs = docs, save(stage(spark, docs, sf_dir), name)
        if hasattr(last, "_tidegrain_path"):
            done(last)
    return STAGES[-1][1](spark, docs, sf_dir)
