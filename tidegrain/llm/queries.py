"""The registered queries of this subpackage, each a thin use of an operator over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.llm import oracles
from tidegrain.llm.common import table

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def tokenizer(name: str) -> str:
    """Where the public vocabulary file lies; executors hold it at the same path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import bpe

    return bpe.digest(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import html

    return html.extract(table(spark, sf_dir, "pages"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import chat

    probe = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_rows(rows.union(spark.createDataFrame(probe, "conv_id long, turn long, role string, text string"))))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import ann

    e = table(spark, sf_dir, "embeddings")
    return ann.nearest(e, e.where("vec_id % 50 = 0"), k=5)


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import jaccard

    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import mix

    return mix.taken(table(spark, sf_dir, "documents"))


def op7_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import tokenfile

    return tokenfile.read(tokenfile.write(table(spark, sf_dir, "documents"), tokenizer(WORD_BPE), end=1))


def op6_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import lattice

    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.9)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import quality

    return quality.classify(table(spark, sf_dir, "documents"))


def op10_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import fm

    return fm.digest(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import phrases

    return phrases.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)


def op12_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import pit

    return pit.features(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrain.llm import negatives

    e = table(spark, sf_dir, "embeddings")
    e = e.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(e, F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (op1_bpe, op2_ann, op3_html, op4_jaccard, op5_mix, op6_lattice, op7_tokenfile, op8_chat, op9_quality, op10_fm, op11_phrases, op12_features, op13_negatives)}
ORACLES: dict[str, str] = {"op4_jaccard": oracles.JACCARD, "op5_mix": oracles.MIX, "op6_lattice": oracles.VECTORS, "op8_chat": oracles.CHAT, "op10_fm": oracles.SUBSTRINGS, "op11_phrases": oracles.PHRASES, "op12_features": oracles.FEATURES, "op13_negatives": oracles.NEGATIVES}
