"""Corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

Every stage keeps the columns of ``documents`` but the last, which returns the
token ids.  Nulls, empty and repeated rows are treated as the operators' own
docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivalry.llm import decontaminate, jaccard_tree, language, secret_scan, sentencepiece_lattice
from rivalry.llm.store import fresh, located, staged

#: Near duplicates: word shingles of five, Jaccard similarity of 0.8 or more.
SHINGLE, NUM, DEN = 5, 80, 100
TOKENIZER = "piece_bpe_32k.model"


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts of no language (null, empty, without a letter) go, and only they if there is none to learn."""
    words = language.train(docs) or {"any": []}
    into = tuple(fresh(docs, "lang_pred", "score"))
    known = language.predict(docs, words, into).filter(F.col(into[0]) != language.UNKNOWN)
    return known.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group the document of the smallest id stays."""
    return jaccard_tree.one_of_each(docs, SHINGLE, NUM, DEN)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold an item of ``benchmark`` go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: each secret becomes its kind in brackets."""
    return secret_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding: (doc_id, lang, source, n_tokens, ids)."""
    import public_tokenizers

    out = sentencepiece_lattice.encode(docs, public_tokenizers.path(TOKENIZER))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [(name, located(stage)) for name, stage in (
    ("language", identify), ("near_duplicates", near_duplicates), ("decontaminate", without_benchmark),
    ("secrets", without_secrets), ("tokens", tokens))]

#: SQL can't express the stages (learned language models, edit distances, a tokenizer); tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
