"""Corpus pipeline: five stages over `documents`, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventguard.llm.codec import encode_texts
from eventguard.llm.common import table, work_dir
from eventguard.llm.decontaminate import drop_leaks
from eventguard.llm.linededup import LineConfig, drop_repeated_lines
from eventguard.llm.ngramjoin import drop_similar
from eventguard.llm.quality import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the weighed rules reject."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first of each group of like lines; a document with no line left goes."""
    return drop_repeated_lines(docs, length="n_chars", cfg=LineConfig(short_repeats=True))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar ones: five words, similarity 0.8."""
    return drop_similar(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage, also with other numbers or names."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every remaining document."""
    return encode_texts(docs, ["doc_id", "lang", "source", "n_chars"])


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]

# SQL expresses neither the estimates of the first stage nor those that build on it; tests
# hold run() against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. Between stages the rows are a table in the shared folder."""
    base = work_dir(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        path = f"{base}/{place}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
