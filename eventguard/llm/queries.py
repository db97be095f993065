"""Registered queries of the text operators; each covers its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventguard.llm.common import held_out, table
from eventguard.llm import lattice, oracle
from eventguard.llm.bwtmerge import remove_repeated_bytes
from eventguard.llm.codec import decode_ids, encode_texts
from eventguard.llm.decontaminate import find_leaks
from eventguard.llm.fmindex import SubstringConfig, remove_repeats
from eventguard.llm.html import extract_text
from eventguard.llm.knn import nearest
from eventguard.llm.langid import LangConfig, learn, predict_language
from eventguard.llm.linededup import LineConfig, find_repeated_lines
from eventguard.llm.ngramjoin import JoinConfig, similar_groups
from eventguard.llm.quality import score_quality
from eventguard.llm.ranked import search
from eventguard.llm.resample import resample

Query = Callable[[SparkSession, str], DataFrame]


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and the checksum of the text decoded from them."""
    encoded = encode_texts(table(spark, sf_dir, "documents"), ["doc_id"])
    decoded = decode_ids(encoded, ["doc_id", "n_pieces", "ids"], name="decoded")
    return decoded.select("doc_id", "n_pieces", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = JoinConfig(ngram=3, similarity_pct=90)
    return similar_groups(table(spark, sf_dir, "documents"), cfg=cfg)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"]
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeated_lines(table(spark, sf_dir, "documents"), cfg=LineConfig(short_repeats=True))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "text", "lang"
    )
    cfg = LangConfig()
    model = learn(docs.filter(~F.col("held_out")), "text", "lang", cfg)
    return predict_language(docs, model, ["doc_id", "held_out"], cfg=cfg)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = SubstringConfig(window=35)
    return remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"], cfg=cfg).drop("kept_text")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", held_out(F.col("doc_id"), 7).alias("held_out"), "text"
    ).withColumn("learning", ~F.col("held_out"))
    model = lattice.learn(docs, "text", "learning")
    scored = lattice.score_texts(docs, model, ["doc_id", "held_out"])
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("long"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"), ["doc_id"]).drop("kept")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the vectors whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


def queries() -> dict[str, Query]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_html_extraction": op2_html_extraction,
        "op3_ngram_join": op3_ngram_join,
        "op4_decontamination": op4_decontamination,
        "op5_line_dedup": op5_line_dedup,
        "op6_language_id": op6_language_id,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_quality_rules": op8_quality_rules,
        "op9_lm_scoring": op9_lm_scoring,
        "op10_suffix_array_dedup": op10_suffix_array_dedup,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_ranked_search": op12_ranked_search,
        "op13_knn_join": op13_knn_join,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op11_importance_resampling": oracle.RESAMPLING,
        "op12_ranked_search": oracle.SEARCH,
        "op13_knn_join": oracle.TOP_K,
    }
