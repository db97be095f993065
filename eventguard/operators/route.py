"""Accepted and rejected records go separate ways."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventguard.config import PipelineConfig
from eventguard.functions.encode import encode, payload

# Message keys of records without user.
NO_USER_VALID = "UNKNOWN"
NO_USER_DLQ = "INVALID"


def valid_only(df: DataFrame) -> DataFrame:
    return df.filter("is_valid")


def dlq_only(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_valid"))


def messages(df: DataFrame, cfg: PipelineConfig, keep: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Encoded output per topic."""
    return {
        cfg.valid_topic: encode(valid_only(df), NO_USER_VALID, keep),
        cfg.dlq_topic: encode(dlq_only(df), NO_USER_DLQ, keep),
    }


def tag_topics(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Both outputs as one frame with the topic each record belongs to, in one pass."""
    topic = F.when(F.col("is_valid"), F.lit(cfg.valid_topic)).otherwise(F.lit(cfg.dlq_topic))
    return df.withColumn("topic", topic)


def topic_messages(df: DataFrame, cfg: PipelineConfig, keep: tuple[str, ...] = ()) -> DataFrame:
    """The messages of both outputs as they lie in their topics, tagged, in one pass."""
    no_user = F.when(F.col("is_valid"), F.lit(NO_USER_VALID)).otherwise(F.lit(NO_USER_DLQ))
    return tag_topics(df, cfg).select(
        "topic", *keep, F.coalesce("user_id", no_user).alias("key"),
        payload().cast("binary").alias("value"),
    )


def repairable(df: DataFrame) -> DataFrame:
    """Rejected records with their text, for a second attempt once they are mended.

    `raw` is NULL where the fields tell all: for repeats of a record that was accepted.
    """
    return dlq_only(df).filter(F.col("raw").isNotNull())


def union_topics(valid: DataFrame, dlq: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Two outputs that are stored apart, as one frame tagged with the topic."""
    return valid.withColumn("topic", F.lit(cfg.valid_topic)).unionByName(
        dlq.withColumn("topic", F.lit(cfg.dlq_topic))
    )
