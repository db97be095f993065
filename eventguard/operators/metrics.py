"""Counts, totals and latest records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventguard.config import PipelineConfig
from eventguard.functions.display import pass_rate
from eventguard.operators.windows import running_sums
from eventguard.schema import METRICS


def _clock_text(time: Column) -> Column:
    return F.concat(F.date_format(time, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))


def batch_metrics(df: DataFrame) -> DataFrame:
    """One row per batch: its latest processing time, counts and accepted amount."""
    amount = F.sum(F.when(F.col("is_valid"), F.col("amount")))
    return df.groupBy("batch_id").agg(
        _clock_text(F.max("as_of")).alias("batch_ts"),
        F.count_if("is_valid").alias("batch_valid"),
        F.count_if(~F.col("is_valid")).alias("batch_dlq"),
        F.coalesce(amount, F.lit(0.0)).alias("batch_amount"),
    )


def merge_batch_metrics(parts: DataFrame) -> DataFrame:
    """The same from stored result parts."""
    return parts.groupBy("batch_id").agg(
        _clock_text(F.timestamp_seconds(F.max("newest_as_of"))).alias("batch_ts"),
        F.sum("valid_count").alias("batch_valid"),
        F.sum("dlq_count").alias("batch_dlq"),
        F.coalesce(F.sum("window_total_amount"), F.lit(0.0)).alias("batch_amount"),
    )


def running_totals(metrics: DataFrame) -> DataFrame:
    """Cumulative metrics, one row per batch."""
    totals = running_sums(metrics, "batch_id", {
        "running_total": "batch_amount",
        "cum_valid_count": "batch_valid",
        "cum_dlq_count": "batch_dlq",
    })
    return totals.withColumnRenamed("batch_ts", "timestamp").select(*METRICS.fieldNames())


def counts_and_rate(df: DataFrame) -> DataFrame:
    counts = df.agg(
        F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("dlq")
    )
    return counts.withColumn("rate", pass_rate(F.col("valid"), F.col("dlq")))


def reason_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("error_reason").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


def side(cfg: PipelineConfig) -> Column:
    """How a read-back message counts: by its topic, or else by its own flag."""
    topic, flag = F.col("topic"), F.col("is_valid")
    return F.when((topic == cfg.valid_topic) | flag, F.lit("valid")).when(
        (topic == cfg.dlq_topic) | ~flag, F.lit("dlq")
    )


def topic_counters(tagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return tagged.groupBy(*by, "topic").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("amount"), F.lit(0.0)).alias("amount")
    )


def newest_first(cfg: PipelineConfig) -> list[Column]:
    return [F.desc(name) for name in ("as_of", *cfg.arrival)]


def latest(df: DataFrame, cfg: PipelineConfig, n: int = 50) -> DataFrame:
    """The feed: last `n` records, newest first."""
    return df.orderBy(*newest_first(cfg)).limit(n)
