"""Tumbling windows and running sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventguard.config import PipelineConfig, require_utc

WINDOW_TEXT = "yyyy-MM-dd HH:mm:ss"


def ends_at() -> Column:
    """The end of a window in epoch seconds."""
    return F.to_timestamp("window_end", WINDOW_TEXT).cast("long")


def _bounds() -> list[Column]:
    return [
        F.date_format("window.start", WINDOW_TEXT).alias("window_start"),
        F.date_format("window.end", WINDOW_TEXT).alias("window_end"),
    ]


def tumbling_parts(valid: DataFrame, cfg: PipelineConfig, by: Sequence[str] = ()) -> DataFrame:
    """Count and amount per window (and per column of `by`); parts can be merged later."""
    require_utc(valid.sparkSession)
    return (
        valid.filter(F.col("event_time").isNotNull())
        .groupBy(*by, F.window("event_time", cfg.window).alias("window"))
        .agg(F.count("*").alias("valid_count"), F.sum("amount").alias("window_total_amount"))
        .select(*by, *_bounds(), "valid_count", "window_total_amount")
    )


def result_parts(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """One pass over classified records for all per-window, per-batch and total results."""
    require_utc(df.sparkSession)
    valid, as_of = F.col("is_valid"), F.col("as_of").cast("long")
    # The rejected records of a batch share one window before all times.
    time = F.when(valid, F.col("event_time")).otherwise(F.timestamp_seconds(F.lit(0)))
    return (
        df.withColumn("_time", time)
        .groupBy("batch_id", F.window("_time", cfg.window).alias("window"))
        .agg(
            F.count_if(valid).alias("valid_count"),
            F.count_if(~valid).alias("dlq_count"),
            F.sum(F.when(valid, F.col("amount"))).alias("window_total_amount"),
            F.max(as_of).alias("newest_as_of"),
            F.max(F.when(valid, F.col("_time").cast("long"))).alias("newest_event"),
        )
        .select(
            "batch_id", *_bounds(), "valid_count", "dlq_count", "window_total_amount",
            "newest_as_of", "newest_event",
        )
    )


def with_average(parts: DataFrame) -> DataFrame:
    return parts.withColumn(
        "window_avg_amount", F.col("window_total_amount") / F.col("valid_count")
    )


def tumbling(valid: DataFrame, cfg: PipelineConfig, by: Sequence[str] = ()) -> DataFrame:
    return with_average(tumbling_parts(valid, cfg, by))


def merge_parts(parts: DataFrame) -> DataFrame:
    """True result per window from the parts of all micro-batches."""
    merged = parts.filter("valid_count > 0").groupBy("window_start", "window_end").agg(
        F.sum("valid_count").alias("valid_count"),
        F.sum("window_total_amount").alias("window_total_amount"),
    )
    return with_average(merged)


def closed_windows(parts: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """True results of the windows that no later record can change.

    A record that arrives after the newest processing time so far and is not late lies
    behind that time less the lateness limit; windows that end up to there are closed. Exact
    whatever events are ahead of time, and a replay leaves the parts as they were, as long
    as the processing time does not step back.
    """
    require_utc(parts.sparkSession)
    newest = parts.agg(F.max("newest_as_of").alias("_newest"))  # one row
    merged = merge_parts(parts)
    return merged.join(newest, ends_at() <= F.col("_newest") - cfg.lateness_seconds).select(*merged.columns)


def running_sums(
    df: DataFrame, order: str, sums: dict[str, str], block: int = 65_536
) -> DataFrame:
    """Adds running sums (new name -> summed column) along the integer column `order`.

    Rows are summed within blocks of `block` order values; only one row per block meets
    in a single task to carry the totals of the earlier blocks.
    """
    blocks = df.withColumn("_block", F.floor(F.col(order) / F.lit(block)))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocks.groupBy("_block")
        .agg(*[F.sum(column).alias(name) for name, column in sums.items()])
        .select("_block", *[
            F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"_carried_{name}") for name in sums
        ])
    )
    up_to = Window.partitionBy("_block").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inner = blocks.withColumns({
        f"_inner_{name}": F.sum(column).over(up_to) for name, column in sums.items()
    })
    return inner.join(carried, "_block").select(
        *df.columns,
        *[(F.col(f"_inner_{name}") + F.col(f"_carried_{name}")).alias(name) for name in sums],
    )
