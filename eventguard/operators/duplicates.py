"""Repeated records: same (user_id, timestamp) within a batch or across batches.

A key can hold any share of the rows, so no step gathers all rows of one key in one task:
first records of keys come from minima with map-side combine, and verdicts go back to the
records by their arrival, which is unique and so spreads evenly. One plan serves all sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventguard.config import PipelineConfig
from eventguard.operators.rules import missing

KEY = ["user_id", "timestamp"]


def keyed() -> Column:
    """Records without user or timestamp fail earlier rules and need no ranking."""
    return ~(missing("user_id") | missing("timestamp"))


def arrival(cfg: PipelineConfig) -> Column:
    names = cfg.arrival
    return F.col(names[0]) if len(names) == 1 else F.struct(*names)


def mark_duplicates(
    df: DataFrame, cfg: PipelineConfig, ledger: DataFrame | None = None
) -> DataFrame:
    """Adds `repeat_in_batch` and `accepted_before` to a frame with `clean`.

    `repeat_in_batch`: an earlier record of the batch, good or bad, has the same key.
    `accepted_before`: the record is clean and opens its key in the batch, but the key was
    accepted in an earlier batch, either of this frame or of the `ledger`.
    """
    columns = df.columns
    df = df.withColumn("_arrival", arrival(cfg))
    place = ["_arrival", *KEY]
    heads = df.filter(keyed()).groupBy(*KEY, *cfg.batch_cols).agg(
        F.min("_arrival").alias("_first"),
        F.min(F.when(F.col("clean"), F.col("_arrival"))).alias("_first_clean"),
    )
    firsts = heads.select(F.col("_first").alias("_arrival"), *KEY, F.lit(True).alias("_opens"))
    opened = heads.filter(F.col("_first") == F.col("_first_clean"))
    winners = opened.groupBy(*KEY).agg(F.min("_first").alias("_arrival"))
    if ledger is not None:
        # Dealt as the ledger's buckets are, so that only the winners move.
        winners = winners.repartition(cfg.ledger_buckets, *KEY).join(ledger.select(*KEY), KEY, "left_anti")
    winners = winners.select(*place, F.lit(True).alias("_wins"))

    # Of records that share an arrival and a key, one counts; the joins serve the window.
    nth = F.row_number().over(Window.partitionBy(*place).orderBy(*place))
    df = df.join(firsts, place, "left").join(winners, place, "left").withColumn("_nth", nth)
    opens = F.coalesce(F.col("_opens") & (F.col("_nth") == 1), F.lit(False))
    df = df.withColumn("repeat_in_batch", keyed() & ~opens)
    candidate = F.col("clean") & ~F.col("repeat_in_batch")
    return df.select(
        *columns, "repeat_in_batch", (candidate & F.col("_wins").isNull()).alias("accepted_before")
    )


def rank_in_batch(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Adds `rn`, the exact place of a record among those with its key in its batch.

    Ranks are taken within runs of `rank_run` arrivals, which bounds a task's group
    for any key; a record's rank then adds the sizes of the earlier runs of its group.
    """
    group = KEY + cfg.batch_cols
    *shard, last = cfg.arrival
    run = [*shard, "_run"]
    df = df.filter(keyed()).withColumn("_run", F.floor(F.col(last) / F.lit(cfg.rank_run)))
    sizes = df.groupBy(*group, *run).agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*group).orderBy(*run).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sizes.withColumn("_before", F.sum("_size").over(earlier))
        .filter(F.col("_before") > 0)
        .drop("_size")
    )
    local = F.row_number().over(Window.partitionBy(*group, *run).orderBy(last))
    return (
        df.withColumn("rn", local.cast("long"))
        .join(offsets, group + run, "left")
        .withColumn("rn", F.col("rn") + F.coalesce("_before", F.lit(0)))
        .drop("_run", "_before")
    )


def drop_repeats(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Keeps one record per key. A stream forgets keys once the watermark passed them.

    Records of a stream that lack user, timestamp or event time have no key to repeat and all
    pass, however old; of the others those behind the watermark go. In a table records with
    the same user and timestamp, NULL included, are one.
    """
    if df.isStreaming:
        known = F.coalesce(keyed() & F.col("event_time").isNotNull(), F.lit(False))
        # Only keyed records move the watermark.
        timed = df.filter(known).withWatermark("event_time", cfg.watermark)
        return timed.dropDuplicatesWithinWatermark(KEY).unionByName(df.filter(~known))
    return df.dropDuplicates(KEY)
