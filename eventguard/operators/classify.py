"""One verdict per record."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventguard.config import PipelineConfig
from eventguard.functions.decode import event_time
from eventguard.operators.duplicates import mark_duplicates
from eventguard.operators.rules import default_rules, first_reason


def classify(
    df: DataFrame, cfg: PipelineConfig, ledger: DataFrame | None = None
) -> DataFrame:
    """Adds event_time, error_reason and is_valid to decoded records.

    Needs the transaction fields, `as_of`, the arrival columns and, if configured, the
    batch column. `ledger` holds the keys accepted before this frame. Where the frame has the
    texts of the records (`raw`), they stay with those that a rule of their own rejects; the
    others, whose fields tell all, need not carry them through the search for repeats.
    """
    columns = [c for c in df.columns if c != "event_time"]
    rules = default_rules(cfg)
    row_rules = [rule for rule in rules if rule.per_record]
    df = df.withColumn("event_time", event_time(F.col("timestamp"), cfg))
    df = df.withColumn("clean", first_reason(row_rules).isNull())
    if "raw" in columns:
        df = df.withColumn("raw", F.when(~F.col("clean"), F.col("raw")))
    df = mark_duplicates(df, cfg, ledger)
    df = df.select(*columns, "event_time", first_reason(rules).alias("error_reason"))
    return df.withColumn("is_valid", F.col("error_reason").isNull())
