"""Values as shown to people."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rupiah(amount: Column) -> Column:
    """Amount with dots between thousands and at most three decimals after a comma."""
    shown = F.when(amount.isNull() | F.isnan(amount), F.lit(0.0)).otherwise(amount)
    text = F.call_function("format_number", F.round(shown, 3), F.lit("#,##0.###"))
    return F.concat(F.lit("Rp "), F.translate(text, ",.", ".,"))


def pass_rate(valid: Column, dlq: Column) -> Column:
    """Share of valid records in percent with one decimal, 100 when there are none."""
    return F.coalesce(F.round(valid * 100.0 / F.nullif(valid + dlq, F.lit(0)), 1), F.lit(100.0))


def _shown(name: str, default: str) -> Column:
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(default)).alias(name)


def feed_item(valid: bool) -> list[Column]:
    """Columns of one feed entry; missing and empty fields get their stand-in text."""
    amount = F.col("amount")
    if valid:
        return [
            _shown("user_id", "UNKNOWN"),
            rupiah(amount).alias("amount"),
            _shown("timestamp", "N/A"),
            _shown("source", "N/A"),
        ]
    return [
        _shown("user_id", "NULL"),
        F.when(amount.isNull(), F.lit("NULL")).otherwise(rupiah(amount)).alias("amount"),
        _shown("timestamp", "NULL"),
        _shown("source", "UNKNOWN"),
        _shown("error_reason", "Validation Failed"),
    ]
