"""From classified records to keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventguard.schema import PAYLOAD


def payload() -> Column:
    """JSON text of the seven output fields; NULL fields are left out."""
    return F.to_json(F.struct(*PAYLOAD.fieldNames()))


def encode(df: DataFrame, null_key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages (key, value); `null_key` stands in for a record without user."""
    return df.select(
        *keep,
        F.coalesce("user_id", F.lit(null_key)).alias("key"),
        payload().alias("value"),
    )
