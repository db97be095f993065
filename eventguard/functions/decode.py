"""From JSON text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventguard.config import PipelineConfig
from eventguard.schema import TRANSACTION

_MISFIT = "_misfit"


def decode(df: DataFrame, value: str = "value", schema: StructType = TRANSACTION) -> DataFrame:
    """Replaces the text or bytes in `value` by the fields of `schema`; a field that does
    not fit is NULL, and so are all fields of a text that is no JSON object."""
    others = [c for c in df.columns if c != value]
    return df.select(
        *others, F.from_json(F.col(value).cast("string"), schema).alias("_data")
    ).select(*others, "_data.*")


def decode_raw(df: DataFrame, value: str = "value", schema: StructType = TRANSACTION) -> DataFrame:
    """As `decode`, and keeps the text as `raw` and whether it misfits as `corrupt`.

    A text misfits if it is NULL, blank or no JSON object, or if a field does not fit; the
    fields that do are still decoded. Of a repeated field the last one counts.
    """
    others = [c for c in df.columns if c != value]
    wide = StructType([*schema.fields, StructField(_MISFIT, StringType())])
    text = F.col(value).cast("string")
    parsed = F.from_json(text, wide, {"columnNameOfCorruptRecord": _MISFIT})
    return df.select(*others, text.alias("raw"), parsed.alias("_data")).select(
        *others, "raw", (F.col("_data").isNull() | F.col(f"_data.{_MISFIT}").isNotNull()).alias("corrupt"),
        *[f"_data.{name}" for name in schema.fieldNames()],
    )


def event_time(text: Column, cfg: PipelineConfig) -> Column:
    """Time in UTC named by the text, NULL if it does not fit the pattern.

    The zone is put behind the text, so the session's own zone plays no part.
    """
    return F.try_to_timestamp(F.concat(text, F.lit(" UTC")), F.lit(f"{cfg.timestamp_pattern} VV"))
