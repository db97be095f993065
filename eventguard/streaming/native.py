"""Event-time windows kept by Spark's own streaming state."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventguard.config import PipelineConfig
from eventguard.operators.windows import tumbling


def window_stream(records: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Closed windows over a stream of classified records, for append output.

    Reads accepted records only, since late and repeated ones must have been routed away
    first: behind the watermark Spark drops rows without a trace. An event may lead its
    processing time by `max_future_skew` seconds at most, by which the watermark waits
    longer; without that limit one event could close windows that are still filling. A
    record that a replay writes again is known by its arrival within the watermark.
    """
    if cfg.max_future_skew is None:
        raise ValueError("windows by watermark need max_future_skew")
    wait = f"{cfg.lateness_seconds + cfg.max_future_skew} seconds"
    valid = records.filter("is_valid").withWatermark("event_time", wait)
    return tumbling(valid.dropDuplicatesWithinWatermark(list(cfg.arrival)), cfg)
