"""Runs the Kafka pipeline: spark-submit --packages <kafka connector> -m eventguard."""

from __future__ import annotations

from eventguard.config import PipelineConfig, build_session, shared_dir
from eventguard.sources import kafka
from eventguard.streaming.pipeline import Pipeline, start


def main() -> None:
    spark = build_session()
    # AS_OF_COLUMN=record_time judges lateness by Kafka's time instead of the clock, which
    # keeps a replayed micro-batch from turning late.
    cfg = PipelineConfig.from_env()
    base = cfg.base_dir or f"{shared_dir(spark)}/stream"
    pipeline = Pipeline(cfg, base, lambda df, topic: kafka.publish(df, cfg, topic))
    start(kafka.transaction_stream(spark, cfg), pipeline).awaitTermination()


if __name__ == "__main__":
    main()
