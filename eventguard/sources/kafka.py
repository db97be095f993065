"""Kafka options for reading transactions, writing results and reading them back.

The connector is a Spark package that the launcher adds (`spark-submit --packages`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventguard.config import PipelineConfig
from eventguard.functions.decode import decode
from eventguard.schema import PAYLOAD


def read_options(cfg: PipelineConfig, *topics: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": cfg.kafka_broker,
        "subscribe": ",".join(topics),
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }


def write_options(cfg: PipelineConfig, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": cfg.kafka_broker, "topic": topic}


def transaction_stream(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Text of the records with their place in the log; `timestamp` is the record time."""
    records = spark.readStream.format("kafka").options(**read_options(cfg, cfg.input_topic)).load()
    return records.select(
        "value", "partition", "offset", F.col("timestamp").alias("record_time")
    )


def result_stream(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Both output topics, decoded and tagged with their topic."""
    options = read_options(cfg, cfg.valid_topic, cfg.dlq_topic)
    return read_back(spark.readStream.format("kafka").options(**options).load())


def read_back(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages (topic, value) with the value decoded, next to the columns of `keep`."""
    return decode(messages.select(*keep, "topic", "value"), schema=PAYLOAD)


def publish(messages: DataFrame, cfg: PipelineConfig, topic: str) -> None:
    """Sends (key, value) rows. At least once: a retried micro-batch sends them again."""
    messages.write.format("kafka").options(**write_options(cfg, topic)).save()
