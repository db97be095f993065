"""The stream that follows both outputs: counters and the newest records of each.

Each micro-batch of the writer gives one part: the counters of its messages and its newest
records per topic. A part is computed from all messages of that micro-batch, so it does not
matter in how many triggers its files come in, and a replay only replaces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from eventguard.config import PipelineConfig, exists
from eventguard.operators.metrics import newest_first, topic_counters
from eventguard.sources.topics import TopicTables


class ReadBack:
    def __init__(self, cfg: PipelineConfig, topics: TopicTables, base: str, newest: int = 50):
        self.cfg = cfg
        self.topics = topics
        self.base = base
        self.newest = newest

    def process_batch(self, df: DataFrame, _: int) -> None:
        # Numbers of the micro-batches that wrote since the last trigger.
        epochs = sorted(r["epoch"] for r in df.select("epoch").distinct().collect())
        if not epochs:
            return
        stored = self.topics.stored(epochs)
        self._replace("counters", topic_counters(self.topics.decoded(stored), ["epoch"]), epochs)
        # The order lies beside the messages, so only the newest are decoded for it.
        place = F.row_number().over(
            Window.partitionBy("epoch", "topic").orderBy(*newest_first(self.cfg))
        )
        newest = stored.withColumn("place", place).filter(F.col("place") <= self.newest)
        self._replace("newest", self.topics.decoded(newest), epochs)

    def _replace(self, table: str, df: DataFrame, epochs: list[int]) -> None:
        """Parts of these micro-batches replace earlier ones; other parts stay."""
        df.repartition(min(len(epochs), 64), "epoch").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("epoch").parquet(f"{self.base}/{table}")

    def parts(self, table: str) -> DataFrame | None:
        path, spark = f"{self.base}/{table}", self.topics.spark
        return spark.read.parquet(path) if exists(spark, path) else None

    def counters(self) -> DataFrame:
        """Messages and amount per topic so far."""
        parts = self.parts("counters")
        if parts is None:
            return self.topics.spark.createDataFrame([], "topic string, n long, amount double")
        return parts.groupBy("topic").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))

    def feed(self, topic: str) -> DataFrame | None:
        """The newest records of a topic, newest first, from the few that each part kept."""
        parts = self.parts("newest")
        if parts is None:
            return None
        return parts.filter(F.col("topic") == topic).orderBy(*newest_first(self.cfg)).limit(self.newest)

    def start(self, trigger: dict | None = None, files_per_trigger: int | None = None) -> StreamingQuery:
        writer = self.topics.stream(files_per_trigger).writeStream.foreachBatch(self.process_batch).option(
            "checkpointLocation", f"{self.base}/checkpoint"
        )
        return (writer.trigger(**trigger) if trigger else writer).start()
