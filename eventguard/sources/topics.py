"""Topics kept as tables: messages by the micro-batch that sent them, read back as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from eventguard.sources.kafka import read_back


class TopicTables:
    """Messages under `base`/epoch=N/topic=T: key, value, and columns of the record's arrival."""

    def __init__(self, spark: SparkSession, base: str, carried: list[T.StructField]):
        self.spark = spark
        self.base = base
        self.carried = [f.name for f in carried]
        self.schema = T.StructType([
            *carried, T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType()),
            T.StructField("epoch", T.LongType()), T.StructField("topic", T.StringType()),
        ])

    def publish(self, messages: DataFrame, epoch: int) -> None:
        """Puts the messages (topic, key, value, ...) of a micro-batch in the place of earlier ones."""
        messages.write.mode("overwrite").parquet(f"{self.base}/epoch={epoch}", partitionBy=["topic"])

    def stream(self, files_per_trigger: int | None = None) -> DataFrame:
        """All messages as they come in. A replaced micro-batch comes in again."""
        # A file that was replaced before it was read is missing; its successor follows.
        reader = self.spark.readStream.schema(self.schema).option("ignoreMissingFiles", "true")
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        return reader.parquet(self.base)

    def stored(self, epochs: list[int]) -> DataFrame:
        """What some micro-batches sent, as it lies there."""
        paths = [f"{self.base}/epoch={e}" for e in epochs]
        return self.spark.read.schema(self.schema).option("basePath", self.base).parquet(*paths)

    def decoded(self, stored: DataFrame) -> DataFrame:
        return read_back(stored, keep=("epoch", *self.carried))

    def messages(self, epochs: list[int]) -> DataFrame:
        """What some micro-batches sent, decoded."""
        return self.decoded(self.stored(epochs))
