"""Settings of the pipeline, the session builder and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class PipelineConfig:
    # Defaults of the deployment contract.
    kafka_broker: str = "kafka:29092"
    input_topic: str = "transactions"
    valid_topic: str = "transactions_valid"
    dlq_topic: str = "transactions_dlq"
    amount_min: float = 1.0
    amount_max: float = 10_000_000.0
    sources: tuple[str, ...] = ("mobile", "web", "pos")
    lateness_seconds: int = 180
    window: str = "1 minute"
    watermark: str = "3 minutes"
    timestamp_pattern: str = "yyyy-MM-dd'T'HH:mm:ss'Z'"

    # Where the stream keeps its tables and its checkpoint; None: in the shared folder.
    base_dir: str | None = None

    # Column that holds the processing time of a record. None: the clock of the
    # micro-batch, read once. A stored time (Kafka record time) keeps replays stable.
    as_of: str | None = None
    # Column that names the batch a record belongs to. None: the micro-batch itself.
    batch_col: str | None = None
    # Columns giving the order of arrival; the last one is an integer sequence and
    # together they are unique. In a frame with several batches, arrival must follow
    # the order of the batches.
    arrival: tuple[str, ...] = ("partition", "offset")

    # Longest run of arrivals ranked inside one task.
    rank_run: int = 1_000_000

    # Seconds an event may be ahead of its processing time; None: any. Windows of Spark's own
    # watermark need it, since an event far ahead would close windows that are still filling.
    max_future_skew: int | None = None
    # Buckets of the stored keys: as many tasks join a micro-batch with them. Belongs to a base folder.
    ledger_buckets: int = 16
    # Stored micro-batches that are merged into one piece, and such pieces again, `levels` times.
    merge_epochs: int = 16
    levels: int = 3
    # Micro-batches for which folders that a merge replaced stay, for streams that read them.
    keep_epochs: int = 16
    # Days of events, before the newest, whose records stay when pieces are merged; None: all.
    retain_days: int | None = None

    # Keep the decoded micro-batch while it is read by the key minima and the rules.
    cache_input: bool = True
    verbose: bool = False

    @property
    def window_seconds(self) -> int:
        """Length of a window given as a number and a unit."""
        number, unit = self.window.split()
        return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}[unit.rstrip("s")]

    @property
    def batch_cols(self) -> list[str]:
        return [self.batch_col] if self.batch_col else []

    @classmethod
    def from_env(cls, **overrides) -> "PipelineConfig":
        names = {
            "kafka_broker": "KAFKA_BROKER",
            "input_topic": "INPUT_TOPIC",
            "valid_topic": "VALID_OUTPUT_TOPIC",
            "dlq_topic": "DLQ_TOPIC",
            "base_dir": "CHECKPOINT_DIR",
            "as_of": "AS_OF_COLUMN",
        }
        found = {field: os.environ[env] for field, env in names.items() if env in os.environ}
        if "VERBOSE" in os.environ:
            found["verbose"] = os.environ["VERBOSE"].lower() in ("1", "true", "yes")
        return cls(**{**found, **overrides})


def build_session(app_name: str = "eventguard", **conf: str) -> SparkSession:
    """Session for the pipeline. The master and the shuffle width are left to the launcher."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Two outputs per task (valid, rejected): no sort before the partitioned write.
        .config("spark.sql.maxConcurrentOutputFileWriters", "4")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """The literal Z of the timestamp text means UTC, whatever zone the session had."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Times are shown in the session's zone, so that zone has to be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z"):
        raise ValueError(f"the session's time zone must be UTC, not {zone}")


@contextmanager
def state_width(spark: SparkSession) -> Iterator[None]:
    """Streams started in this context keep their state in two partitions a core, if not fewer.

    Each partition of a state writes files of its own at every trigger, however few its rows.
    The number stays with a stream's checkpoint.
    """
    name = "spark.sql.shuffle.partitions"
    width = spark.conf.get(name)
    spark.conf.set(name, str(min(int(width), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, width)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a local run may do without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="eventguard-")
    return f"{root.rstrip('/')}/eventguard"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it lies; one that is gone already is no fault."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, for results that are used twice."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
