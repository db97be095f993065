"""Named queries over a folder of test tables; each runs over the whole `events` table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventguard.config import PipelineConfig, state_width, stored, work_dir
from eventguard.functions.decode import decode, decode_raw, event_time
from eventguard.functions.display import feed_item
from eventguard.operators.classify import classify
from eventguard.operators.duplicates import drop_repeats, rank_in_batch
from eventguard.operators.metrics import (
    batch_metrics, counts_and_rate, latest, merge_batch_metrics, reason_counts, running_totals,
    side, topic_counters,
)
from eventguard.operators.route import (
    dlq_only, messages, repairable, tag_topics, topic_messages, valid_only,
)
from eventguard.operators.rules import REPEAT_ACROSS, first_reason, rules_of
from eventguard.operators.windows import closed_windows, merge_parts, tumbling
from eventguard.plans.fixture import (
    BATCH_ROWS, CONFIG, FIELDS, SKEW, STREAM_WAVES, events, raw_lines, skewed, transactions,
)
from eventguard.schema import PAYLOAD
from eventguard.sources.files import file_stream
from eventguard.sources.kafka import read_back
from eventguard.streaming.native import window_stream
from eventguard.streaming.pipeline import Pipeline, start
from eventguard.streaming.readback import ReadBack
from eventguard.streaming.tables import StreamTables

Query = Callable[[SparkSession, str], DataFrame]

def _wall_clock() -> Column:
    """Event time without zone, as other engines show it."""
    return F.col("event_time").cast("timestamp_ntz").alias("event_time")


def _ts_text() -> Column:
    return F.col("timestamp").alias("ts_text")


def _envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).select(
        F.to_json(F.struct(*FIELDS)).alias("value"), "event_id", "batch_id", "as_of"
    )


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = transactions(spark, sf_dir)
    return df.withColumn("event_time", event_time(F.col("timestamp"), CONFIG))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(transactions(spark, sf_dir), CONFIG)


def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(_envelope(spark, sf_dir)).select(
        "event_id", "user_id", "amount", _ts_text(), "source"
    )


def parse_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(spark, sf_dir).select("event_id", _wall_clock())


def _rule_query(group: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reason = first_reason(rules_of(CONFIG, group)).alias("reason")
        return _timed(spark, sf_dir).select("event_id", reason).filter("reason IS NOT NULL")
    return run


def dup_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions(spark, sf_dir).select("event_id", "batch_id", "user_id", "timestamp")
    return rank_in_batch(rows, CONFIG).select("event_id", "rn")


def dup_cross_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classified(spark, sf_dir).filter(F.col("error_reason") == REPEAT_ACROSS)
    return found.select("event_id")


def error_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir).select("event_id", "is_valid", "error_reason")


def error_reason_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts where a third of all records has one key, with faults of further kinds."""
    return classify(skewed(transactions(spark, sf_dir)), CONFIG).select(
        "event_id", "is_valid", "error_reason"
    )


def _route_query(pick: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return pick(classified(spark, sf_dir)).select(
            "event_id", "user_id", "amount", _ts_text(), "source", _wall_clock(), "error_reason"
        )
    return run


def _encode_query(topic: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sent = messages(classified(spark, sf_dir), CONFIG, keep=("event_id",))[topic]
        fields = [name for name in PAYLOAD.fieldNames() if name != "event_time"]
        return decode(sent, schema=PAYLOAD).select("event_id", "key", *fields, _wall_clock())
    return run


def topic_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_topics(classified(spark, sf_dir), CONFIG).select("topic", "event_id")


def _stored_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs as they lie in their topics, bytes and all, read back and decoded."""
    sent = topic_messages(classified(spark, sf_dir), CONFIG, keep=("event_id",))
    return read_back(sent, keep=("event_id",))


def topic_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_messages(spark, sf_dir).select(
        "topic", side(CONFIG).alias("side"), "event_id", "user_id", "amount", _ts_text(),
        "source", _wall_clock(), "is_valid", "error_reason",
    )


def _feed_query(valid: bool) -> Query:
    """The newest 50 records of one output as the feed shows them."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pick = valid_only if valid else dlq_only
        rows = latest(pick(classified(spark, sf_dir)), CONFIG)
        return rows.select("event_id", *feed_item(valid)).withColumnRenamed("timestamp", "ts_text")
    return run


def window_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling(valid_only(classified(spark, sf_dir)), CONFIG)


def window_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling(valid_only(classified(spark, sf_dir)), CONFIG, ["batch_id"])


def running_totals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The sums use the metrics twice; stored, the records are judged only once.
    return running_totals(stored(batch_metrics(classified(spark, sf_dir)), "metrics"))


def _recent_query(pick: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return latest(pick(classified(spark, sf_dir)), CONFIG).select(
            "event_id", "user_id", "amount", _ts_text(), "source", F.col("error_reason").alias("reason")
        )
    return run


def dedup_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = transactions(spark, sf_dir).select("user_id", "timestamp")
    return drop_repeats(keys, CONFIG).select("user_id", _ts_text())


Follower = Callable[[Pipeline, DataFrame], None]


def _waves(spark: SparkSession, sf_dir: str, base: str, records: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The records as a stream over files, after each wave of arriving files; and the wave.

    A wave holds whole batches, so a micro-batch grows with the data and not in number.
    """
    last = events(spark, sf_dir).agg(F.max("event_id")).first()[0] or 0
    batches = last // BATCH_ROWS + 1
    edges = [batches * wave // STREAM_WAVES * BATCH_ROWS for wave in range(1, STREAM_WAVES)]
    # The first wave is open below and the last one above; an id that is NULL comes first.
    for low, high in zip([None, *edges], [*edges, None]):
        n = F.col("event_id")
        wave = F.lit(True) if low is None else n >= low
        if high is not None:
            wave &= (n < high) if low is not None else (n.isNull() | (n < high))
        # Dealt evenly, since a wave may lie in few of the splits of its table.
        records.filter(wave).hint("rebalance").write.mode("append").parquet(f"{base}/input")
        arrived = spark.read.schema(records.schema).parquet(f"{base}/input").filter(wave)
        yield file_stream(spark, f"{base}/input", records.schema), arrived


def run_stream(
    spark: SparkSession, sf_dir: str, cfg: PipelineConfig = CONFIG, records: DataFrame | None = None,
    topics: bool = False, follow: Follower | None = None,
) -> StreamTables:
    """Streams the whole fixture as JSON records through the pipeline and returns its tables.

    The stream stops and resumes from its checkpoint for each wave. `follow` is called after
    each wave; then the last micro-batch runs once more, as after a crash, and it is called again.
    """
    base = work_dir(spark, "stream")
    pipeline = Pipeline(cfg, base, topics=topics)
    envelope = _envelope(spark, sf_dir) if records is None else records
    for epoch, (source, arrived) in enumerate(_waves(spark, sf_dir, base, envelope)):
        start(source, pipeline, {"availableNow": True}).awaitTermination()
        if follow:
            follow(pipeline, envelope)
    if follow:
        pipeline.process_batch(arrived, epoch)
        follow(pipeline, envelope)
    return pipeline.tables(envelope)


def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stream(spark, sf_dir).records().select("event_id", "is_valid", "error_reason")


def stream_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_parts(run_stream(spark, sf_dir).parts())


def stream_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_totals(merge_batch_metrics(run_stream(spark, sf_dir).parts()))


def stream_window_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that no later record can change any more."""
    return closed_windows(run_stream(spark, sf_dir).parts(), CONFIG)


def stream_window_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows from the table to which each is added once, when it closes."""
    return run_stream(spark, sf_dir).closed()


def _followed(stream: Callable[[Pipeline, DataFrame], DataFrame], name: str) -> Follower:
    """Runs a stream over what the pipeline wrote into a table of its own, from its checkpoint."""
    def follow(pipeline: Pipeline, envelope: DataFrame) -> None:
        out = stream(pipeline, envelope).writeStream.format("parquet").option(
            "checkpointLocation", f"{pipeline.base}/{name}-checkpoint"
        ).trigger(availableNow=True)
        with state_width(envelope.sparkSession):
            query = out.start(f"{pipeline.base}/{name}")
        query.awaitTermination()
    return follow


def stream_window_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows behind Spark's own watermark, kept by its state store in append mode."""
    cfg = replace(CONFIG, max_future_skew=SKEW)
    follow = _followed(lambda pipeline, df: window_stream(pipeline.tables(df).stream(), cfg), "windows")
    tables = run_stream(spark, sf_dir, cfg, follow=follow)
    return spark.read.parquet(f"{tables.base}/windows")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first record of each key of a stream, by Spark's state within the watermark."""
    base = work_dir(spark, "dedup")
    for source, _ in _waves(spark, sf_dir, base, _envelope(spark, sf_dir)):
        records = decode(source)
        timed = records.withColumn("event_time", event_time(F.col("timestamp"), CONFIG))
        out = drop_repeats(timed, CONFIG).select("user_id", _ts_text())
        kept = out.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(
            availableNow=True
        )
        with state_width(spark):
            query = kept.start(f"{base}/kept")
        query.awaitTermination()
    return spark.read.parquet(f"{base}/kept")


def _read_back(spark: SparkSession, sf_dir: str) -> ReadBack:
    """The stream that follows the topic tables, stopped and resumed, also after a replay."""
    found = []

    def follow(pipeline: Pipeline, envelope: DataFrame) -> None:
        back = ReadBack(CONFIG, pipeline.topic_tables(envelope), f"{pipeline.base}/readback")
        back.start({"availableNow": True}).awaitTermination()
        found.append(back)

    run_stream(spark, sf_dir, topics=True, follow=follow)
    return found[-1]


def stream_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_back(spark, sf_dir).counters()


def stream_feed_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 50 records of both outputs, from at most 50 per micro-batch and topic."""
    back = _read_back(spark, sf_dir)
    feeds = back.feed(CONFIG.valid_topic).unionByName(back.feed(CONFIG.dlq_topic))
    return feeds.select("topic", "event_id", "user_id", "amount", _ts_text(), "source", "error_reason")


def _plain_amount() -> list[Column]:
    """The amount, NULL where it is NaN, and whether it is."""
    nan = F.coalesce(F.isnan("amount"), F.lit(False))
    return [F.when(~nan, F.col("amount")).alias("amount"), nan.alias("amount_is_nan")]


def decode_raw_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of all sorts: the fields that fit, the text, and whether it misfits."""
    return decode_raw(raw_lines(spark, sf_dir)).select(
        "event_id", "raw", "corrupt", "user_id", *_plain_amount(), _ts_text(), "source"
    )


def dead_letters_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records of such lines, with the text where the fields do not tell all."""
    return dlq_only(classify(decode_raw(raw_lines(spark, sf_dir)), CONFIG)).select(
        "event_id", "raw", "corrupt", "user_id", *_plain_amount(), _ts_text(), "source", "error_reason"
    )


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream of such lines keeps of rejected records for a second attempt."""
    tables = run_stream(spark, sf_dir, records=raw_lines(spark, sf_dir))
    return repairable(tables.records()).select("event_id", "raw", "corrupt", "error_reason")


def queries() -> dict[str, Query]:
    return {
        "decode_json": decode_json,
        "parse_event_time": parse_event_time,
        "rule_mandatory": _rule_query("mandatory"),
        "rule_type": _rule_query("type"),
        "rule_range": _rule_query("range"),
        "rule_source": _rule_query("source"),
        "rule_lateness": _rule_query("lateness"),
        "dup_in_batch": dup_in_batch,
        "dup_cross_batch": dup_cross_batch,
        "error_reason": error_reason,
        "error_reason_skew": error_reason_skew,
        "reason_counts": lambda spark, sf: reason_counts(classified(spark, sf)),
        "route_valid": _route_query(valid_only),
        "route_dlq": _route_query(dlq_only),
        "encode_valid": _encode_query(CONFIG.valid_topic),
        "encode_dlq": _encode_query(CONFIG.dlq_topic),
        "topic_union": topic_union,
        "topic_counters": lambda spark, sf: topic_counters(_stored_messages(spark, sf)),
        "topic_readback": topic_readback,
        "feed_valid_50": _feed_query(True),
        "feed_dlq_50": _feed_query(False),
        "window_1m": window_1m,
        "window_per_batch": window_per_batch,
        "batch_metrics": lambda spark, sf: batch_metrics(classified(spark, sf)),
        "running_totals": running_totals_query,
        "pass_rate": lambda spark, sf: counts_and_rate(classified(spark, sf)),
        "recent_valid_50": _recent_query(valid_only),
        "recent_dlq_50": _recent_query(dlq_only),
        "dedup_drop": dedup_drop,
        "stream_route": stream_route,
        "stream_window": stream_window,
        "stream_running_totals": stream_running_totals,
        "stream_window_append": stream_window_append,
        "stream_window_final": stream_window_final,
        "stream_window_native": stream_window_native,
        "stream_dedup": stream_dedup,
        "stream_readback": stream_readback,
        "stream_feed_50": stream_feed_50,
        "decode_raw": decode_raw_query,
        "dead_letters_raw": dead_letters_raw,
        "stream_dead_letters": stream_dead_letters,
    }
