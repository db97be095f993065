"""The stream: each micro-batch is classified, stored, summarised and published."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from eventguard.config import PipelineConfig
from eventguard.functions.decode import decode_raw, event_time
from eventguard.operators.classify import classify
from eventguard.operators.route import messages, topic_messages
from eventguard.operators.rules import lag_seconds
from eventguard.operators.windows import ends_at, merge_parts, result_parts
from eventguard.schema import METRICS, PAYLOAD
from eventguard.sources.topics import TopicTables
from eventguard.streaming.tables import AHEAD, Arrivals, Piece, State, StreamTables, event_day, far_ahead

Publisher = Callable[[DataFrame, str], None]


def prepare(df: DataFrame, cfg: PipelineConfig, epoch: int, clock: datetime) -> DataFrame:
    """Decoded records with their text and the columns the rules and tables need."""
    as_of = F.col(cfg.as_of) if cfg.as_of else F.lit(clock.isoformat()).cast("timestamp")
    batch = F.col(cfg.batch_col) if cfg.batch_col else F.lit(epoch)
    carried = df.select(
        "value", *cfg.arrival, batch.cast("long").alias("batch_id"), as_of.alias("as_of")
    )
    return decode_raw(carried)


class Pipeline:
    """Handler for foreachBatch.

    `publish` gets the messages of each topic, if given. With `topics`, messages are kept as
    tables below the base as well, where a replay replaces them.
    """

    def __init__(
        self, cfg: PipelineConfig, base: str, publish: Publisher | None = None, topics: bool = False
    ):
        self.cfg = cfg
        self.base = base
        self.publish = publish
        self.topics = topics

    def tables(self, df: DataFrame) -> StreamTables:
        carried = T.StructType([
            *self._arrival(df),
            T.StructField("batch_id", T.LongType()),
            T.StructField("as_of", T.TimestampType()),
            T.StructField("raw", T.StringType()),
            T.StructField("corrupt", T.BooleanType()),
        ])
        return StreamTables(df.sparkSession, self.base, carried)

    def topic_tables(self, df: DataFrame) -> TopicTables:
        carried = [*self._arrival(df), T.StructField("as_of", T.TimestampType())]
        return TopicTables(df.sparkSession, f"{self.base}/topics", carried)

    def _arrival(self, df: DataFrame) -> list[T.StructField]:
        return [df.schema[name] for name in self.cfg.arrival]

    def process_batch(self, df: DataFrame, epoch: int) -> None:
        """Every step reads what the step before stored; only single rows reach the driver."""
        cfg, tables = self.cfg, self.tables(df)
        state = tables.empty_trash(tables.load_state(epoch - 1), epoch, cfg)
        clock = datetime.now(timezone.utc)
        prepared = prepare(df, cfg, epoch, clock)
        if cfg.cache_input:
            prepared.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            arrivals = self._peek(prepared)
            if arrivals.rows:
                with tables.ledger(state, arrivals, cfg.ledger_buckets) as ledger:
                    seen = tables.write_records(classify(prepared, cfg, ledger), epoch, arrivals)
        finally:
            if cfg.cache_input:
                prepared.unpersist()
        if arrivals.rows:
            state = self._summarise(tables, state, epoch, seen)
            self._publish(df, tables, epoch, seen)
            if cfg.verbose:
                self._show(tables, state, epoch, seen)
        # An empty micro-batch only hands the state on.
        tables.save_state(tables.merged(state, epoch, cfg), epoch)

    def _peek(self, prepared: DataFrame) -> Arrivals:
        """Number of records, and the days of events that are not late.

        Days near the processing time are few. Of events far ahead or without a processing
        time, which may be of any day, only the span of days is kept.
        """
        timed = prepared.withColumn("event_time", event_time(F.col("timestamp"), self.cfg))
        in_time = ~F.coalesce(lag_seconds() > self.cfg.lateness_seconds, F.lit(False))
        near, day = F.coalesce(~far_ahead(), F.lit(False)), event_day()
        odd = F.when(in_time & ~near, day)
        found = timed.agg(
            F.count("*"), F.collect_set(F.when(in_time & near, day)), F.min(odd), F.max(odd)
        ).first()
        return Arrivals(found[0], tuple(found[1]), found[2], found[3])

    def _summarise(self, tables: StreamTables, before: State, epoch: int, seen: dict) -> State:
        """Stores the result parts and the windows that became final; returns the next state."""
        piece = Piece(epoch, epoch, days=tuple(sorted(seen["days"])), newest_event=seen["newest_event"])
        tables.write("parts", result_parts(tables.records(epoch), self.cfg), piece)
        tables.write_keys(piece, self.cfg.ledger_buckets)
        known = lambda *times: max((t for t in times if t is not None), default=None)
        state = replace(
            before,
            cum_valid=before.cum_valid + seen["valid"],
            cum_dlq=before.cum_dlq + seen["dlq"],
            running_total=before.running_total + seen["amount"],
            newest_as_of=known(before.newest_as_of, seen["newest_as_of"]),
            today=known(before.today, *[d for d in piece.days if d < AHEAD]),
        )
        return self._close(tables, state, piece)

    def _close(self, tables: StreamTables, state: State, piece: Piece) -> State:
        """Stores the windows that end between the mark so far and the new one.

        Only pieces with events behind the old mark are read. The mark is the newest processing
        time less the lateness limit: what arrives later and is not late lies behind it.
        """
        length, pieces = self.cfg.window_seconds, (*state.pieces, piece)
        if state.newest_as_of is None:
            return replace(state, pieces=pieces)
        mark, last = (state.newest_as_of - self.cfg.lateness_seconds) // length * length, state.closed_until
        if last is not None and mark <= last:
            return replace(state, pieces=pieces)
        open_pieces = [
            p for p in pieces if p.newest_event is not None and (last is None or p.newest_event >= last - length)
        ]
        end = ends_at()
        due = (end <= mark) if last is None else (end > last) & (end <= mark)
        tables.write("closed", merge_parts(tables.parts(open_pieces).filter(due)), piece)
        return replace(state, pieces=(*state.pieces, replace(piece, closed=True)), closed_until=mark)

    def _publish(self, df: DataFrame, tables: StreamTables, epoch: int, seen: dict) -> None:
        cfg, records = self.cfg, tables.records(epoch)
        if self.topics:
            kept = tuple(dict.fromkeys([*cfg.arrival, "as_of"]))
            self.topic_tables(df).publish(topic_messages(records, cfg, kept), epoch)
        if self.publish is not None:
            counts = {cfg.valid_topic: seen["valid"], cfg.dlq_topic: seen["dlq"]}
            for topic, frame in messages(records, cfg).items():
                if counts[topic]:
                    self.publish(frame, topic)

    def _show(self, tables: StreamTables, state: State, epoch: int, seen: dict) -> None:
        """Windows, metrics and a preview of 20 records on the console."""
        merge_parts(tables.parts([Piece(epoch, epoch)])).show(truncate=False)
        clock = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S UTC")
        tables.spark.createDataFrame(
            [(clock, state.running_total, epoch, seen["valid"], seen["dlq"], state.cum_valid, state.cum_dlq)], METRICS
        ).show(truncate=False)
        shown = [name for name in PAYLOAD.fieldNames() if name != "event_time"]
        tables.records(epoch).select(*shown).show(20, truncate=False)


def start(
    stream: DataFrame, pipeline: Pipeline, trigger: dict | None = None
) -> StreamingQuery:
    """Starts the stream; its checkpoint lies beside its tables and belongs to them."""
    writer = (
        stream.writeStream.foreachBatch(pipeline.process_batch)
        .outputMode("update")
        .option("checkpointLocation", f"{pipeline.base}/checkpoint")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
