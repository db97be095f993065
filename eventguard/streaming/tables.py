"""Tables written by the stream: a folder per micro-batch, merged by and by.

A micro-batch overwrites only its own folders and writes its state last, so a retried or
replayed micro-batch leaves the same tables. Folders below the base:

    records/piece=N-N/is_valid=B/day=D   classified records of micro-batch N
    parts/piece=N-N                      parts of windows, batch metrics and totals
    keys/piece=N-N/day=D                 keys of its accepted records up to day D, in buckets by key
    closed/piece=N-N                     windows that became final in micro-batch N
    merged/<table>/piece=F-L             the same of micro-batches F to L
    merged/ahead/version=N               accepted records far ahead of time, of merged pieces
    merged/aheadkeys/version=N           their keys
    state/epoch=N                        totals, marks and the manifest after micro-batch N

The manifest in the state names the pieces that make up the tables. Writing the state thus
switches from old pieces to merged ones at once. What a merge replaced is deleted some
micro-batches later, when it is certain that the merging one is not replayed.

The accepted keys are those of the valid records. They lie by the day of their event, so a
micro-batch reads the folders of the days it has events of, and what was kept apart because
its event was far ahead of time. A merge files those of them whose day has come. Keys lie in
buckets, so Spark joins a micro-batch with them without moving them. The newest day of a piece
has a folder of its own for its keys; those before it share one by twos, fours, eights and so
on, so a piece of many days has few files and the days that still come in are read alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from eventguard.config import PipelineConfig, exists, remove
from eventguard.operators.duplicates import KEY
from eventguard.schema import LEDGER, PARTS, PAYLOAD, STATE, WINDOWS

DAY = 86_400
# The day of accepted events that are more than a day ahead of their processing time.
AHEAD = 2_000_000_000
# Records of a file, where a folder of a micro-batch has more of them.
FILE_ROWS = 100_000


def _table_name() -> str:
    return f"eventguard_{uuid.uuid4().hex}"


def event_day() -> Column:
    return F.floor(F.col("event_time").cast("long") / DAY).cast("int")


def far_ahead() -> Column:
    return F.col("event_time").cast("long") > F.col("as_of").cast("long") + DAY


def stored_day() -> Column:
    """Where a record lies; rejected ones are not looked up and have no day."""
    return F.when(F.col("is_valid"), F.when(far_ahead(), F.lit(AHEAD)).otherwise(event_day()))


@dataclass(frozen=True)
class Piece:
    """One stored micro-batch (level 0) or several merged ones, from `first` to `last`."""

    first: int
    last: int
    level: int = 0
    # Days that hold accepted records, and the newest accepted event in epoch seconds.
    days: tuple[int, ...] = ()
    newest_event: int | None = None
    # Whether windows became final in it.
    closed: bool = False
    # Whether folders of its keys hold several days; False in tables of earlier versions.
    shared: bool = True

    @property
    def name(self) -> str:
        return f"piece={self.first}-{self.last}"

    @property
    def key_folders(self) -> dict[int, int]:
        """For each day the day that its folder of keys is named by, the newest one in it.

        From the newest day back the folders hold 1, 2, 4, 8, ... days.
        """
        if not self.shared:
            return {day: day for day in self.days}
        found = sorted((d for d in self.days if d < AHEAD), reverse=True)
        lead = [found[(1 << (at + 1).bit_length() - 1) - 1] for at in range(len(found))]
        return dict(zip(found, lead)) | ({AHEAD: AHEAD} if AHEAD in self.days else {})


@dataclass(frozen=True)
class State:
    cum_valid: int = 0
    cum_dlq: int = 0
    running_total: float = 0.0
    # The newest processing time, and the time up to which windows are final.
    newest_as_of: int | None = None
    closed_until: int | None = None
    # The newest day with accepted events that were not far ahead.
    today: int | None = None
    pieces: tuple[Piece, ...] = ()
    # The version of the records kept apart; -1 before the first.
    ahead: int = -1
    # The oldest micro-batch whose state is kept.
    oldest: int = 0
    # Folders that merges replaced, each with the micro-batch that did.
    trash: tuple[tuple[int, str], ...] = ()


@dataclass(frozen=True)
class Arrivals:
    """What a micro-batch holds: rows, days of its events in time, and the span of days of
    events whose processing time is missing or far off."""

    rows: int
    days: tuple[int, ...]
    low: int | None
    high: int | None


class StreamTables:
    def __init__(self, spark: SparkSession, base: str, carried: T.StructType):
        """`carried`: columns of the records besides the payload (arrival, batch, time, raw text)."""
        self.spark = spark
        self.base = base
        payload = [f for f in PAYLOAD.fields if f.name != "is_valid"]
        self.record_schema = T.StructType([
            *carried.fields, *payload, T.StructField("epoch", T.LongType()),
            T.StructField("piece", T.StringType()), T.StructField("is_valid", T.BooleanType()),
            T.StructField("day", T.IntegerType()),
        ])

    def path(self, table: str, piece: Piece) -> str:
        return f"{self.base}/{'merged/' if piece.level else ''}{table}/{piece.name}"

    def _state_path(self, epoch: int) -> str:
        return f"{self.base}/state/epoch={epoch}"

    def _ahead_path(self, version: int, table: str = "ahead") -> str:
        return f"{self.base}/merged/{table}/version={version}"

    def _read(self, schema: T.StructType, base: str, paths: list[str]) -> DataFrame | None:
        if not paths:
            return None
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def _union(self, schema: T.StructType, *frames: DataFrame | None) -> DataFrame:
        there = [f.select(*schema.fieldNames()) for f in frames if f is not None]
        if not there:
            return self.spark.createDataFrame([], schema)
        out = there[0]
        for frame in there[1:]:
            out = out.unionByName(frame)
        return out

    # Writing one micro-batch

    def write_records(self, df: DataFrame, epoch: int, arrivals: Arrivals) -> dict:
        """Stores classified records; what is counted on the way comes back, without a job of its own.

        Records of a folder meet before they are written, so that there are not as many files
        as tasks for each day; those of a large folder are dealt over several.
        """
        valid, seen = F.col("is_valid"), Observation()
        filed = df.withColumn("epoch", F.lit(epoch).cast("long")).withColumn("day", stored_day())
        of_day, all_files = (
            -(-arrivals.rows // (FILE_ROWS * folders)) or 1 for folders in (max(len(arrivals.days), 1), 1)
        )
        share = F.pmod(F.xxhash64(*df.columns), F.when(valid, F.lit(of_day)).otherwise(F.lit(all_files)))
        dealt = filed.withColumn("_share", share).hint("rebalance", "is_valid", "day", "_share").drop("_share")
        counted = dealt.observe(
            seen, F.count_if(valid).alias("valid"), F.count_if(~valid).alias("dlq"),
            F.coalesce(F.sum(F.when(valid, F.col("amount"))), F.lit(0.0)).alias("amount"),
            F.max(F.col("as_of").cast("long")).alias("newest_as_of"),
            F.max(F.when(valid, F.col("event_time").cast("long"))).alias("newest_event"),
            F.collect_set(F.when(valid, F.col("day"))).alias("days"),
        )
        path = self.path("records", Piece(epoch, epoch))
        counted.write.mode("overwrite").parquet(path, partitionBy=["is_valid", "day"])
        return seen.get

    def write(self, table: str, df: DataFrame, piece: Piece) -> None:
        df.write.mode("overwrite").parquet(self.path(table, piece))

    def write_keys(self, piece: Piece, buckets: int) -> None:
        """Keys of the accepted records of a stored piece, one file for each bucket and folder of days."""
        if piece.days:
            oldest = {}
            for day, lead in piece.key_folders.items():
                oldest[lead] = min(day, oldest.get(lead, day))
            folder = F.lit(None).cast("int")
            for lead in sorted(oldest):  # the condition of the newest folder comes first
                folder = F.when(F.col("day") >= oldest[lead], F.lit(lead)).otherwise(folder)
            valid = self._records([piece], -1).filter("is_valid").withColumn("day", folder)
            self._write_buckets(valid, self.path("keys", piece), buckets)

    def _write_buckets(self, records: DataFrame, path: str, buckets: int) -> None:
        remove(self.spark, path)  # of a first run of this micro-batch
        name = _table_name()
        keys = records.select(*LEDGER.fieldNames(), "day").repartition(buckets, *KEY)
        keys.write.option("path", path).partitionBy("day").bucketBy(buckets, *KEY).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay

    # Reading

    def _paths(self, table: str, pieces: Iterable[Piece], merged: bool) -> list[str]:
        return [self.path(table, p) for p in pieces if bool(p.level) == merged]

    def _records(self, pieces: Iterable[Piece], ahead: int) -> DataFrame:
        """Records of the pieces, and of the version `ahead` of those kept apart."""
        pieces, schema = list(pieces), self.record_schema
        apart = self._read(schema, self._ahead_path(ahead), [self._ahead_path(ahead)]) if ahead >= 0 else None
        if apart is not None:
            apart = apart.withColumns({"is_valid": F.lit(True), "day": F.lit(AHEAD)})
        return self._union(
            T.StructType([f for f in schema.fields if f.name != "piece"]),
            self._read(schema, f"{self.base}/records", self._paths("records", pieces, False)),
            self._read(schema, f"{self.base}/merged/records", self._paths("records", pieces, True)), apart,
        )

    def _small(self, table: str, schema: T.StructType, pieces: Iterable[Piece]) -> DataFrame:
        pieces = list(pieces)
        return self._union(
            schema,
            self._read(schema, f"{self.base}/{table}", self._paths(table, pieces, False)),
            self._read(schema, f"{self.base}/merged/{table}", self._paths(table, pieces, True)),
        )

    def records(self, epoch: int | None = None) -> DataFrame:
        """Classified records of a micro-batch that is not merged yet, or of all."""
        if epoch is not None:
            return self._records([Piece(epoch, epoch)], -1)
        state = self.last_state()
        return self._records(state.pieces, state.ahead)

    def stream(self) -> DataFrame:
        """Classified records as they are stored. A replayed micro-batch comes in again.

        Folders that a merge replaced stay for `keep_epochs` micro-batches; a reader must not
        fall further behind.
        """
        # A file that a replay replaced before it was read is missing; its successor follows.
        reader = self.spark.readStream.schema(self.record_schema).option("ignoreMissingFiles", "true")
        return reader.parquet(f"{self.base}/records")

    def parts(self, pieces: Iterable[Piece] | None = None) -> DataFrame:
        return self._small("parts", PARTS, self.last_state().pieces if pieces is None else pieces)

    def closed(self, state: State | None = None) -> DataFrame:
        """Windows that are final, each once."""
        state = state or self.last_state()
        return self._small("closed", WINDOWS, [p for p in state.pieces if p.closed])

    @contextmanager
    def ledger(self, state: State, arrivals: Arrivals, buckets: int) -> Iterator[DataFrame | None]:
        """Keys accepted before, of the days of the arrivals, and those kept apart.

        Only folders of those days are listed and read, as a table of buckets that lasts as
        long as the context. Keys of other days in them are of other times and match nothing.
        A replay starts from the state before its first run and so does not see that run's keys.
        """
        odd = range(arrivals.low, arrivals.high + 1) if arrivals.low is not None else ()
        near = set(arrivals.days)
        found = [
            (piece.name, lead, f"{self.path('keys', piece)}/day={lead}")
            for piece in state.pieces for lead in sorted({
                lead for day, lead in piece.key_folders.items() if day == AHEAD or day in near or day in odd
            })
        ]
        if state.ahead >= 0:
            found.append(("ahead", AHEAD, f"{self._ahead_path(state.ahead, 'aheadkeys')}/day={AHEAD}"))
        if not found:
            yield None
            return
        name, columns = _table_name(), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LEDGER)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, piece string, day int) USING parquet PARTITIONED BY (piece, day) "
            f"CLUSTERED BY ({', '.join(f'`{k}`' for k in KEY)}) INTO {buckets} BUCKETS LOCATION '{self.base}/keys'"
        )
        try:
            for at in range(0, len(found), 500):
                self.spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
                    f"PARTITION (piece='{piece}', day={day}) LOCATION '{path}'" for piece, day, path in found[at:at + 500]
                ))
            yield self.spark.table(name).select(*LEDGER.fieldNames())
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    # State and manifest

    def load_state(self, epoch: int) -> State:
        """State after micro-batch `epoch`; the start state before the first one."""
        if epoch < 0:
            return State()
        return self._state(self.spark.read.schema(STATE).parquet(self._state_path(epoch)).first())

    def last_state(self) -> State:
        """The state that was written last; there are few, as a merge deletes old ones."""
        path = f"{self.base}/state"
        if not exists(self.spark, path):
            return State()
        schema = T.StructType([*STATE.fields, T.StructField("epoch", T.LongType())])
        last = self.spark.read.schema(schema).parquet(path).orderBy(F.desc("epoch")).drop("epoch").first()
        return State() if last is None else self._state(last)

    @staticmethod
    def _state(row: T.Row) -> State:
        found = row.asDict(recursive=True)
        pieces = tuple(Piece(**{**p, "days": tuple(p["days"]), "shared": bool(p["shared"])}) for p in found["pieces"])
        trash = tuple((t["since"], t["path"]) for t in found["trash"])
        return State(**{**found, "pieces": pieces, "trash": trash})

    def save_state(self, state: State, epoch: int) -> None:
        fields = asdict(state) | {"trash": [{"since": since, "path": path} for since, path in state.trash]}
        text = F.lit(json.dumps(fields))
        row = self.spark.range(0, 1, 1, 1).select(F.from_json(text, STATE).alias("state"))
        row.select("state.*").write.mode("overwrite").parquet(self._state_path(epoch))

    # Merging

    def empty_trash(self, state: State, epoch: int, cfg: PipelineConfig) -> State:
        """Deletes what merges replaced at least `keep_epochs` micro-batches ago."""
        due = [(since, path) for since, path in state.trash if since + cfg.keep_epochs <= epoch]
        for _, path in due:
            remove(self.spark, path)
        return replace(state, trash=tuple(t for t in state.trash if t not in due))

    def merged(self, state: State, epoch: int, cfg: PipelineConfig) -> State:
        """The state with earlier pieces of a level merged where there are `merge_epochs` of them.

        The piece of `epoch` itself is left alone, as a replay overwrites it. Merges read and
        write every record once a level, so a record is rewritten `levels` times at most.
        """
        for level in range(cfg.levels):
            group = [p for p in state.pieces if p.level == level and p.last < epoch]
            if len(group) < cfg.merge_epochs:
                break
            state, old = self._merge(state, group, epoch, cfg)
            state = replace(state, trash=(*state.trash, *((epoch, path) for path in old)))
        return state

    def _merge(
        self, state: State, group: list[Piece], epoch: int, cfg: PipelineConfig
    ) -> tuple[State, list[str]]:
        """One piece for a group, and the folders that it replaces."""
        one, closed = Piece(group[0].first, group[-1].last, group[0].level + 1), [p for p in group if p.closed]
        old = [self.path(t, p) for p in group for t in ("records", "parts", "keys")]
        old += [self.path("closed", p) for p in closed]
        # Records kept apart go through the merges of the lowest level, which are the frequent ones.
        lowest = not group[0].level
        apart = lowest and (state.ahead >= 0 or any(AHEAD in p.days for p in group))
        rows = self._records(group, state.ahead if apart else -1)
        day, today = F.when(F.col("is_valid"), event_day()), state.today
        due = F.coalesce(F.col("day") != AHEAD, F.lit(True))
        if today is not None:
            due |= event_day() <= today
        kept = rows.filter(due).withColumn("day", day)
        if cfg.retain_days is not None and today is not None:
            age = F.coalesce("day", F.floor(F.col("as_of").cast("long") / DAY))
            kept = kept.filter(F.coalesce(age >= today - cfg.retain_days, F.lit(True)))
        seen = Observation()
        kept.hint("rebalance", "is_valid", "day").observe(
            seen, F.collect_set(F.when(F.col("is_valid"), F.col("day"))).alias("days")
        ).write.mode("overwrite").parquet(self.path("records", one), partitionBy=["is_valid", "day"])
        self.write("parts", self.parts(group).hint("rebalance"), one)
        if closed:
            self.write("closed", self._small("closed", WINDOWS, closed).hint("rebalance"), one)
        one = replace(
            one, days=tuple(sorted(seen.get["days"])), closed=bool(closed),
            newest_event=max((p.newest_event for p in group if p.newest_event is not None), default=None),
        )
        self.write_keys(one, cfg.ledger_buckets)
        if apart:
            early = rows.filter(~due).drop("is_valid", "day")
            early.hint("rebalance").write.mode("overwrite").parquet(self._ahead_path(epoch))
            early = self.spark.read.schema(early.schema).parquet(self._ahead_path(epoch))
            some = not early.isEmpty()
            if some:
                self._write_buckets(early.withColumn("day", F.lit(AHEAD)), self._ahead_path(epoch, "aheadkeys"), cfg.ledger_buckets)
            if state.ahead >= 0:
                old += [self._ahead_path(state.ahead), self._ahead_path(state.ahead, "aheadkeys")]
            state = replace(state, ahead=epoch if some else -1)
        if lowest:  # a replay of this micro-batch still needs the state before it
            old += [self._state_path(e) for e in range(state.oldest, epoch - 1)]
            state = replace(state, oldest=max(epoch - 1, 0))
        pieces = [p for p in state.pieces if p not in group] + [one]
        return replace(state, pieces=tuple(sorted(pieces, key=lambda p: p.first))), old
