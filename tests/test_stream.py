"""The stream against brute force: restarts, replays, late clocks, long-lived keys."""

import glob
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from eventguard import PipelineConfig, work_dir
from eventguard.config import shared_dir
from eventguard.operators.classify import classify
from eventguard.operators.metrics import merge_batch_metrics, running_totals
from eventguard.operators.route import repairable
from eventguard.operators.rules import REPEAT_ACROSS
from eventguard.operators.windows import closed_windows, merge_parts
from eventguard.plans import queries as plans
from eventguard.plans.fixture import FIELDS
from eventguard.schema import PAYLOAD, STATE
from eventguard.sources import topics
from eventguard.sources.files import file_stream
from eventguard.streaming.native import window_stream
from eventguard.streaming.pipeline import Pipeline, start
from eventguard.streaming.readback import ReadBack
from eventguard.streaming.tables import AHEAD, Arrivals, Piece, StreamTables
from tests.brute import verdicts
from tests.test_duplicates import NOW, SCHEMA, skewed, stamp

CFG = PipelineConfig(arrival=("n",), as_of="as_of", cache_input=False)


def envelope(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select(
        F.to_json(F.struct(*FIELDS)).alias("value"), "n", "batch_id",
        F.timestamp_seconds("as_of").alias("as_of"),
    )


def feed(spark, pipeline, rows, first=0):
    """One micro-batch per batch of `rows`."""
    for epoch in sorted({r[1] for r in rows}):
        if epoch >= first:
            pipeline.process_batch(envelope(spark, [r for r in rows if r[1] == epoch]), epoch)
    return pipeline.tables(envelope(spark, []))


def reasons(tables):
    return {r["n"]: r["error_reason"] for r in tables.records().select("n", "error_reason").collect()}


def snapshot(tables):
    return [
        sorted(map(repr, frame.collect()))
        for frame in (tables.records(), tables.parts())
    ]


def record(n, batch, user, text, as_of, amount=5.0, source="web"):
    return (n, batch, user, amount, text, source, as_of)


@pytest.mark.parametrize("cached", [True, False])
def test_micro_batches(spark, cached):
    rows = skewed(600, 3, seed=21)
    pipeline = Pipeline(replace(CFG, cache_input=cached), work_dir(spark, "t"))
    tables = feed(spark, pipeline, rows)
    expected = verdicts(rows)
    assert reasons(tables) == expected
    valid = [r for r in rows if expected[r[0]] is None]
    last = running_totals(merge_batch_metrics(tables.parts())).orderBy("batch_id").collect()[-1]
    assert last["cum_valid_count"] == len(valid)
    assert last["cum_dlq_count"] == len(rows) - len(valid)
    assert last["running_total"] == sum(r[3] for r in valid)
    state = tables.load_state(2)
    assert (state.cum_valid, state.cum_dlq, state.running_total) == (
        last["cum_valid_count"], last["cum_dlq_count"], last["running_total"],
    )
    totals = merge_parts(tables.parts()).agg(F.sum("valid_count"), F.sum("window_total_amount"))
    assert tuple(totals.first()) == (len(valid), last["running_total"])


def test_replay_changes_nothing(spark):
    rows = skewed(300, 3, seed=4)
    pipeline = Pipeline(CFG, work_dir(spark, "t"))
    tables = feed(spark, pipeline, rows)
    before = snapshot(tables)
    assert snapshot(feed(spark, pipeline, rows, first=1)) == before
    assert reasons(tables) == verdicts(rows)


def test_empty_batch_hands_state_on(spark):
    pipeline = Pipeline(CFG, work_dir(spark, "t"))
    rows = [record(0, 0, "A", stamp(NOW), NOW), record(1, 2, "A", stamp(NOW), NOW + 60)]
    pipeline.process_batch(envelope(spark, rows[:1]), 0)
    pipeline.process_batch(envelope(spark, []), 1)
    pipeline.process_batch(envelope(spark, rows[1:]), 2)
    tables = pipeline.tables(envelope(spark, []))
    assert reasons(tables) == verdicts(rows)
    assert [r["batch_id"] for r in merge_batch_metrics(tables.parts()).orderBy("batch_id").collect()] == [0, 2]


def day_rows(days, extra=()):
    """Each micro-batch, a day apart, has a key of its own and repeats one of its own day."""
    rows = []
    for day in range(days):
        as_of = NOW + day * 86_400
        rows += [record(10 * day, day, f"D{day}", stamp(as_of), as_of),
                 record(10 * day + 1, day, f"D{day}", stamp(as_of), as_of)]
    return sorted([*rows, *extra])


ODD_TIMES = [
    record(5, 0, "X", stamp(NOW), NOW + 10**8),  # processing time far ahead: late
    record(6, 0, "F", stamp(NOW + 10**7), NOW),  # event far ahead
    record(15, 1, "P", stamp(NOW + 86_400), NOW - 10**8),  # processing time far back
    record(16, 1, "N", stamp(NOW - 10**7), None),  # none at all: never late
    record(25, 2, "F", stamp(NOW + 10**7), NOW + 2 * 86_400),
    record(26, 2, "N", stamp(NOW - 10**7), None),
    record(27, 2, "P", stamp(NOW + 86_400), None),
]


def days_of(*days):
    return Arrivals(1, days, None, None)


def test_ledger_reads_the_days_of_the_batch(spark):
    """Odd times in the first micro-batches do not make the later ones read more and more."""
    rows = day_rows(6, ODD_TIMES)
    pipeline = Pipeline(CFG, work_dir(spark, "t"))
    tables = feed(spark, pipeline, rows)
    assert reasons(tables) == verdicts(rows)
    read = []
    for epoch in range(1, 6):
        day = (NOW + epoch * 86_400) // 86_400
        with tables.ledger(tables.load_state(epoch - 1), days_of(day), CFG.ledger_buckets) as keys:
            read.append(keys.select(F.input_file_name()).distinct().count())
    assert read[-1] == read[2] <= 3


def test_ledger_stays_where_it_lies(spark):
    """The micro-batch is dealt as the stored keys are; no exchange lies above their scan."""
    rows = skewed(300, 3, seed=4)
    pipeline = Pipeline(CFG, work_dir(spark, "t"))
    tables = feed(spark, pipeline, rows[:200])
    state = tables.last_state()
    records = spark.createDataFrame(rows[200:], SCHEMA).withColumn("as_of", F.timestamp_seconds("as_of"))
    with tables.ledger(state, days_of(*state.pieces[0].days), CFG.ledger_buckets) as keys:
        out = classify(records, CFG, keys)
        lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
        found = {r["n"]: r["error_reason"] for r in out.collect()}
    expected = verdicts(rows)
    assert found == {r[0]: expected[r[0]] for r in rows[200:]}
    # From the scan of the keys up to the join with the micro-batch.
    at = next(i for i, line in enumerate(lines) if "SelectedBucketsCount" in line)
    above, depth = [], len(lines[at])
    for line in reversed(lines[:at + 1]):
        inset = len(line) - len(line.lstrip(" :+-"))
        if inset < depth:
            above, depth = [*above, line], inset
        if "Join" in above[-1]:
            break
    assert len(above) > 1 and not any("Exchange" in line for line in above)
    assert spark.catalog.listTables() == []


def part_files(folder):
    return sum(len([f for f in names if f.startswith("part-")]) for _, _, names in os.walk(folder.removeprefix("file:")))


def test_files_of_a_micro_batch_of_many_days(spark):
    """Files of records come by days, not by days and tasks; folders of keys hold ever more days."""
    days = 20
    rows = [
        record(n, 0, f"U{n % 10}", stamp(NOW + n // 10 * 86_400), NOW + n // 10 * 86_400, amount=5.0 if n % 10 else None)
        for n in range(10 * days)
    ]
    later = [record(1000 + n, 1, *r[2:3], r[4], None) for n, r in enumerate(rows)]  # never late: of any day
    pipeline = Pipeline(CFG, work_dir(spark, "t"))
    with_width = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for name, value in (("spark.sql.shuffle.partitions", "8"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
            spark.conf.set(name, value)
        tables = feed(spark, pipeline, rows)
        piece = tables.last_state().pieces[0]
        # A folder for each day, and one for the rejected records.
        assert len(piece.days) == days and part_files(tables.path("records", piece)) == days + 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", with_width)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    first = (NOW // 86_400)
    assert set(os.listdir(tables.path("keys", piece).removeprefix("file:"))) - {"_SUCCESS", "._SUCCESS.crc"} == {
        f"day={first + back}" for back in (19, 18, 16, 12, 4)
    }
    tables = feed(spark, pipeline, [*rows, *later], first=1)
    assert reasons(tables) == verdicts([*rows, *later])


def test_keys_of_an_earlier_version(spark):
    """Pieces stored before folders of keys held several days are read by the day."""
    assert Piece(0, 0, days=(4, 5, 6, AHEAD), shared=False).key_folders == {d: d for d in (4, 5, 6, AHEAD)}
    assert Piece(0, 0, days=(4, 5, 6, AHEAD)).key_folders == {6: 6, 5: 5, 4: 5, AHEAD: AHEAD}
    tables = feed(spark, Pipeline(CFG, work_dir(spark, "t")), day_rows(1))
    row = spark.read.parquet(f"{tables.base}/state/epoch=0").withColumn(
        "pieces", F.transform("pieces", lambda p: p.dropFields("shared"))
    )
    row.write.parquet(f"{tables.base}/earlier")
    state = tables._state(spark.read.schema(STATE).parquet(f"{tables.base}/earlier").first())
    assert [p.shared for p in state.pieces] == [False]


def stored_files(tables):
    """Files below the folders that a micro-batch may list."""
    root = tables.base.removeprefix("file:")
    return sum(
        len([f for f in names if f.startswith("part-")])
        for top in ("records", "parts", "keys", "closed", "merged", "state") for _, _, names in os.walk(f"{root}/{top}")
    )


MERGING = replace(CFG, merge_epochs=3, levels=2, keep_epochs=1)


def test_merged_pieces(spark):
    """Many micro-batches, some empty: few pieces, the same verdicts, a replay changes nothing."""
    rows, n, hour = [], 0, 3600
    for epoch in [e for e in range(26) if e not in (4, 5, 13)]:
        as_of = NOW + epoch * hour
        for user, event in (
            (f"U{epoch}", as_of), (f"U{epoch - 1}", as_of - hour), ("A", NOW + 30 * hour), (f"F{epoch // 9}", NOW + 10**7),
        ):
            rows.append(record(n, epoch, user, stamp(event), as_of if event != as_of - hour else None))
            n += 1
    pipeline = Pipeline(MERGING, work_dir(spark, "t"))
    files, by_epoch = [], {}
    for row in rows:
        by_epoch.setdefault(row[1], []).append(row)
    for epoch in range(26):
        pipeline.process_batch(envelope(spark, by_epoch.get(epoch, [])), epoch)
        files.append(stored_files(pipeline.tables(envelope(spark, []))))
    tables = pipeline.tables(envelope(spark, []))
    assert reasons(tables) == verdicts(rows)
    state = tables.load_state(25)
    assert [p.level for p in state.pieces].count(0) <= 4 and len(state.pieces) <= 8
    assert max(files[12:]) < 2 * max(files[:9])
    # The event that was ahead lies by its day, as that has come; the far one still lies apart.
    apart = spark.read.parquet(f"{tables.base}/merged/ahead")
    assert {r["user_id"] for r in apart.collect()} == {"F0", "F1", "F2"}
    before, closed = snapshot(tables), sorted(map(repr, tables.closed().collect()))
    pipeline.process_batch(envelope(spark, by_epoch[25]), 25)
    assert snapshot(tables) == before and sorted(map(repr, tables.closed().collect())) == closed
    assert len(set(closed)) == len(closed) == closed_windows(tables.parts(), CFG).count()
    assert tables.load_state(25) == state


def test_merge_drops_what_is_too_old(spark):
    """With a limit in days, merges leave out older records; counts and windows stay."""
    cfg = replace(MERGING, retain_days=3)
    rows = day_rows(10)
    pipeline = Pipeline(cfg, work_dir(spark, "t"))
    tables = feed(spark, pipeline, rows)
    kept = {r["n"] // 10 for r in tables.records().select("n").collect()}
    assert kept == {6, 7, 8, 9} | {e for p in tables.last_state().pieces if not p.level for e in (p.first,)}
    assert merge_parts(tables.parts()).agg(F.sum("valid_count")).first()[0] == 10
    assert tables.last_state().cum_valid == 10


def test_crash_before_the_state_is_written(spark, monkeypatch):
    """A micro-batch that merged and then failed runs again and leaves the same tables."""
    rows = day_rows(4)
    whole = feed(spark, Pipeline(MERGING, work_dir(spark, "t")), rows)
    pipeline = Pipeline(MERGING, work_dir(spark, "t"))
    tables = feed(spark, pipeline, rows[:6])
    last = envelope(spark, rows[6:])

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(StreamTables, "save_state", fail)
        with pytest.raises(OSError):
            pipeline.process_batch(last, 3)
    assert reasons(tables) == verdicts(rows[:6])
    pipeline.process_batch(last, 3)
    assert snapshot(tables) == snapshot(whole) and tables.load_state(3).pieces == whole.load_state(3).pieces


def test_text_of_rejected_records(spark):
    """The text of a record that a rule of its own rejects stays, whatever it is."""
    texts = [None, "", "no", '{"user_id":"A","amount":"5"}', '{"user_id":"A"}']
    good = envelope(spark, [record(9, 0, "A", stamp(NOW), NOW), record(10, 0, "A", stamp(NOW), NOW)])
    odd = spark.createDataFrame([(t, i, 0, NOW) for i, t in enumerate(texts)], "value string, n long, batch_id long, s long")
    odd = odd.select("value", "n", "batch_id", F.timestamp_seconds("s").alias("as_of"))
    pipeline = Pipeline(CFG, work_dir(spark, "t"))
    pipeline.process_batch(good.select(*odd.columns).unionByName(odd), 0)
    records = pipeline.tables(good).records()
    found = {r["n"]: (r["raw"], r["corrupt"], r["is_valid"]) for r in records.collect()}
    assert found == {
        **{i: (t, i < 4, False) for i, t in enumerate(texts)}, 9: (None, False, True), 10: (None, False, False),
    }
    assert {r["n"] for r in repairable(records).collect()} == {1, 2, 3, 4}


def test_topic_tables_follow_a_replay(spark):
    """A replay replaces the messages of its micro-batch; counters and feeds follow it."""
    base = work_dir(spark, "t")
    pipeline = Pipeline(CFG, base, topics=True)
    rows = [record(i, i // 30, f"U{i}", stamp(NOW + i), NOW + i, amount=2.0) for i in range(90)]
    tables = pipeline.topic_tables(envelope(spark, []))
    back = ReadBack(CFG, tables, f"{base}/back", newest=20)

    def follow():
        back.start({"availableNow": True}, files_per_trigger=1).awaitTermination()
        return {r["topic"]: (r["n"], r["amount"]) for r in back.counters().collect()}

    feed(spark, pipeline, rows[:60])
    assert follow() == {"transactions_valid": (60, 120.0)}
    feed(spark, pipeline, rows)
    changed = [replace_amount(r, 3.0 if r[0] < 85 else None) for r in rows[60:]]
    pipeline.process_batch(envelope(spark, changed), 2)
    assert follow() == {"transactions_valid": (85, 195.0), "transactions_dlq": (5, 0.0)}
    assert follow() == {"transactions_valid": (85, 195.0), "transactions_dlq": (5, 0.0)}
    newest = back.feed("transactions_valid").collect()
    assert [r["n"] for r in newest] == list(range(84, 64, -1)) and newest[0]["amount"] == 3.0
    per_part = back.parts("newest").groupBy("epoch", "topic").count().collect()
    assert max(r["count"] for r in per_part) == 20


def test_newest_are_chosen_before_they_are_decoded(spark, monkeypatch):
    """Counters decode all messages, the feed only those that it keeps."""
    base, decoded = work_dir(spark, "t"), []
    pipeline = Pipeline(CFG, base, topics=True)
    feed(spark, pipeline, [record(i, 0, f"U{i}", stamp(NOW + i), NOW + i) for i in range(60)])
    plain = topics.read_back
    monkeypatch.setattr(topics, "read_back", lambda df, keep=(): (decoded.append(df.count()), plain(df, keep))[1])
    back = ReadBack(CFG, pipeline.topic_tables(envelope(spark, [])), f"{base}/back", newest=7)
    back.start({"availableNow": True}).awaitTermination()
    assert decoded == [60, 7]
    assert [r["n"] for r in back.feed("transactions_valid").collect()] == list(range(59, 52, -1))


@pytest.mark.parametrize("name, state", [("stream_dedup", "dedup-*/checkpoint"), ("stream_window_native", "stream-*/windows-checkpoint")])
def test_state_partitions_follow_the_cores(spark, small, name, state):
    """A stream's state is not cut into as many parts as a wide shuffle; the setting stays."""
    width, root = spark.conf.get("spark.sql.shuffle.partitions"), shared_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{root}/{state}/state/*/*"))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        plans.queries()[name](spark, small)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    made = [p.split("/")[-2:] for p in set(glob.glob(f"{root}/{state}/state/*/*")) - before]
    parts = [int(part) for operator, part in made if operator == "0" and part.isdigit()]
    assert len(parts) == 2 * spark.sparkContext.defaultParallelism


def replace_amount(row, amount):
    return (*row[:3], amount, *row[4:])


def test_replay_replaces_its_keys(spark):
    """A replay that accepts events of fewer days leaves no key of its first run."""
    pipeline = Pipeline(CFG, work_dir(spark, "t"))
    first = [record(0, 0, "A", stamp(NOW), NOW), record(1, 0, "B", stamp(NOW + 86_400), NOW)]
    feed(spark, pipeline, first)
    again = [*first[:1], record(2, 1, "B", stamp(NOW + 86_400), NOW + 86_400)]
    tables = feed(spark, pipeline, again)
    assert reasons(tables) == verdicts(again)


def test_clock_that_steps_back(spark):
    """A key of an earlier day is still known when the time steps back."""
    rows = [
        record(0, 0, "A", stamp(NOW), NOW),
        record(1, 1, "B", stamp(NOW + 500_000), NOW + 500_000),
        record(2, 2, "A", stamp(NOW), NOW + 100),
        record(3, 2, "B", stamp(NOW + 500_000), NOW + 100),
    ]
    tables = feed(spark, Pipeline(CFG, work_dir(spark, "t")), rows)
    assert reasons(tables) == verdicts(rows)


def test_record_without_processing_time(spark):
    """Such a record is never late, so it can repeat a key of any age."""
    rows = [
        record(0, 0, "A", stamp(NOW), NOW),
        record(1, 1, "B", stamp(NOW + 5000), NOW + 5000),
        record(2, 2, "A", stamp(NOW), None),
        record(3, 2, "C", stamp(NOW), None),
    ]
    found = reasons(feed(spark, Pipeline(CFG, work_dir(spark, "t")), rows))
    assert [found[n] for n in range(4)] == [None, None, REPEAT_ACROSS, None]


def test_processing_time_of_the_batch(spark):
    """Without a stored time, old test data is late by the clock and batches are epochs."""
    rows = [record(0, 0, "A", stamp(NOW), NOW)]
    pipeline = Pipeline(replace(CFG, as_of=None), work_dir(spark, "t"))
    tables = feed(spark, pipeline, rows)
    row = tables.records().first()
    assert row["batch_id"] == 0 and row["error_reason"].startswith("Watermark violation")


def test_split_of_copies_does_not_change_validity(spark):
    """Exact copies within the time limit: one is accepted however batches are cut."""
    rows = [record(i, 0, f"U{i % 7}", stamp(NOW), NOW + i) for i in range(60)]
    for cuts in (1, 2, 5):
        split = [(r[0], r[0] * cuts // len(rows), *r[2:]) for r in rows]
        tables = feed(spark, Pipeline(CFG, work_dir(spark, "t")), split)
        found = reasons(tables)
        assert {n for n, reason in found.items() if reason is None} == set(range(7))


def test_published_messages(spark):
    rows = [record(0, 0, "A", stamp(NOW), NOW), record(1, 0, None, stamp(NOW), NOW)]
    sent = {}
    pipeline = Pipeline(
        CFG, work_dir(spark, "t"), lambda df, topic: sent.update({topic: df.collect()})
    )
    feed(spark, pipeline, rows)
    assert {topic: [r["key"] for r in found] for topic, found in sent.items()} == {
        "transactions_valid": ["A"], "transactions_dlq": ["INVALID"],
    }
    sent.clear()
    feed(spark, Pipeline(CFG, work_dir(spark, "t"), pipeline.publish), rows[:1])
    assert list(sent) == ["transactions_valid"]


def test_console(spark, capfd):
    pipeline = Pipeline(replace(CFG, verbose=True), work_dir(spark, "t"))
    feed(spark, pipeline, [record(0, 0, "A", stamp(NOW), NOW)])
    shown = capfd.readouterr().out
    for name in ("running_total", "window_total_amount", "error_reason"):
        assert name in shown


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_restart_from_checkpoint(spark, fmt):
    """A real stream over files, stopped and resumed between two waves."""
    rows = skewed(300, 4, seed=8)
    base = work_dir(spark, "t")
    cfg = replace(CFG, batch_col="batch_id")
    schema = envelope(spark, []).schema
    for wave in (0, 1):
        part = envelope(spark, [r for r in rows if r[1] // 2 == wave]).coalesce(1)
        part.write.mode("append").format(fmt).save(f"{base}/input")
        source = file_stream(spark, f"{base}/input", schema, fmt)
        query = start(source, Pipeline(cfg, base), {"availableNow": True})
        query.awaitTermination()
    tables = Pipeline(cfg, base).tables(envelope(spark, []))
    assert reasons(tables) == verdicts(rows)
    assert {r["epoch"] for r in tables.records().select("epoch").distinct().collect()} == {0, 1}


def test_files_per_trigger(spark):
    """One micro-batch per file; files come in the order in which they were written."""
    rows = skewed(200, 3, seed=13)
    base = work_dir(spark, "t")
    for epoch in range(3):
        part = envelope(spark, [r for r in rows if r[1] == epoch]).coalesce(1)
        part.write.mode("append").parquet(f"{base}/input")
    source = file_stream(spark, f"{base}/input", part.schema, files_per_trigger=1)
    start(source, Pipeline(CFG, base), {"availableNow": True}).awaitTermination()
    tables = Pipeline(CFG, base).tables(part)
    assert reasons(tables) == verdicts(rows)


def test_stream_drops_repeats_within_watermark(spark):
    from eventguard.operators.duplicates import drop_repeats
    base = work_dir(spark, "t")
    df = spark.createDataFrame(
        [("A", "t", NOW), ("A", "t", NOW), ("B", "t", NOW), *[(None, None, NOW)] * 5], "user_id string, timestamp string, s long"
    ).select("user_id", "timestamp", F.timestamp_seconds("s").alias("event_time"))
    df.write.parquet(f"{base}/input")
    kept = drop_repeats(file_stream(spark, f"{base}/input", df.schema), CFG)
    kept.writeStream.format("parquet").option("checkpointLocation", f"{base}/c").trigger(
        availableNow=True
    ).start(f"{base}/out").awaitTermination()
    found = [r["user_id"] for r in spark.read.parquet(f"{base}/out").collect()]
    assert sorted(filter(None, found)) == ["A", "B"] and found.count(None) == 5


def test_closed_windows(spark):
    """An event ahead of time closes nothing early, and a replay counts nothing twice."""
    rows = [
        record(0, 0, "A", stamp(NOW), NOW),
        record(1, 0, "B", stamp(NOW + 10**6), NOW + 1),
        record(2, 1, "C", stamp(NOW + 2), NOW + 30),
        record(3, 2, "D", stamp(NOW + 400), NOW + 400),
    ]
    pipeline = Pipeline(CFG, work_dir(spark, "t"))
    assert closed_windows(feed(spark, pipeline, rows[:3]).parts(), CFG).count() == 0
    for _ in range(2):
        tables = feed(spark, pipeline, rows, first=1)
        closed = closed_windows(tables.parts(), CFG).collect()
        assert [(r["valid_count"], r["window_total_amount"]) for r in closed] == [(2, 10.0)]


def test_watermark_windows_need_a_limit_ahead(spark):
    with pytest.raises(ValueError):
        window_stream(spark.createDataFrame([], "is_valid boolean, event_time timestamp"), CFG)


def test_record_columns(spark):
    tables = feed(spark, Pipeline(CFG, work_dir(spark, "t")), [record(0, 0, "A", stamp(NOW), NOW)])
    assert set(PAYLOAD.fieldNames()) <= set(tables.records().columns)
