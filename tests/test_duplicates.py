"""Repeats against brute force, also where a third of the records has one key."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from eventguard import PipelineConfig
from eventguard.operators import rules
from eventguard.operators.classify import classify
from eventguard.operators.duplicates import drop_repeats, rank_in_batch
from eventguard.operators.windows import tumbling
from tests.brute import verdicts

ONE_BATCH = PipelineConfig(arrival=("n",), as_of="as_of")
BATCHES = replace(ONE_BATCH, batch_col="batch_id")
SCHEMA = (
    "n long, batch_id long, user_id string, amount double, timestamp string, source string, "
    "as_of long"
)
NOW = 1765702820


def stamp(spark_seconds):
    from datetime import datetime, timezone
    return datetime.fromtimestamp(spark_seconds, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def skewed(n, batches, seed):
    """A third of the records share one key; others repeat now and then or are broken."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        as_of = NOW + i // 20
        if rng.random() < 1 / 3:
            user, text = "HOT", stamp(NOW + 200)  # ahead of time, so never late
        elif rng.random() < 0.1:
            user, text = rng.choice([(None, stamp(NOW)), ("U", None), (" ", ""), (None, None)])
        else:
            user, text = f"U{rng.randrange(8)}", stamp(as_of - rng.choice([0, 0, 1, 2, 300]))
        amount = rng.choice([5.0] * 8 + [None, 0.0])
        source = rng.choice(["web"] * 9 + ["tv"])
        rows.append((i, i * batches // n, user, amount, text, source, as_of))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("as_of", F.timestamp_seconds("as_of"))
    return df.repartition(7, F.rand(seed=1))


def check(spark, rows, cfg, ledger=None, expected=None):
    found = {r["n"]: r["error_reason"] for r in classify(frame(spark, rows), cfg, ledger).collect()}
    assert found == (verdicts(rows) if expected is None else expected)


@pytest.mark.parametrize("batches", [1, 6, 200])
def test_skewed_batches(spark, batches):
    rows = skewed(1200, batches, seed=batches)
    check(spark, rows, BATCHES)
    if batches == 1:
        check(spark, rows, ONE_BATCH)


@pytest.mark.parametrize("batches", [1, 6])
def test_ledger(spark, batches):
    """The second half judged on its own, with the keys of the first half as ledger."""
    rows = skewed(1200, 2 * batches, seed=5)
    expected = verdicts(rows)
    half = [r for r in rows if r[1] < batches]
    rest = [r for r in rows if r[1] >= batches]
    accepted = [(r[2], r[4]) for r in half if expected[r[0]] is None]
    ledger = spark.createDataFrame(accepted, "user_id string, timestamp string")
    cfg = BATCHES if batches > 1 else ONE_BATCH
    check(spark, rest, cfg, ledger, {r[0]: expected[r[0]] for r in rest})
    assert rules.REPEAT_ACROSS in {expected[r[0]] for r in rest}


def test_arrival_of_several_columns(spark):
    rows = skewed(600, 1, seed=3)
    cfg = replace(ONE_BATCH, arrival=("partition", "offset"))
    df = frame(spark, rows).withColumns({
        "partition": F.expr("cast(n div 200 as int)"), "offset": F.col("n") % 200,
    })
    out = classify(df, cfg)
    assert {r["n"]: r["error_reason"] for r in out.collect()} == verdicts(rows)


def test_equal_arrivals_keep_one_record(spark):
    rows = [(0, 0, "A", 5.0, stamp(NOW), "web", NOW)] * 20
    out = classify(frame(spark, rows), BATCHES)
    assert out.count() == 20 and out.filter("is_valid").count() == 1


def test_plan_for_every_size(spark):
    """Minima combine before the shuffle, records move by arrival, nothing is broadcast by force."""
    rows = skewed(300, 6, seed=1)
    records = spark.createDataFrame(rows, SCHEMA).withColumn("as_of", F.timestamp_seconds("as_of"))
    ledger = spark.createDataFrame([("A", "B")], "user_id string, timestamp string")
    plan = classify(records, BATCHES, ledger)._jdf.queryExecution()
    logical, physical = plan.optimizedPlan().toString(), plan.executedPlan().toString()
    assert "strategy=broadcast" not in logical
    assert "partial_min" in physical
    windows = [line for line in logical.splitlines() if "Window [" in line]
    assert windows and all("_arrival" in line for line in windows)


def test_other_session_zone(spark):
    """The text names UTC whatever the session's zone is; windows refuse another zone."""
    rows = skewed(100, 1, seed=4)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        out = classify(frame(spark, rows), ONE_BATCH)
        assert {r["n"]: r["error_reason"] for r in out.collect()} == verdicts(rows)
        with pytest.raises(ValueError, match="UTC"):
            tumbling(out.filter("is_valid"), ONE_BATCH)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_events_ahead_of_time(spark):
    rows = [(0, 0, "A", 5.0, stamp(NOW + 61), "web", NOW), (1, 0, "B", 5.0, stamp(NOW + 60), "web", NOW)]
    out = classify(frame(spark, rows), replace(ONE_BATCH, max_future_skew=60))
    assert {r["n"]: r["error_reason"] for r in out.collect()} == {0: rules.AHEAD, 1: None}


@pytest.mark.parametrize("run", [1, 7, 10_000])
def test_rank(spark, run):
    rows = skewed(900, 4, seed=9)
    places, expected = {}, {}
    for n, batch, user, _, text, *_ in rows:
        if user is None or not user.strip() or text is None or not text.strip():
            continue
        places[batch, user, text] = expected[n] = places.get((batch, user, text), 0) + 1
    ranked = rank_in_batch(frame(spark, rows), replace(BATCHES, rank_run=run))
    assert {r["n"]: r["rn"] for r in ranked.collect()} == expected


def test_drop_repeats(spark):
    rows = skewed(300, 1, seed=2)
    kept = drop_repeats(frame(spark, rows), ONE_BATCH).select("user_id", "timestamp").collect()
    assert sorted(map(repr, kept)) == sorted(map(repr, {
        type(kept[0])(user_id=r[2], timestamp=r[4]) for r in rows
    }))
