import itertools

import pytest
from pyspark.sql import functions as F

from eventguard import PipelineConfig
from eventguard.operators import rules
from eventguard.operators.classify import classify
from tests.brute import verdicts

CFG = PipelineConfig(arrival=("n",), as_of="as_of")
NOW = 1765702820
GOOD = {"user_id": "U1", "amount": 5.0, "timestamp": "2025-12-14T09:00:20Z", "source": "web", "as_of": NOW}
SCHEMA = "n long, user_id string, amount double, timestamp string, source string, as_of long"


def reasons(spark, rows, cfg=CFG):
    data = [(i, *[{**GOOD, **row}[k] for k in GOOD]) for i, row in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA).withColumn("as_of", F.timestamp_seconds("as_of"))
    found = classify(df, cfg).orderBy("n").collect()
    assert all(r["is_valid"] == (r["error_reason"] is None) for r in found)
    expected = verdicts([(d[0], 0, *d[1:]) for d in data])
    assert [r["error_reason"] for r in found] == [expected[i] for i in range(len(rows))]
    return [r["error_reason"] for r in found]


CASES = [
    ({}, None),
    ({"user_id": None}, rules.USER_MISSING),
    ({"user_id": ""}, rules.USER_MISSING),
    ({"user_id": "  "}, rules.USER_MISSING),
    ({"user_id": "\t"}, None),
    ({"amount": None}, rules.AMOUNT_MISSING),
    ({"timestamp": None}, rules.TIMESTAMP_MISSING),
    ({"timestamp": " "}, rules.TIMESTAMP_MISSING),
    ({"timestamp": "\t"}, rules.TIMESTAMP_TYPE),
    ({"source": None}, rules.SOURCE_MISSING),
    ({"source": ""}, rules.SOURCE_MISSING),
    ({"timestamp": "next tuesday"}, rules.TIMESTAMP_TYPE),
    ({"amount": float("nan")}, rules.AMOUNT_NAN),
    ({"amount": float("inf")}, rules.AMOUNT_RANGE),
    ({"amount": 0.999}, rules.AMOUNT_RANGE),
    ({"amount": 1.0}, None),
    ({"amount": 10000000.0}, None),
    ({"amount": 10000000.01}, rules.AMOUNT_RANGE),
    ({"amount": -50000.0}, rules.AMOUNT_RANGE),
    ({"source": "Web"}, rules.SOURCE_UNKNOWN),
    ({"source": " web"}, rules.SOURCE_UNKNOWN),
    ({"source": "\t"}, rules.SOURCE_UNKNOWN),
    ({"source": "mobile"}, None),
    ({"source": "pos"}, None),
    ({"as_of": NOW + 179}, None),
    ({"as_of": NOW + 180}, None),
    ({"as_of": NOW + 181}, rules.LATE),
    ({"as_of": NOW - 100000}, None),
]


def test_each_rule(spark):
    # Own users keep the cases from being repeats of each other.
    rows = [{**({"user_id": f"U{i}"}), **row} for i, (row, _) in enumerate(CASES)]
    assert reasons(spark, rows) == [reason for _, reason in CASES]


def test_lag_is_floored_to_seconds(spark):
    df = spark.createDataFrame([(0, 180.9), (1, 181.0)], "n long, lag double").select(
        "n", F.lit(5.0).alias("amount"), F.lit("web").alias("source"),
        F.concat(F.lit("U"), "n").alias("user_id"), F.lit(GOOD["timestamp"]).alias("timestamp"),
        F.timestamp_seconds(F.lit(NOW) + F.col("lag")).alias("as_of"),
    )
    found = {r["n"]: r["error_reason"] for r in classify(df, CFG).collect()}
    assert found == {0: None, 1: rules.LATE}


def test_precedence(spark):
    faults = [
        {"user_id": None}, {"amount": None}, {"timestamp": None}, {"source": None},
        {"timestamp": "bad"}, {"amount": float("nan")}, {"amount": 0.0}, {"source": "tv"},
        {"as_of": NOW + 999},
    ]
    rows = [
        {"user_id": f"U{i}", **later, **earlier}
        for i, (earlier, later) in enumerate(itertools.combinations(faults, 2))
    ]
    reasons(spark, rows)


def test_repeats_in_batch(spark):
    copy = {"user_id": "A"}
    assert reasons(spark, [copy, copy, {"user_id": "B"}, copy]) == [
        None, rules.REPEAT_IN_BATCH, None, rules.REPEAT_IN_BATCH,
    ]


def test_bad_record_blocks_its_key_in_the_batch(spark):
    assert reasons(spark, [{"amount": 0.0}, {}]) == [rules.AMOUNT_RANGE, rules.REPEAT_IN_BATCH]


def test_late_repeat_is_a_repeat(spark):
    late = {"as_of": NOW + 500}
    assert reasons(spark, [late, late]) == [rules.LATE, rules.REPEAT_IN_BATCH]


def test_empty_frame(spark):
    assert reasons(spark, [{}][:0]) == []


@pytest.mark.parametrize("group", ["mandatory", "type", "range", "source", "lateness"])
def test_groups_cover_rules(spark, group):
    assert rules.rules_of(CFG, group)


def test_session_zone_does_not_matter_once_pinned(spark):
    from eventguard import use_utc
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        use_utc(spark)
        assert reasons(spark, [{"as_of": NOW + 180}]) == [None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
