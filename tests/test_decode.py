import math

import pytest
from pyspark.sql import functions as F

from eventguard import PipelineConfig
from eventguard.functions import decode, event_time

EMPTY = (None, None, None, None)


@pytest.mark.parametrize("text, expected", [
    ('{"user_id":"U1","amount":150,"timestamp":"t","source":"web"}', ("U1", 150.0, "t", "web")),
    ('{"user_id":"U1","amount":"abc","source":"web"}', ("U1", None, None, "web")),
    ('{"user_id":"U1","amount":"150"}', ("U1", None, None, None)),
    ('{"user_id":7,"timestamp":5,"source":{"a":1}}', ("7", None, "5", '{"a":1}')),
    ('{"amount":1,"amount":2,"other":3}', (None, 2.0, None, None)),
    ('{"USER_ID":"U1"}', EMPTY),
    ("not json", EMPTY),
    ('{"user_id":"U1"', EMPTY),
    ("[]", EMPTY),
    ('[{"user_id":"U1"}]', EMPTY),
    ("{}", EMPTY),
    ("", EMPTY),
    (None, EMPTY),
])
def test_decode(spark, text, expected):
    df = spark.createDataFrame([(text,)], "value string")
    assert tuple(decode(df).first()) == expected
    raw = df.select(F.col("value").cast("binary").alias("value"))
    assert tuple(decode(raw).first()) == expected


@pytest.mark.parametrize("number, check", [
    ('"NaN"', math.isnan), ("NaN", math.isnan), ('"Infinity"', math.isinf), ("1e400", math.isinf),
])
def test_special_amounts(spark, number, check):
    df = spark.createDataFrame([(f'{{"amount":{number}}}',)], "value string")
    assert check(decode(df).first()["amount"])


@pytest.mark.parametrize("text, expected", [
    ("2025-12-14T09:00:20Z", 1765702820),
    ("2025-12-14t09:00:20Z", 1765702820),
    ("1969-12-31T23:59:59Z", -1),
    ("2025-99-14T09:00:20Z", None),
    ("2025-02-30T09:00:20Z", None),
    ("14-12-2025 09:00:20", None),
    ("2025-12-14T09:00:20.5Z", None),
    ("2025-12-14T09:00:20+07:00", None),
    ("2025-12-14T09:00:20", None),
    ("2025-1-4T9:0:2Z", None),
    ("2025-12-14T09:00:20Z ", None),
    (" 2025-12-14T09:00:20Z", None),
    ("", None),
    (None, None),
])
def test_event_time(spark, text, expected):
    df = spark.createDataFrame([(text,)], "timestamp string")
    found = df.select(event_time(F.col("timestamp"), PipelineConfig()).cast("long")).first()[0]
    assert found == expected
