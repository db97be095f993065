import pytest
from pyspark.sql import functions as F

from eventguard import PipelineConfig
from eventguard.functions import decode, encode, feed_item, pass_rate, rupiah
from eventguard.operators.metrics import latest, side, topic_counters
from eventguard.operators.route import dlq_only, messages, tag_topics, union_topics, valid_only
from eventguard.operators.windows import merge_parts, running_sums, tumbling, tumbling_parts
from eventguard.schema import PAYLOAD
from eventguard.sources import kafka

CFG = PipelineConfig(arrival=("n",))
SCHEMA = (
    "n long, user_id string, amount double, timestamp string, source string, event_time long, "
    "is_valid boolean, error_reason string"
)


def records(spark, *rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("event_time", F.timestamp_seconds("event_time"))


GOOD = (1, "U1", 150000.0, "2025-12-14T09:00:20Z", "web", 1765702820, True, None)
BAD = (2, None, 1e8, None, None, None, False, "why")
BLANK = (3, " ", None, "", "", None, False, "why")


def test_payload_text(spark):
    df = records(spark, GOOD, BAD, BLANK)
    valid, dlq = messages(df, CFG).values()
    assert [tuple(r) for r in valid.collect()] == [(
        "U1",
        '{"user_id":"U1","amount":150000.0,"timestamp":"2025-12-14T09:00:20Z","source":"web",'
        '"event_time":"2025-12-14T09:00:20.000Z","is_valid":true}',
    )]
    assert sorted(tuple(r) for r in dlq.collect()) == [
        (" ", '{"user_id":" ","timestamp":"","source":"","is_valid":false,"error_reason":"why"}'),
        ("INVALID", '{"amount":1.0E8,"is_valid":false,"error_reason":"why"}'),
    ]
    assert list(messages(df, CFG)) == ["transactions_valid", "transactions_dlq"]
    assert encode(df.filter("n = 2"), "UNKNOWN").first()["key"] == "UNKNOWN"


def test_tagged_topics(spark):
    df = records(spark, GOOD, BAD, BLANK)
    tagged = tag_topics(df, CFG).select("n", "topic")
    stored_apart = union_topics(valid_only(df), dlq_only(df), CFG).select("n", "topic")
    assert sorted(map(tuple, tagged.collect())) == sorted(map(tuple, stored_apart.collect())) == [
        (1, "transactions_valid"), (2, "transactions_dlq"), (3, "transactions_dlq"),
    ]


def test_round_trip(spark):
    df = records(spark, GOOD, BAD, BLANK)
    back = decode(encode(df, "X", keep=("n",)), schema=PAYLOAD).orderBy("n")
    assert back.drop("key").collect() == df.select("n", *PAYLOAD.fieldNames()).orderBy("n").collect()


@pytest.mark.parametrize("amount, text", [
    (0.0, "Rp 0"), (999.0, "Rp 999"), (1234.0, "Rp 1.234"), (18750000.0, "Rp 18.750.000"),
    (1234.5, "Rp 1.234,5"), (0.0625, "Rp 0,063"), (-50000.0, "Rp -50.000"),
    (None, "Rp 0"), (float("nan"), "Rp 0"),
])
def test_rupiah(spark, amount, text):
    df = spark.createDataFrame([(amount,)], "amount double")
    assert df.select(rupiah(F.col("amount"))).first()[0] == text


def test_pass_rate(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (7, 3), (0, 4)], "v long, d long")
    assert [r[0] for r in df.select(pass_rate(F.col("v"), F.col("d"))).collect()] == [
        100.0, 33.3, 70.0, 0.0,
    ]


def test_feed(spark):
    df = records(spark, GOOD, BAD, BLANK).orderBy("n")
    shown = [tuple(r) for r in df.select(*feed_item(False)).collect()]
    assert shown[1:] == [
        ("NULL", "Rp 100.000.000", "NULL", "UNKNOWN", "why"),
        (" ", "NULL", "NULL", "UNKNOWN", "why"),
    ]
    assert [tuple(r) for r in df.select(*feed_item(True)).collect()] == [
        ("U1", "Rp 150.000", "2025-12-14T09:00:20Z", "web"),
        ("UNKNOWN", "Rp 100.000.000", "N/A", "N/A"),
        (" ", "Rp 0", "N/A", "N/A"),
    ]
    timed = df.withColumn("as_of", F.timestamp_seconds(F.when(F.col("n") == 1, 9).otherwise(5)))
    assert [r["n"] for r in latest(timed, CFG, 2).collect()] == [1, 3]


def test_side_and_counters(spark):
    df = spark.createDataFrame([
        ("transactions_valid", False, 1.0), ("transactions_dlq", True, 2.0),
        ("transactions_dlq", None, 3.0), ("other", True, 4.0), ("other", False, None),
        ("other", None, None),
    ], "topic string, is_valid boolean, amount double")
    assert [r[0] for r in df.select(side(CFG)).collect()] == [
        "valid", "valid", "dlq", "valid", "dlq", None,
    ]
    assert {r["topic"]: (r["n"], r["amount"]) for r in topic_counters(df).collect()} == {
        "transactions_valid": (1, 1.0), "transactions_dlq": (2, 5.0), "other": (3, 4.0),
    }


def test_windows(spark):
    times = [1765702800, 1765702859, 1765702860, None]
    df = records(spark, *[
        (i, "U", 10.0 * (i + 1), "t", "web", t, True, None) for i, t in enumerate(times)
    ])
    whole = sorted(tuple(r) for r in tumbling(df, CFG).collect())
    assert whole == [
        ("2025-12-14 09:00:00", "2025-12-14 09:01:00", 2, 30.0, 15.0),
        ("2025-12-14 09:01:00", "2025-12-14 09:02:00", 1, 30.0, 30.0),
    ]
    parts = tumbling_parts(df, CFG, by=["n"])
    assert sorted(tuple(r) for r in merge_parts(parts).collect()) == whole


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_running_sums(spark, block):
    values = {0: 5, 1: 0, 2: -3, 7: 4, 8: 1, 20: 9}
    df = spark.createDataFrame(list(values.items()), "k long, v long").repartition(3)
    found = {r["k"]: r["s"] for r in running_sums(df, "k", {"s": "v"}, block).collect()}
    assert found == {k: sum(v for j, v in values.items() if j <= k) for k in values}


def test_kafka_options(spark):
    cfg = PipelineConfig(kafka_broker="b:1")
    assert kafka.read_options(cfg, "transactions") == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "transactions",
        "startingOffsets": "latest", "failOnDataLoss": "false",
    }
    assert kafka.read_options(cfg, cfg.valid_topic, cfg.dlq_topic)["subscribe"] == (
        "transactions_valid,transactions_dlq"
    )
    assert kafka.write_options(cfg, cfg.dlq_topic) == {
        "kafka.bootstrap.servers": "b:1", "topic": "transactions_dlq",
    }


def test_read_back(spark):
    df = records(spark, GOOD)
    sent = encode(df, "UNKNOWN").select(F.lit("transactions_valid").alias("topic"), "value")
    row = kafka.read_back(sent.withColumn("value", F.col("value").cast("binary"))).first()
    assert (row["topic"], row["user_id"], row["is_valid"]) == ("transactions_valid", "U1", True)


def test_settings_from_environment(monkeypatch):
    monkeypatch.setenv("INPUT_TOPIC", "in")
    monkeypatch.setenv("CHECKPOINT_DIR", "/shared/x")
    cfg = PipelineConfig.from_env()
    assert (cfg.input_topic, cfg.base_dir, cfg.valid_topic) == (
        "in", "/shared/x", "transactions_valid",
    )
