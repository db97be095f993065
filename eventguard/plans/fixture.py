"""Transactions derived from the `events` table, with a fixed mix of faults.

With b = event_id mod 100: 70-71 too low, 72-73 too high, 74 bad timestamp, 75 empty
timestamp, 76-77 unknown source, 78-79 no user, 80-81 no amount, 82-91 late, 92-99 a copy
of the record 50 places earlier. 250 records make a batch; a record arrives each second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventguard.config import PipelineConfig, use_utc

# Values of the test stream; faults of its records.
TOO_LOW, TOO_HIGH = -7.0, 123_456_789.0
NO_TIME = "2031-02-30T25:61:07Z"
NO_SOURCE = "kiosk"
START = 1_765_702_800  # 2025-12-14 09:00:00 UTC
BATCH_ROWS = 250
COPY_DISTANCE = 50
# Arrivals come in this many waves; each resumes the stream from its checkpoint.
STREAM_WAVES = 4
# Seconds an event may be ahead where windows follow Spark's watermark.
SKEW = 60
HOT_TIME = "2030-01-01T00:00:00Z"
FIELDS = ["user_id", "amount", "timestamp", "source"]
# The columns used of the `events` table; declared, so that no job reads a schema.
EVENTS = "event_id long, user_id long, event_type string, value double"

CONFIG = PipelineConfig(arrival=("event_id",), batch_col="batch_id", as_of="as_of")


def _as_text(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), CONFIG.timestamp_pattern)


def _shaped(table: DataFrame) -> DataFrame:
    b, event_type = F.col("b"), F.col("event_type")
    arrived = F.lit(START) + F.col("event_id")
    delay = (4 + F.pmod("event_id", F.lit(7))) * 60
    return table.withColumn("b", F.pmod("event_id", F.lit(100))).select(
        "event_id",
        "b",
        F.when(~b.isin(78, 79), F.concat(F.lit("U"), (10000 + F.col("user_id")).cast("string")))
        .alias("user_id"),
        F.when(b.isin(70, 71), F.lit(TOO_LOW))
        .when(b.isin(72, 73), F.lit(TOO_HIGH))
        .when(~b.isin(80, 81), (F.floor(F.col("value") * 20000) + 1).cast("double"))
        .alias("amount"),
        F.when(b == 74, F.lit(NO_TIME))
        .when(b == 75, F.lit(""))
        .when(b.between(82, 91), _as_text(arrived - delay))
        .otherwise(_as_text(arrived))
        .alias("timestamp"),
        F.when(b.isin(76, 77), F.lit(NO_SOURCE))
        .when(event_type.isin("click", "signup"), F.lit("web"))
        .when(event_type == "purchase", F.lit("pos"))
        .otherwise(F.lit("mobile"))
        .alias("source"),
        F.timestamp_seconds(arrived).alias("as_of"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, batch_id, the four transaction fields and as_of.

    Only the copies (8 in 100) and what they copy are shuffled.
    """
    use_utc(spark)
    shaped = _shaped(events(spark, sf_dir))
    b = F.col("b")
    own = shaped.filter(~b.between(92, 99))
    originals = shaped.filter(b.between(92 - COPY_DISTANCE, 99 - COPY_DISTANCE)).select(
        (F.col("event_id") + COPY_DISTANCE).alias("event_id"),
        F.struct(*FIELDS).alias("copied"),
    )
    copies = shaped.filter(b.between(92, 99)).join(originals, "event_id", "left")
    filled = copies.select("event_id", "b", *[
        F.when(F.col("copied").isNull(), F.col(name)).otherwise(F.col(f"copied.{name}")).alias(name)
        for name in FIELDS
    ], "as_of")
    return own.unionByName(filled).select(
        "event_id",
        F.expr(f"event_id div {BATCH_ROWS}").alias("batch_id"),
        *FIELDS,
        "as_of",
    )


def skewed(txn: DataFrame) -> DataFrame:
    """The transactions with every third one under one key, ahead of time and so never late.

    Of the others some lack a source or a number, have a blank one or a user of blanks.
    """
    n = F.col("event_id")
    hot = F.pmod(n, F.lit(3)) == 0
    return txn.withColumns({
        "user_id": F.when(hot, F.lit("U7")).when(F.pmod(n, F.lit(103)) == 9, F.lit("  "))
        .otherwise(F.col("user_id")),
        "timestamp": F.when(hot, F.lit(HOT_TIME)).otherwise(F.col("timestamp")),
        "amount": F.when(F.pmod(n, F.lit(101)) == 7, F.lit(float("nan"))).otherwise(F.col("amount")),
        "source": F.when(F.pmod(n, F.lit(97)) == 5, F.lit(None)).when(
            F.pmod(n, F.lit(89)) == 4, F.lit(" ")
        ).otherwise(F.col("source")),
    })


# Faults of JSON lines, by event_id mod 40.
CUT, NO_COLONS, NAN, QUOTED, NUMBER, NESTED, TWICE, BLANK, LIST, WORDS, NOTHING = 3, 7, 11, 13, 17, 19, 23, 29, 31, 37, 5


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions as JSON lines as they come in (`value`), eleven in forty of them odd.

    Some are cut off, have no colons, are blank, missing, words or a list; some have NaN or a
    quoted number as amount, a number as user, an object as source, or the user twice.
    """
    m, user, amount = F.pmod("event_id", F.lit(40)), F.col("user_id"), F.col("amount").cast("long").cast("string")
    quoted = lambda name, text: F.concat(F.lit(f'"{name}":"'), text, F.lit('"'))
    line = F.concat(F.lit("{"), F.concat_ws(
        ",",
        F.when(m == NUMBER, F.concat(F.lit('"user_id":'), F.col("event_id").cast("string"))).otherwise(
            quoted("user_id", user)
        ),
        F.when(m == NAN, F.lit('"amount":NaN')).when(m == QUOTED, quoted("amount", amount)).otherwise(
            F.concat(F.lit('"amount":'), amount)
        ),
        quoted("timestamp", F.col("timestamp")),
        F.when(m == NESTED, F.lit('"source":{"a":1}')).otherwise(quoted("source", F.col("source"))),
        F.when(m == TWICE, F.lit('"user_id":"U5"')),
    ), F.lit("}"))
    value = (
        F.when(m == CUT, F.expr("substring(line, 1, length(line) - 9)"))
        .when(m == NO_COLONS, F.replace("line", F.lit(":"), F.lit("")))
        .when(m == BLANK, F.lit("")).when(m == LIST, F.lit("[1,2]")).when(m == WORDS, F.lit("no record"))
        .when(m != NOTHING, F.col("line"))
    )
    return transactions(spark, sf_dir).withColumn("line", line).select(
        value.alias("value"), "event_id", "batch_id", "as_of"
    )
