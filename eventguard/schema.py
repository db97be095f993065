"""Declared schemas. Nothing is inferred."""

from pyspark.sql import types as T

TRANSACTION = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("source", T.StringType()),
])

# Body of an output message, in the order of its JSON text.
PAYLOAD = T.StructType([
    *TRANSACTION.fields,
    T.StructField("event_time", T.TimestampType()),
    T.StructField("is_valid", T.BooleanType()),
    T.StructField("error_reason", T.StringType()),
])

# Accepted keys, as read back from the valid records.
LEDGER = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
])

# Parts of all results of a micro-batch: per batch, one row for each minute with accepted
# records and one for the rejected records. Times are whole epoch seconds.
PARTS = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("valid_count", T.LongType()),
    T.StructField("dlq_count", T.LongType()),
    T.StructField("window_total_amount", T.DoubleType()),
    T.StructField("newest_as_of", T.LongType()),
    T.StructField("newest_event", T.LongType()),
])

# Windows that no later record can change.
WINDOWS = T.StructType([
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("valid_count", T.LongType()),
    T.StructField("window_total_amount", T.DoubleType()),
    T.StructField("window_avg_amount", T.DoubleType()),
])

# The metrics of a micro-batch and their order.
METRICS = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("running_total", T.DoubleType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("batch_valid", T.LongType()),
    T.StructField("batch_dlq", T.LongType()),
    T.StructField("cum_valid_count", T.LongType()),
    T.StructField("cum_dlq_count", T.LongType()),
])

# Results of one or of several merged micro-batches that lie in folders of their own.
PIECE = T.StructType([
    T.StructField("first", T.LongType()),
    T.StructField("last", T.LongType()),
    T.StructField("level", T.IntegerType()),
    T.StructField("days", T.ArrayType(T.IntegerType())),
    T.StructField("newest_event", T.LongType()),
    T.StructField("closed", T.BooleanType()),
    T.StructField("shared", T.BooleanType()),
])

# What a micro-batch hands to the next one: totals, marks, and the manifest of its pieces.
STATE = T.StructType([
    T.StructField("cum_valid", T.LongType()),
    T.StructField("cum_dlq", T.LongType()),
    T.StructField("running_total", T.DoubleType()),
    T.StructField("newest_as_of", T.LongType()),
    T.StructField("closed_until", T.LongType()),
    T.StructField("today", T.IntegerType()),
    T.StructField("pieces", T.ArrayType(PIECE)),
    T.StructField("ahead", T.LongType()),
    T.StructField("oldest", T.LongType()),
    T.StructField("trash", T.ArrayType(T.StructType([
        T.StructField("since", T.LongType()), T.StructField("path", T.StringType()),
    ]))),
])
