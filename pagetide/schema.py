"""Schemas and names of the messages, tables and results."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# One broker record. ``value`` may also arrive as BINARY from a real topic.
MESSAGE = _struct(
    value=T.StringType(),
    topic=T.StringType(),
    partition=T.IntegerType(),
    offset=T.LongType(),
    timestamp=T.TimestampType(),
)

# The event inside a message, by JSON key.
EVENT = _struct(
    page_id=T.StringType(),
    user_id=T.StringType(),
    view_duration_ms=T.LongType(),
    timestamp=T.StringType(),
    user_agent=T.StringType(),
    ip_address=T.StringType(),
    region=T.StringType(),
    is_bounce=T.BooleanType(),
)

RAW = _struct(
    event_date=T.DateType(),
    event_time=T.TimestampType(),
    page_id=T.StringType(),
    user_id=T.StringType(),
    duration_ms=T.LongType(),
    user_agent=T.StringType(),
    ip_address=T.StringType(),
    region=T.StringType(),
    is_bounce=T.ByteType(),
    kafka_offset=T.LongType(),
    kafka_partition=T.IntegerType(),
    processed_time=T.TimestampType(),
)

ERRORS = _struct(
    error_time=T.TimestampType(),
    raw_message=T.StringType(),
    error_reason=T.StringType(),
    kafka_offset=T.LongType(),
    kafka_partition=T.IntegerType(),
)

MINUTE_STATE = _struct(
    window_start=T.TimestampType(),
    page_id=T.StringType(),
    view_count_s=T.LongType(),
    total_duration_s=T.LongType(),
    unique_users_s=T.BinaryType(),
    bounce_count_s=T.LongType(),
)

MINUTE = _struct(
    window_start=T.TimestampType(),
    page_id=T.StringType(),
    view_count=T.LongType(),
    total_duration=T.LongType(),
    unique_users=T.LongType(),
    bounce_count=T.LongType(),
)

HOUR = _struct(
    window_start=T.TimestampType(),
    page_id=T.StringType(),
    view_count=T.LongType(),
    avg_duration=T.DoubleType(),
    unique_users=T.LongType(),
    bounce_rate=T.DoubleType(),
)

# Users by number, and bitmaps of the numbers seen, by buckets of 32,768.
USER_NUMBER = _struct(user_id=T.StringType(), number=T.LongType())
USER_STATE = _struct(
    window_start=T.TimestampType(),
    page_id=T.StringType(),
    bucket=T.LongType(),
    users=T.BinaryType(),
    month=T.IntegerType(),
)

# Rows per bucket of fixed edges and minute, not cumulated.
HISTOGRAM_STATE = _struct(
    window_start=T.TimestampType(), counts=T.ArrayType(T.LongType()), month=T.IntegerType()
)

# Two hashes of an event's content, by the day of the event.
CONTENT_KEY = _struct(event_date=T.DateType(), key_1=T.LongType(), key_2=T.LongType())

# What one batch has brought.
BATCH_STATUS = _struct(
    messages_processed=T.LongType(),
    valid_messages=T.LongType(),
    invalid_messages=T.LongType(),
    first_event_time=T.TimestampType(),
    last_event_time=T.TimestampType(),
    last_insert_time=T.TimestampType(),
)

# Values of the ``route`` partition column of the stored log.
RAW_ROUTE = "raw"
ERROR_ROUTE = "errors"

# One stored log holds both outcomes of a batch, so that they commit together.
# Columns of the other route are null and cost next to nothing in Parquet.
LOG = T.StructType(
    RAW.fields
    + [f for f in ERRORS.fields if f.name not in RAW.fieldNames()]
    + [
        T.StructField("batch_id", T.LongType()),
        T.StructField("route", T.StringType()),
        T.StructField("month", T.IntegerType()),
    ]
)

RAW_TABLE = "page_views_raw"
MINUTE_TABLE = "page_views_agg_minute"
HOUR_TABLE = "page_views_agg_hour"
ERROR_TABLE = "processing_errors"
