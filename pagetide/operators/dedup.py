"""Replays and resends: finding and dropping repeated events.

Copies collapse on the map side before any shuffle, so a group holding a large
part of all rows reaches its task as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.schema import RAW

# What makes two events the same, leaving out where the topic stored them.
CONTENT = [
    "page_id",
    "user_id",
    "duration_ms",
    "event_time",
    "user_agent",
    "ip_address",
    "region",
    "is_bounce",
]


def drop_replays(messages: DataFrame) -> DataFrame:
    """One row per (partition, offset), for messages read more than once.

    On a stream, ``ingest.start_ingest`` does it against what is stored.
    """
    return messages.dropDuplicates(["partition", "offset"])


def duplicate_events(raw: DataFrame) -> DataFrame:
    """Events stored more than once, with their number of copies."""
    return raw.groupBy(*CONTENT).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


# Partition and offset as one number, whose minimum a hash aggregate can keep.
_OFFSETS = "CAST(18446744073709551616 AS DECIMAL(38, 0))"


def drop_resends(raw: DataFrame) -> DataFrame:
    """One raw row per event content, the one with the lowest partition and offset.

    The row's date follows from its time; its processing time is the earliest of the
    copies, as copies stored in one batch share it.
    """
    place = f"CAST(kafka_partition AS DECIMAL(38, 0)) * {_OFFSETS} + kafka_offset"
    kept = raw.groupBy(*CONTENT).agg(
        F.expr(f"min(CAST({place} AS DECIMAL(38, 0)))").alias("_place"),
        F.min("processed_time").alias("processed_time"),
    )
    partition = f"CAST(floor(_place / {_OFFSETS}) AS DECIMAL(38, 0))"
    return kept.selectExpr(
        "*",
        f"CAST({partition} AS INT) AS kafka_partition",
        f"CAST(_place - {partition} * {_OFFSETS} AS BIGINT) AS kafka_offset",
        "to_date(event_time) AS event_date",
    ).select(*RAW.fieldNames())
