"""Per-page aggregates by minute and hour, direct or through mergeable states.

A state row holds plain sums and a theta sketch of the users seen. States of the
same key merge in any order and grouping; distinct users stay exact up to 65,536
per key and are estimated beyond. Ratios are formed last and never stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetide.functions import times

# log2 of the number of hashes a sketch keeps; exact below that many users.
SKETCH_LOG_SIZE = 16

_SUMS = ["view_count_s", "total_duration_s", "bounce_count_s"]


def minute_states(raw: DataFrame) -> DataFrame:
    """Partial aggregate of raw rows by (minute, page)."""
    return raw.groupBy(times.minute(F.col("event_time")).alias("window_start"), "page_id").agg(
        F.sum(F.lit(1).cast("bigint")).alias("view_count_s"),
        F.sum(F.col("duration_ms").cast("bigint")).alias("total_duration_s"),
        F.theta_sketch_agg("user_id", SKETCH_LOG_SIZE).alias("unique_users_s"),
        F.sum(F.col("is_bounce").cast("bigint")).alias("bounce_count_s"),
    )


def merge_states(
    states: DataFrame, bucket: Callable[[Column], Column] = lambda start: start
) -> DataFrame:
    """States merged by page and ``bucket`` of their window, still mergeable."""
    return states.groupBy(bucket(F.col("window_start")).alias("window_start"), "page_id").agg(
        F.sum("view_count_s").alias("view_count_s"),
        F.sum("total_duration_s").alias("total_duration_s"),
        F.theta_union_agg("unique_users_s", SKETCH_LOG_SIZE).alias("unique_users_s"),
        F.sum("bounce_count_s").alias("bounce_count_s"),
    )


def hour_states(states: DataFrame) -> DataFrame:
    return merge_states(states, times.hour)


def finalize(merged: DataFrame) -> DataFrame:
    """Counts and sums of states merged to one row per key."""
    return merged.select(
        "window_start",
        "page_id",
        F.col("view_count_s").alias("view_count"),
        F.col("total_duration_s").alias("total_duration"),
        F.theta_sketch_estimate("unique_users_s").alias("unique_users"),
        F.col("bounce_count_s").alias("bounce_count"),
    )


def with_ratios(aggregates: DataFrame) -> DataFrame:
    """Average duration in ms and bounce rate in percent, from sums."""
    views = F.col("view_count")
    return aggregates.select(
        "window_start",
        "page_id",
        "view_count",
        (F.col("total_duration") / views).alias("avg_duration"),
        "unique_users",
        (F.col("bounce_count") * F.lit(100.0) / views).alias("bounce_rate"),
    )


def minute_aggregates(states: DataFrame) -> DataFrame:
    """Minute rows from stored states, however they are split into parts."""
    return finalize(merge_states(states))


def hourly_rollup(states: DataFrame) -> DataFrame:
    """Hour rows from minute states or hour states."""
    return with_ratios(finalize(hour_states(states)))


def exact_aggregates(raw: DataFrame, bucket: Callable[[Column], Column]) -> DataFrame:
    """Aggregates with exact distinct users, for batch input.

    Spark first shuffles on (bucket, page, user) and pre-aggregates, so a page
    with most of the traffic is spread over all tasks.
    """
    return raw.groupBy(bucket(F.col("event_time")).alias("window_start"), "page_id").agg(
        F.count(F.lit(1)).alias("view_count"),
        F.sum("duration_ms").alias("total_duration"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum(F.col("is_bounce").cast("bigint")).alias("bounce_count"),
    )


def sum_collapse(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with every other numeric column summed.

    For additive columns only: averages, distinct counts and rates do not sum.
    """
    numeric = [
        f.name for f in df.schema.fields if f.name not in keys and isinstance(f.dataType, T.NumericType)
    ]
    if not numeric:
        raise ValueError("no numeric column to sum")
    return df.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in numeric])
