"""Stateful variants that emit each window once, when its watermark has passed.

For consumers that want final rows pushed to them. The default delay spans all that
the gate lets in, from the oldest event to one ahead of the clock, so no gated event
is late. With a shorter one, events later than ``delay`` are left out here; the
stored states keep them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.functions import quality
from pagetide.operators import rollup

DELAY = f"{quality.MAX_AGE_HOURS + quality.MAX_AHEAD_HOURS} hours"


def _watched(raw: DataFrame, delay: str) -> DataFrame:
    return raw.withWatermark("event_time", delay)


def _minute_states(raw: DataFrame, delay: str) -> DataFrame:
    window = F.window("event_time", "1 minute").alias("window")
    return _watched(raw, delay).groupBy(window, "page_id").agg(
        F.count(F.lit(1)).alias("view_count_s"),
        F.sum("duration_ms").alias("total_duration_s"),
        F.theta_sketch_agg("user_id", rollup.SKETCH_LOG_SIZE).alias("unique_users_s"),
        F.sum(F.col("is_bounce").cast("bigint")).alias("bounce_count_s"),
    )


def exact_users(raw: DataFrame, delay: str = DELAY) -> DataFrame:
    """Exact distinct users per closed minute and page of a stream, in append mode.

    Two stateful steps in one query: the first lets each (minute, page, user) pass once,
    the second counts what passes per window. The first forgets a user when the
    watermark passes, so its state is bounded by the delay, a short row per user and no
    set per key; later copies are late for the window as well, so none counts twice.
    ``delay`` is a minute or more.
    """
    minute = F.date_trunc("minute", "event_time").alias("minute")
    once = _watched(raw, delay).select("event_time", minute, "page_id", "user_id")
    once = once.dropDuplicatesWithinWatermark(["minute", "page_id", "user_id"])
    counted = once.groupBy(F.window("event_time", "1 minute"), "page_id").agg(F.count(F.lit(1)).alias("unique_users"))
    return counted.select(F.col("window.start").alias("window_start"), "page_id", "unique_users")


def closed_minutes(raw: DataFrame, delay: str = DELAY) -> DataFrame:
    """Final minute rows of a stream of raw events, in append mode."""
    states = _minute_states(raw, delay)
    return rollup.finalize(states.withColumn("window_start", F.col("window.start")))


def closed_hours(raw: DataFrame, delay: str = DELAY) -> DataFrame:
    """Final hour rows, cascaded from the minute windows."""
    minutes = _minute_states(raw, delay)
    hour = F.window(F.window_time("window"), "1 hour").alias("window")
    hours = minutes.groupBy(hour, "page_id").agg(
        F.sum("view_count_s").alias("view_count_s"),
        F.sum("total_duration_s").alias("total_duration_s"),
        F.theta_union_agg("unique_users_s", rollup.SKETCH_LOG_SIZE).alias("unique_users_s"),
        F.sum("bounce_count_s").alias("bounce_count_s"),
    )
    final = rollup.finalize(hours.withColumn("window_start", F.col("window.start")))
    return rollup.with_ratios(final)
