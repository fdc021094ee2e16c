"""The served queries: latest aggregates and latest errors."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.functions import times
from pagetide.operators import rollup

AGGREGATE_ROWS = 100


def recent_windows(states: DataFrame, hours: int, as_of: times.Clock) -> DataFrame:
    """States of windows that start in the last ``hours`` hours.

    The month is bounded too where the table is partitioned by it, so that old
    partitions are never opened.
    """
    since = times.hours_before(as_of, hours)
    recent = states.filter(F.col("window_start") >= since)
    if "month" in states.columns:
        recent = recent.filter(F.col("month") >= times.month(since))
    return recent


def latest_aggregates(
    states: DataFrame, as_of: times.Clock = None, hours: int = 1, keys_first: bool = False
) -> DataFrame:
    """The 100 latest minute rows of the last ``hours`` hours, latest first.

    With ``keys_first`` a scan of windows and pages alone first finds how far back
    the answer reaches, and sketches are read and merged from there on only. Meant
    for the stored table, rather than for states still to be computed.
    """
    if not 1 <= hours <= 24:
        raise ValueError("Invalid hours parameter (must be 1-24)")
    recent = recent_windows(states, hours, as_of)
    if keys_first:
        keys = recent.select("window_start", "page_id").distinct()
        latest = keys.orderBy(F.desc("window_start"), "page_id").limit(AGGREGATE_ROWS)
        recent = recent.filter(F.col("window_start") >= latest.agg(F.min("window_start")).scalar())
    merged = rollup.minute_aggregates(recent)
    return merged.orderBy(F.desc("window_start"), "page_id").limit(AGGREGATE_ROWS)


def events_of(
    raw: DataFrame, day: date, page_id: str | None = None, user_id: str | None = None
) -> DataFrame:
    """Stored events of one day and one page, one user or both.

    The month prunes directories, the sort order and the files' Bloom filters leave out
    row groups that do not hold the page or the user.
    """
    if page_id is None and user_id is None:
        raise ValueError("name a page or a user")
    found = raw.filter(F.col("event_date") == F.lit(day))
    if "month" in raw.columns:
        found = found.filter(F.col("month") == day.year * 100 + day.month)
    for name, value in (("page_id", page_id), ("user_id", user_id)):
        if value is not None:
            found = found.filter(F.col(name) == value)
    return found


def latest_errors(errors: DataFrame, limit: int = 10, narrow_first: bool = False) -> DataFrame:
    """The latest rejected messages, latest first.

    With ``narrow_first`` a scan of the times alone first finds how far back the
    answer reaches, and the messages are then read from there on only. Meant for
    the stored table, which is kept for good, rather than for errors still to be
    computed.
    """
    if not 1 <= limit <= 1000:
        raise ValueError("Invalid limit parameter (must be 1-1000)")
    latest = errors.select(
        "error_time", "raw_message", "error_reason", "kafka_offset", "kafka_partition"
    )
    if narrow_first:
        times_only = errors.select("error_time").orderBy(F.desc("error_time")).limit(limit)
        reach = times_only.agg(F.min("error_time")).scalar()
        if "month" in errors.columns:
            latest = errors.filter(F.col("month") >= times.month(reach)).select(*latest.columns)
        latest = latest.filter(F.col("error_time") >= reach)
    return latest.orderBy(F.desc("error_time"), "kafka_partition", "kafka_offset").limit(limit)
