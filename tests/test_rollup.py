"""Aggregates: states merge in any way, ratios come last, skew changes nothing."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import multiset
from pagetide.functions import times
from pagetide.operators import queries, rollup

START = datetime(2024, 1, 30, 10, 58, 0)
SCHEMA = "event_time timestamp, page_id string, user_id string, duration_ms bigint, is_bounce tinyint"


def raw_rows(spark, count, seed, hot=0.33):
    """Rows of which a third falls on one page and minute."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(count):
        if rnd.random() < hot:
            page, at = "hot", START + timedelta(milliseconds=rnd.randrange(60000))
        else:
            page, at = f"p{rnd.randrange(4)}", START + timedelta(seconds=rnd.randrange(400))
        rows.append((at, page, f"u{rnd.randrange(50)}", rnd.randrange(100000), rnd.randrange(2)))
    return rows, spark.createDataFrame(rows, SCHEMA)


def brute_force(rows, floor):
    groups = {}
    for at, page, user, duration, bounce in rows:
        groups.setdefault((floor(at), page), []).append((user, duration, bounce))
    return {
        key: (len(g), sum(d for _, d, _ in g), len({u for u, _, _ in g}), sum(b for _, _, b in g))
        for key, g in groups.items()
    }


def floor_minute(at):
    return at.replace(second=0, microsecond=0)


def floor_hour(at):
    return at.replace(minute=0, second=0, microsecond=0)


def by_key(df):
    return {
        (r.window_start, r.page_id): (
            r.view_count,
            r.total_duration,
            r.unique_users,
            r.bounce_count,
        )
        for r in df.collect()
    }


def test_minutes_both_ways(spark):
    rows, raw = raw_rows(spark, 3000, 1)
    expected = brute_force(rows, floor_minute)
    assert by_key(rollup.exact_aggregates(raw, times.minute)) == expected
    assert by_key(rollup.minute_aggregates(rollup.minute_states(raw))) == expected


def test_hours_with_ratios(spark):
    rows, raw = raw_rows(spark, 3000, 2)
    expected = {
        key: (n, d / n, u, b * 100.0 / n) for key, (n, d, u, b) in brute_force(rows, floor_hour).items()
    }
    for df in (
        rollup.with_ratios(rollup.exact_aggregates(raw, times.hour)),
        rollup.hourly_rollup(rollup.minute_states(raw)),
        rollup.hourly_rollup(rollup.hour_states(rollup.minute_states(raw))),
    ):
        got = {
            (r.window_start, r.page_id): (r.view_count, r.avg_duration, r.unique_users, r.bounce_rate)
            for r in df.collect()
        }
        assert got == expected


@given(st.lists(st.integers(0, 4), min_size=60, max_size=60), st.integers(2, 4))
@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_states_merge_in_any_grouping(spark, parts, split):
    rows, _ = raw_rows(spark, 60, 5)
    expected = brute_force(rows, floor_minute)
    states = None
    for part in sorted(set(parts)):
        chosen = [row for row, p in zip(rows, parts) if p == part]
        piece = rollup.minute_states(spark.createDataFrame(chosen, SCHEMA))
        states = piece if states is None else states.unionByName(piece)
        if part == split:
            states = rollup.merge_states(states)
    assert by_key(rollup.minute_aggregates(states)) == expected


def test_sketch_is_exact_for_many_users_and_close_beyond(spark):
    def users(count):
        raw = spark.range(count).select(
            F.lit(START).alias("event_time"),
            F.lit("p").alias("page_id"),
            F.concat(F.lit("user_"), F.col("id")).alias("user_id"),
            F.lit(1).alias("duration_ms"),
            F.lit(0).alias("is_bounce"),
        )
        return rollup.minute_aggregates(rollup.minute_states(raw)).first().unique_users

    assert users(60_000) == 60_000
    assert abs(users(200_000) - 200_000) < 4_000


def test_sum_collapse(spark):
    df = spark.createDataFrame([("a", "x", 1, 2.5), ("a", "y", 2, 0.5), ("b", "z", 3, 1.0)], "k string, t string, n int, v double")
    got = rollup.sum_collapse(df, ["k"])
    assert multiset(got) == ["('a', 3, 3.0)", "('b', 3, 1.0)"]
    with pytest.raises(ValueError):
        rollup.sum_collapse(df.select("k", "t"), ["k"])


def test_latest_aggregates(spark):
    _, raw = raw_rows(spark, 2000, 4)
    states = rollup.minute_states(raw)
    rows = queries.latest_aggregates(states, "2024-01-30 12:00:00", hours=1).collect()
    assert rows and all(r.window_start >= datetime(2024, 1, 30, 11) for r in rows)
    assert rows == sorted(rows, key=lambda r: (-r.window_start.timestamp(), r.page_id))
    assert queries.latest_aggregates(states, "2024-01-31 12:00:00").count() == 0


def test_latest_is_limited_to_100(spark):
    rows = [(START + timedelta(minutes=i // 3), f"p{i}", "u", 1, 0) for i in range(150)]
    states = rollup.minute_states(spark.createDataFrame(rows, SCHEMA))
    got = queries.latest_aggregates(states, START + timedelta(hours=1), hours=2).collect()
    assert [r.page_id for r in got[:3]] == ["p147", "p148", "p149"] and len(got) == 100


@pytest.mark.parametrize("hours", [0, 25])
def test_hours_are_checked(spark, hours):
    with pytest.raises(ValueError, match="must be 1-24"):
        queries.latest_aggregates(spark.range(1), hours=hours)


@pytest.mark.parametrize("limit", [0, 1001])
def test_limit_is_checked(spark, limit):
    with pytest.raises(ValueError, match="must be 1-1000"):
        queries.latest_errors(spark.range(1), limit=limit)
