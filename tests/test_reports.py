"""Counters, health, mixes, histograms, offsets and repeats."""

from datetime import datetime

from pyspark.sql import functions as F

from helpers import NOW, event, messages, multiset
from pagetide.operators import dedup, events, reports


def gated(spark, values):
    return events.gate(messages(spark, values), NOW)


def test_status_and_health_of_nothing(spark):
    empty = gated(spark, [event()]).limit(0)
    status = reports.ingest_status(empty).first()
    assert (status.messages_processed, status.valid_messages, status.invalid_messages) == (0, 0, 0)
    health = reports.health(empty).first()
    assert (health.status, health.issues, health.invalid_rate) == ("healthy", "", 0.0)
    assert reports.event_mix(empty).count() == 0
    assert reports.failures_by_rule(empty).count() == 0


def test_status(spark):
    row = reports.ingest_status(gated(spark, [event(), "x", event(page_id="")])).first()
    assert (row.messages_processed, row.valid_messages, row.invalid_messages) == (3, 1, 2)
    assert row.last_consume_time == datetime(2024, 1, 30, 12)
    assert row.last_insert_time == datetime(2024, 1, 31)


def test_health_turns_above_half(spark):
    half = reports.health(gated(spark, [event(), "x"])).first()
    assert (half.status, half.issues) == ("healthy", "")
    more = reports.health(gated(spark, [event(), "x", "y"])).first()
    assert (more.status, more.issues) == ("unhealthy", "High invalid message rate: 66.67%")
    errors = reports.health(gated(spark, [event()]), source_errors=101).first()
    assert (errors.status, errors.issues) == ("unhealthy", "High Kafka error count")
    assert reports.health(gated(spark, [event()]), source_errors=100).first().status == "healthy"


def test_delivery_health_needs_more_than_a_hundred(spark):
    few = reports.delivery_health(spark.range(100), F.col("id") < 50).first()
    assert few.status == "healthy"
    many = reports.delivery_health(spark.range(200), F.col("id") < 189).first()
    assert (many.status, many.issues) == ("unhealthy", "Low success rate: 94.50%")
    enough = reports.delivery_health(spark.range(200), F.col("id") < 190).first()
    assert (enough.status, enough.issues) == ("healthy", "")


def test_offsets_counts_and_lag(spark):
    rows = messages(spark, ["a", "b", "c"], partition=0, start=5).unionByName(
        messages(spark, ["d"], partition=1, start=40)
    )
    assert multiset(reports.next_offsets(rows)) == ["(0, 8)", "(1, 41)"]
    assert multiset(reports.partition_counts(rows)) == ["(0, 3)", "(1, 1)"]
    lag = {r.kafka_partition: r for r in reports.consumer_lag(rows, F.col("offset") < 7).collect()}
    assert (lag[0].end_offset, lag[0].next_offset, lag[0].lag) == (8, 7, 1)
    assert (lag[1].end_offset, lag[1].next_offset, lag[1].lag) == (41, 40, 1)


def test_event_mix(spark):
    rows = gated(spark, [event(), event(), event(is_bounce=True), "x"])
    mix = {r.event_class: (r.events, r.share) for r in reports.event_mix(rows).collect()}
    assert mix == {"normal": (2, 0.5), "bounce": (1, 0.25), "error": (1, 0.25)}
    periods = {(r.period, r.event_class) for r in reports.event_mix_by_period(rows).collect()}
    assert periods == {("day", "normal"), ("day", "bounce"), ("day", "error")}


def test_failures_by_rule(spark):
    rows = gated(spark, ["x", "y", event(page_id="", user_id=""), event(timestamp=...)])
    found = {
        r.message: r.failures for r in reports.failures_by_rule(rows).collect()
    }
    assert found == {
        "invalid JSON format": 2,
        "page_id cannot be empty": 1,
        "user_id cannot be empty": 1,
        "timestamp cannot be zero": 1,
        "timestamp is too old (more than 30 days)": 1,
    }


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.0, 1.5, 9.0, None)], "v double")
    rows = reports.histogram(df, F.col("v"), [1.0, 2.0]).orderBy("bucket").collect()
    assert [(r.le, r.cumulative_count) for r in rows] == [(1.0, 2), (2.0, 3), (None, 4)]


def test_repeats(spark):
    sent = [event(user_id=f"u{i % 3}") for i in range(9)]
    rows = messages(spark, sent)
    twice = rows.unionByName(rows)
    assert multiset(dedup.drop_replays(twice)) == multiset(rows)
    raw = events.raw_rows(events.gate(rows, NOW))
    assert {r.copies for r in dedup.duplicate_events(raw).collect()} == {3}
    kept = dedup.drop_resends(raw).orderBy("kafka_offset").collect()
    assert [r.kafka_offset for r in kept] == [0, 1, 2]
    assert dedup.duplicate_events(raw.filter("kafka_offset < 3")).count() == 0
