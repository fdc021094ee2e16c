"""The gate's rules at their boundaries, and the words of its reasons."""

import pytest

from helpers import NOW, event, messages
from pagetide.functions import quality
from pagetide.operators import events

OLD = "timestamp is too old (more than 30 days)"
ZERO = "0001-01-01 00:00:00 +0000 UTC"


def reason(field, message, value):
    return f"validation error: field={field}, message={message}, value={value}"


NO_PAGE = reason("page_id", "page_id cannot be empty", "")
NO_USER = reason("user_id", "user_id cannot be empty", "")
ZERO_TIME = "; ".join(
    [reason("timestamp", "timestamp cannot be zero", ZERO), reason("timestamp", OLD, ZERO)]
)


def future(shown):
    return reason("timestamp", "timestamp is too far in the future", shown)


CASES = {
    "required only": (event(user_agent=..., ip_address=..., region=...), None),
    "duration 0": (event(view_duration_ms=0), None),
    "duration 24 h": (event(view_duration_ms=86_400_000), None),
    "one hour ahead": (event(timestamp="2024-01-31T01:00:00Z"), None),
    "30 days old": (event(timestamp="2024-01-01T00:00:00Z"), None),
    "no page": (event(page_id=...), NO_PAGE),
    "empty page": (event(page_id=""), NO_PAGE),
    "null user": (event(user_id=None), NO_USER),
    "no ids": (event(page_id="", user_id=""), f"{NO_PAGE}; {NO_USER}"),
    "duration -1": (
        event(view_duration_ms=-1),
        reason("view_duration_ms", "view_duration_ms cannot be negative", "-1"),
    ),
    "duration 24 h + 1": (
        event(view_duration_ms=86_400_001),
        reason("view_duration_ms", "view_duration_ms exceeds maximum (24 hours)", "86400001"),
    ),
    "no time": (event(timestamp=...), ZERO_TIME),
    "null time": (event(timestamp=None), ZERO_TIME),
    "zero time": (event(timestamp="0001-01-01T00:00:00Z"), ZERO_TIME),
    "too new": (
        event(timestamp="2024-01-31T01:00:00.000001Z"),
        future("2024-01-31 01:00:00.000001 +0000 UTC"),
    ),
    "too new elsewhere": (
        event(timestamp="2024-01-31T06:00:00.50+03:00"),
        future("2024-01-31 06:00:00.5 +0300 +0300"),
    ),
    "too old": (
        event(timestamp="2023-12-31T23:59:59.999999Z"),
        reason("timestamp", OLD, "2023-12-31 23:59:59.999999 +0000 UTC"),
    ),
    "null": ("null", f"{NO_PAGE}; {NO_USER}; {ZERO_TIME}"),
    "all at once": (
        event(page_id="", user_id="", view_duration_ms=-5, timestamp="2020-01-01T00:00:00Z"),
        "; ".join(
            [
                NO_PAGE,
                NO_USER,
                reason("view_duration_ms", "view_duration_ms cannot be negative", "-5"),
                reason("timestamp", OLD, "2020-01-01 00:00:00 +0000 UTC"),
            ]
        ),
    ),
    "broken": ('{"page_id":"a', reason("json", "invalid JSON format", '{"page_id":"a')),
    "tombstone": (None, reason("json", "invalid JSON format", "")),
}


@pytest.fixture(scope="module")
def gated(spark):
    rows = events.gate(messages(spark, [v for v, _ in CASES.values()]), NOW)
    return rows.withColumn("reason", quality.error_reason()).withColumn(
        "errors", quality.errors()
    )


def test_verdicts_and_reasons(gated):
    rows = gated.select("is_valid", "reason", "errors").orderBy("offset").collect()
    for (name, (_, expected)), row in zip(CASES.items(), rows):
        assert row.is_valid == (expected is None), name
        assert row.reason == (expected or ""), name
        spelled = "; ".join(reason(e.field, e.message, e.value) for e in row.errors)
        assert spelled == (expected or ""), name


def test_every_message_goes_to_exactly_one_table(spark, gated):
    raw = events.raw_rows(gated).count()
    errors = events.error_rows(gated).count()
    assert raw == sum(expected is None for _, expected in CASES.values())
    assert raw + errors == len(CASES)


def test_raw_shape(spark):
    sent = event(
        timestamp="2024-01-30T23:59:59.9876543Z", ip_address="bad", is_bounce=True, region=...
    )
    gated = events.gate(messages(spark, [sent], partition=2, start=7), "2024-01-31 00:00:01.75")
    row = events.raw_rows(gated).first()
    assert str(row.event_date) == "2024-01-30"
    assert str(row.event_time) == "2024-01-30 23:59:59.987000"
    assert (row.duration_ms, row.ip_address, row.region, row.is_bounce) == (
        1200,
        "::ffff:0.0.0.0",
        "",
        1,
    )
    assert (row.kafka_offset, row.kafka_partition) == (7, 2)
    assert str(row.processed_time) == "2024-01-31 00:00:01"


def test_error_shape(spark):
    gated = events.gate(messages(spark, ["x", None], partition=1, start=4), NOW)
    first, second = events.error_rows(gated).orderBy("kafka_offset").collect()
    assert (first.raw_message, first.kafka_offset, first.kafka_partition) == ("x", 4, 1)
    assert second.raw_message == ""
    assert str(first.error_time) == "2024-01-31 00:00:00"


def test_routed_rows_hold_both_tables(spark, gated):
    routed = events.routed_rows(gated)
    raw = events.raw_rows(gated)
    errors = events.error_rows(gated)
    from helpers import multiset

    assert multiset(routed.filter("route = 'raw'").select(*raw.columns)) == multiset(raw)
    assert multiset(routed.filter("route = 'errors'").select(*errors.columns)) == multiset(errors)


def test_event_classes(spark):
    rows = events.gate(messages(spark, [event(), event(is_bounce=True), "x"]), NOW)

    found = rows.orderBy("offset").select(quality.event_class()).collect()
    assert [r[0] for r in found] == ["normal", "bounce", "error"]
