"""The quality gate: seven rules over decoded events, and their wording.

Every failure of an event is reported, in rule order. A message that does not
decode has that one failure only. Rules look at the fields of the event and at
``clock``, the time the message is judged at.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetide.functions import times

MAX_DURATION_MS = 24 * 60 * 60 * 1000
MAX_AHEAD_HOURS = 1
MAX_AGE_HOURS = 30 * 24
BOUNCE_MS = 5000


class Rule(NamedTuple):
    """What fails, in which words; ``failed`` and ``value`` are SQL expressions."""

    field: str
    message: str
    failed: str
    value: str


_SHOWN_TIME = times.display_time("timestamp_text")

# The message as text; empty for a tombstone, stray bytes replaced.
MESSAGE_TEXT = "coalesce(make_valid_utf8(CAST(value AS STRING)), '')"

UNDECODABLE = Rule("json", "invalid JSON format", "NOT decoded", MESSAGE_TEXT)

# For decoded events, in the order failures are reported. An event without a
# time lies before any limit, so it is too old as well.
RULES = [
    Rule("page_id", "page_id cannot be empty", "page_id = ''", "page_id"),
    Rule("user_id", "user_id cannot be empty", "user_id = ''", "user_id"),
    Rule(
        "view_duration_ms",
        "view_duration_ms cannot be negative",
        "view_duration_ms < 0",
        "CAST(view_duration_ms AS STRING)",
    ),
    Rule(
        "view_duration_ms",
        "view_duration_ms exceeds maximum (24 hours)",
        f"view_duration_ms > {MAX_DURATION_MS}",
        "CAST(view_duration_ms AS STRING)",
    ),
    Rule("timestamp", "timestamp cannot be zero", "event_ts IS NULL", _SHOWN_TIME),
    Rule(
        "timestamp",
        "timestamp is too far in the future",
        f"coalesce(event_ts > clock + INTERVAL {MAX_AHEAD_HOURS} HOURS, false)",
        _SHOWN_TIME,
    ),
    Rule(
        "timestamp",
        "timestamp is too old (more than 30 days)",
        f"coalesce(event_ts < clock - INTERVAL {MAX_AGE_HOURS} HOURS, true)",
        _SHOWN_TIME,
    ),
]


def is_valid() -> Column:
    return F.expr(" AND ".join(["decoded", *[f"NOT ({rule.failed})" for rule in RULES]]))


def errors() -> Column:
    """All failures as ARRAY<STRUCT<field, message, value>>, empty when valid."""

    def entry(rule: Rule) -> str:
        return (
            f"named_struct('field', '{rule.field}', 'message', '{rule.message}',"
            f" 'value', {rule.value})"
        )

    found = ", ".join(f"CASE WHEN {r.failed} THEN {entry(r)} END" for r in RULES)
    return F.expr(
        f"""CASE WHEN {UNDECODABLE.failed} THEN array({entry(UNDECODABLE)})
            ELSE array_compact(array({found})) END"""
    )


def _in_words(rule: Rule) -> str:
    prefix = f"validation error: field={rule.field}, message={rule.message}, value="
    return f"concat('{prefix}', {rule.value})"


def error_reason() -> Column:
    """All failures in words, separated by ``; ``."""
    found = ", ".join(f"CASE WHEN {r.failed} THEN {_in_words(r)} END" for r in RULES)
    return F.expr(
        f"""CASE WHEN {UNDECODABLE.failed} THEN {_in_words(UNDECODABLE)}
            ELSE concat_ws('; ', {found}) END"""
    )


def event_class() -> Column:
    """``error``, ``bounce`` or ``normal`` for a gated message."""
    return F.expr(
        "CASE WHEN NOT is_valid THEN 'error' WHEN is_bounce THEN 'bounce' ELSE 'normal' END"
    )


def bounce_mismatch() -> Column:
    """The sender's bounce flag disagrees with the five-second definition."""
    return F.expr(f"CAST(is_bounce AS BOOLEAN) <> (duration_ms < {BOUNCE_MS})")
