"""From messages to gated events, and from those to rows of the two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.functions import ip, quality, times
from pagetide.operators.decode import decode
from pagetide.operators.once import once
from pagetide.schema import ERROR_ROUTE, ERRORS, LOG, RAW, RAW_ROUTE


def gate(messages: DataFrame, as_of: times.Clock = None) -> DataFrame:
    """Decoded messages with ``clock`` and the gate's verdict in ``is_valid``."""
    clocked = decode(messages).withColumn("clock", times.clock(as_of))
    return clocked.withColumn("is_valid", quality.is_valid())


def with_canonical_ip(df: DataFrame) -> DataFrame:
    """Replace ``ip_address`` by its canonical IPv6 text."""
    staged = once(df, "_ip_groups", ip.colon_groups("ip_address"))
    staged = once(staged, "_ip_full", ip.full_groups("_ip_groups"))
    canonical = F.expr(ip.canonical("ip_address", "_ip_full"))
    return staged.withColumn("ip_address", canonical).drop("_ip_groups", "_ip_full")


_RAW = {
    "event_date": "to_date(event_ts)",
    "event_time": "date_trunc('millisecond', event_ts)",
    "page_id": "page_id",
    "user_id": "user_id",
    "duration_ms": "view_duration_ms",
    "user_agent": "user_agent",
    "ip_address": "ip_address",
    "region": "region",
    "is_bounce": "CAST(is_bounce AS TINYINT)",
    "kafka_offset": "offset",
    "kafka_partition": "partition",
    "processed_time": "date_trunc('second', clock)",
}

_ERRORS = {
    "error_time": "date_trunc('second', clock)",
    "raw_message": quality.MESSAGE_TEXT,
    "error_reason": "error_reason",
    "kafka_offset": "offset",
    "kafka_partition": "partition",
}


def raw_rows(gated: DataFrame) -> DataFrame:
    """Valid events in the shape of the raw table."""
    valid = with_canonical_ip(gated.filter("is_valid"))
    return valid.selectExpr(*[f"{_RAW[name]} AS {name}" for name in RAW.fieldNames()])


def error_rows(gated: DataFrame) -> DataFrame:
    """Rejected messages with their reasons, in the shape of the error table."""
    rejected = gated.filter("NOT is_valid").withColumn("error_reason", quality.error_reason())
    return rejected.selectExpr(*[f"{_ERRORS[name]} AS {name}" for name in ERRORS.fieldNames()])


def routed_rows(gated: DataFrame) -> DataFrame:
    """Both outcomes in one pass, in the shape of the stored log.

    ``month`` is the event's month for valid rows and the month of rejection for
    errors.
    """
    reasoned = gated.withColumn("_reason", quality.error_reason())
    staged = once(with_canonical_ip(reasoned), "error_reason", "CASE WHEN NOT is_valid THEN _reason END")
    columns = {name: f"CASE WHEN is_valid THEN {sql} END" for name, sql in _RAW.items()}
    columns |= {name: f"CASE WHEN NOT is_valid THEN {sql} END" for name, sql in _ERRORS.items()}
    columns["kafka_offset"] = "offset"
    columns["kafka_partition"] = "partition"
    columns["route"] = f"CASE WHEN is_valid THEN '{RAW_ROUTE}' ELSE '{ERROR_ROUTE}' END"
    day = f"CASE WHEN is_valid THEN {_RAW['event_date']} ELSE to_date(clock) END"
    columns["month"] = f"year({day}) * 100 + month({day})"
    names = [name for name in LOG.fieldNames() if name in columns]
    return staged.selectExpr(*[f"{columns[name]} AS {name}" for name in names])
