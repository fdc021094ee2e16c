"""Encoding of events as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetide.functions import times


def encode() -> Column:
    """The event in this row as JSON.

    An empty user agent, address or region is left out.
    """
    return F.expr(
        f"""to_json(named_struct(
            'page_id', page_id,
            'user_id', user_id,
            'view_duration_ms', view_duration_ms,
            'timestamp', {times.format_rfc3339('event_ts')},
            'user_agent', nullif(user_agent, ''),
            'ip_address', nullif(ip_address, ''),
            'region', nullif(region, ''),
            'is_bounce', is_bounce))"""
    )
