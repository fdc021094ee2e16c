"""Small builders shared by the tests."""

from __future__ import annotations

import json

from pagetide.schema import MESSAGE

NOW = "2024-01-31 00:00:00"

GOOD = {
    "page_id": "page_1",
    "user_id": "user_2",
    "view_duration_ms": 1200,
    "timestamp": "2024-01-30T10:20:30.5Z",
    "user_agent": "agent",
    "ip_address": "10.0.0.1",
    "region": "EU",
    "is_bounce": False,
}


def event(**changes) -> str:
    """A good event with fields replaced, or dropped where given as ``...``."""
    fields = GOOD | changes
    return json.dumps({k: v for k, v in fields.items() if v is not ...}, separators=(",", ":"))


def messages(spark, values, partition=0, start=0):
    from datetime import datetime

    at = datetime(2024, 1, 30, 12, 0, 0)
    rows = [(v, "page-views", partition, start + i, at) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE)


def multiset(df):
    names = sorted(df.columns)
    return sorted(map(repr, (tuple(row) for row in df.select(*names).collect())))
