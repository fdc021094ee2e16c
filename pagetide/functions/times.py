"""Time expressions: clocks, buckets, RFC 3339 parsing and display.

Functions that take and return ``str`` work on SQL expressions, the others on
columns.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Clock = Column | datetime | str | None

# The zero time, which an absent timestamp stands for.
ZERO_TIME = "0001-01-01 00:00:00"

RFC3339 = (
    r"^\d{4}-\d{2}-\d{2}T(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d+)?"
    r"(?:Z|[+-](?:[01]\d|2[0-3]):[0-5]\d)\z"
)


def clock(as_of: Clock) -> Column:
    """``as_of`` as a timestamp column; the current time when it is None."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp")


def hours_before(as_of: Clock, hours: int) -> Column:
    return clock(as_of) - F.make_dt_interval(hours=F.lit(hours))


def parse_rfc3339(text: str) -> str:
    """Instant of an RFC 3339 text, null where the text is anything else.

    Digits past the microsecond are cut. The offset is applied by hand because
    RFC 3339 allows offsets up to 23:59 and Spark's own parser only up to 18:00.
    """
    sign = f"CASE WHEN substring({text}, -6, 1) = '-' THEN 1 ELSE -1 END"
    return f"""CASE WHEN {text} RLIKE r'{RFC3339}' THEN
        CASE WHEN endswith({text}, 'Z') THEN try_to_timestamp({text})
        ELSE try_to_timestamp(concat(substring({text}, 1, length({text}) - 6), 'Z'))
             + make_dt_interval(0, ({sign}) * CAST(substring({text}, -5, 2) AS INT),
                                   ({sign}) * CAST(substring({text}, -2, 2) AS INT))
        END END"""


def format_rfc3339(ts: str) -> str:
    """UTC RFC 3339 text with the fraction's trailing zeros dropped."""
    micros = f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    return f"concat(rtrim('.', rtrim('0', {micros})), 'Z')"


def display_time(text: str) -> str:
    """An RFC 3339 text as the error reasons print it.

    ``2024-01-15 12:00:00.12 +0000 UTC``: up to nine fraction digits without
    trailing zeros, and a non-zero offset printed twice, once as zone name.
    """
    fraction = rf"rtrim('.', rtrim('0', regexp_extract({text}, r'(\.\d{{1,9}})', 1)))"
    offset = f"replace(substring({text}, -6, 6), ':')"
    return rf"""CASE WHEN {text} IS NULL THEN '{ZERO_TIME} +0000 UTC' ELSE
        concat(substring({text}, 1, 10), ' ', substring({text}, 12, 8), {fraction},
               CASE WHEN {text} RLIKE r'(?:Z|[+-]00:00)\z' THEN ' +0000 UTC'
                    ELSE concat(' ', {offset}, ' ', {offset}) END) END"""


def minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def month(day: Column) -> Column:
    """Month partition key, e.g. 202401."""
    return F.year(day) * 100 + F.month(day)


def traffic_period(ts: Column) -> Column:
    """``night`` for 00:00-05:59 UTC, else ``day``."""
    return F.when(F.hour(ts) < 6, "night").otherwise("day")


def naive(ts: Column) -> Column:
    """Zone-less copy of a UTC timestamp, for results compared outside Spark."""
    return ts.cast("timestamp_ntz")
