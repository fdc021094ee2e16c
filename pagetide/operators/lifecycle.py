"""Retention and compaction of stored tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide.functions import quality, times
from pagetide.operators import rollup
from pagetide.schema import ERROR_ROUTE, RAW_ROUTE
from pagetide.sources import content, files, tables as stored

RAW_DAYS = 30
MINUTE_DAYS = 7


def apply_retention(df: DataFrame, column: str, days: int, as_of: times.Clock) -> DataFrame:
    """Rows whose ``column`` plus ``days`` days still lies ahead of the clock.

    The days are taken off the clock, so that scans can skip by the bare column.
    """
    oldest = times.clock(as_of) - F.make_dt_interval(days=F.lit(days))
    is_date = df.schema[column].dataType.typeName() == "date"
    kept = df.filter(F.col(column) > (F.to_date(oldest) if is_date else oldest))
    if "month" in df.columns:
        kept = kept.filter(F.col("month") >= times.month(oldest))
    return kept


# What expires, when, by which column.
RETENTION = {RAW_ROUTE: ("event_date", RAW_DAYS), stored.MINUTE: ("window_start", MINUTE_DAYS)}


def read_retained(spark: SparkSession, tables: stored.Tables, table: str, as_of: times.Clock = None) -> DataFrame:
    """Rows of stored raw events or minute states that have not expired, dropped yet or not."""
    column, days = RETENTION[table]
    return apply_retention(stored.read(spark, tables, table), column, days, as_of)


def _month_is_over(month: int, days: int, as_of: datetime) -> bool:
    """Every row of the month has expired."""
    year, number = divmod(month, 100)
    following = date(year + number // 12, number % 12 + 1, 1)
    return datetime.combine(following, datetime.min.time()) + timedelta(days=days) <= as_of


def drop_expired(spark: SparkSession, tables: stored.Tables, as_of: datetime) -> list[str]:
    """Delete month directories of raw events and minute states past retention, and
    days of the content index that the gate lets no event of in any more.

    Looks at the names of directories only, and deletes each with all batches in it.
    Hours and errors are kept.
    """
    dropped = []
    for table, (_, days) in RETENTION.items():
        for base in (tables.live(table), f"{tables.compacted(table)}/batches=*"):
            for path in files.matching(spark, f"{base}/month=*"):
                if _month_is_over(int(files.partition_value(path)), days, as_of):
                    files.delete(spark, path)
                    dropped.append(path)
    oldest = (as_of - timedelta(hours=quality.MAX_AGE_HOURS)).date()
    return dropped + content.drop_days_before(spark, tables.root, oldest)


def compact(
    spark: SparkSession, tables: stored.Tables, table: str, last: int, first: int | None = None
) -> None:
    """Merge batches ``first`` to ``last`` of a table into one directory.

    Minute and hour states of one key become one row; raw events and rejected
    messages stay as they are, in fewer and sorted files. By default ``first``
    follows what is compacted already, so the work is in proportion to what is new;
    name an earlier ``first`` to merge earlier ranges again. Compact only finished
    batches that will not be replayed, that is, older than the last committed one.
    Readers switch over when the directory is complete; what it replaces can be
    deleted later with ``clean``.

    The range shuffle already groups equal keys, so the merge adds none, and
    leaves files that cover disjoint time ranges.
    """
    ranges = stored.compacted_ranges(spark, tables, table)
    following = max((r[1] + 1 for r in ranges), default=0)
    if first is None:
        first = following
    if first > following:
        raise ValueError(f"batches from {following} on are not compacted yet")
    if last < first or (first, last) in ranges:
        raise ValueError(f"nothing to compact from batch {first} to {last}")
    if not any(a <= first and last <= b for a, b in stored.committed_ranges(spark, tables)):
        raise ValueError(f"batches {first} to {last} are not all finished")
    rows = stored.read(spark, tables, table, first, last)
    if table in (stored.MINUTE, stored.HOUR):
        rows = rollup.merge_states(rows.repartitionByRange("window_start", "page_id"))
    else:
        order = _ORDER[table]
        rows = rows.drop("batch_id").repartitionByRange("month", *order).sortWithinPartitions("month", *order)
    stored.write_compacted(rows, tables, table, first, last)


_ORDER = {RAW_ROUTE: ["event_date", "page_id", "user_id"], ERROR_ROUTE: ["error_time"]}

# What a reader that has planned its files may take to read them.
GRACE_SECONDS = 3600


def clean(
    spark: SparkSession, tables: stored.Tables, table: str, grace_seconds: float = GRACE_SECONDS
) -> None:
    """Delete what complete compacted directories have replaced, after the grace period.

    Directories still being written have no range yet and are left alone.
    """
    done = {
        tuple(map(int, files.partition_value(p.rsplit("/", 1)[0]).split("-"))): p
        for p in files.matching(spark, f"{tables.compacted(table)}/batches=*/_SUCCESS")
    }
    ranges = stored.compacted_ranges(spark, tables, table)
    old = [r for r in ranges if files.age_seconds(spark, done[r]) >= grace_seconds]
    after = max((r[1] for r in old), default=-1)
    for path in files.matching(spark, f"{tables.live(table)}/month=*/batch_id=*"):
        if int(files.partition_value(path)) <= after:
            files.delete(spark, path)
    for path in files.matching(spark, f"{tables.live(table)}/month=*"):
        files.delete_if_empty(spark, path)
    for inner, path in done.items():
        if inner not in ranges and any(r[0] <= inner[0] and inner[1] <= r[1] for r in old):
            files.delete(spark, path.rsplit("/", 1)[0])
    compacted = [stored.compacted_ranges(spark, tables, t) for t in stored.SCHEMAS]
    stored.fold_commits(spark, tables, min(max((r[1] for r in some), default=-1) for some in compacted))
