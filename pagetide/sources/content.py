"""Leaving out resends: events stored before with the same content, at whatever offset.

An index keeps two 64-bit hashes of every stored event's content in directories by the
event's day. A resend carries its event time, so a batch is compared with the days of
its own events alone: the scan of the index is pruned to them while the query runs, and
three numbers an event are read. The gate lets in 30 days, so older days can go.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide.functions import times
from pagetide.operators import dedup
from pagetide.schema import CONTENT_KEY, RAW, RAW_ROUTE
from pagetide.sources import files
from pagetide.sources.parts import Parts

KEY = ["event_date", "key_1", "key_2"]


def index(root: str) -> Parts:
    return Parts(f"{root}/content_index", CONTENT_KEY, by=("event_date",))


def with_key(raw: DataFrame) -> DataFrame:
    """Raw rows with 128 bits of hashes of what makes events the same."""
    columns = [F.col(name) for name in dedup.CONTENT]
    return raw.withColumn("key_1", F.xxhash64(*columns)).withColumn("key_2", F.xxhash64(F.lit("content"), *columns))


def seen_on_days_of(keyed: DataFrame, root: str, batch_id: int) -> DataFrame:
    """Content keys that earlier batches have stored for the days of these events.

    The days are as many as the gate lets in, a few dozen at most, so they are sent
    to all tasks, and the index's directories of other days are not opened.
    """
    # without a comparison the optimizer expects nothing from pruning
    known = F.expr("event_date >= DATE '0001-01-01'")
    days = F.broadcast(keyed.filter(known).select("event_date").distinct())
    return index(root).read(keyed.sparkSession, before=batch_id).join(days, "event_date").select(*KEY)


def without_resends(routed: DataFrame, root: str, batch_id: int) -> DataFrame:
    """Rows of both routes without valid events that this batch or an earlier one holds.

    Of copies in one batch that of lowest partition and offset stays.
    """
    valid = F.col("route") == RAW_ROUTE
    keyed = with_key(dedup.drop_resends(routed.filter(valid).select(*RAW.fieldNames())))
    fresh = keyed.join(seen_on_days_of(keyed, root, batch_id), KEY, "left_anti").drop("key_1", "key_2")
    fresh = fresh.withColumn("route", F.lit(RAW_ROUTE)).withColumn("month", times.month(F.col("event_date")))
    return routed.filter(~valid).unionByName(fresh, allowMissingColumns=True)


def write_batch_keys(raw: DataFrame, root: str, batch_id: int) -> None:
    """Keep the keys of a batch's stored events."""
    index(root).write(with_key(raw), batch_id)


def drop_days_before(spark: SparkSession, root: str, oldest: date) -> list[str]:
    """Delete days no event of which can come again."""
    gone = [
        path
        for path in files.matching(spark, f"{index(root).root}/event_date=*")
        if date.fromisoformat(files.partition_value(path)) < oldest
    ]
    for path in gone:
        files.delete(spark, path)
    return gone
