"""The continuous ingest: messages in, all tables kept up to date.

No watermark is involved: each micro-batch appends partial states, and states of
a window merge whenever they arrive, so an event is never too late for its
window until the gate calls it too old.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pagetide.functions import times
from pagetide.operators import events, reports
from pagetide.sources import files
from pagetide.sources import tables as stored

FLUSH_MODES = ("batch", "time", "hybrid")

# The reference values of the flush rule, for a topic of a few events a second.
SMALL_ROWS, SMALL_SECONDS = 1000, 10

# Defaults for a large cluster: files of a useful size, a few batches a minute at most.
ROWS, SECONDS = 1_000_000, 60


def flush_rule(
    mode: str = "hybrid", rows: int = ROWS, seconds: int = SECONDS
) -> tuple[dict[str, str], dict[str, str]]:
    """Source options and trigger for flushing by size, by time or by either."""
    if mode not in FLUSH_MODES:
        raise ValueError(f"mode must be one of {FLUSH_MODES}")
    if rows < 1 or seconds < 1:
        raise ValueError("rows and seconds must be positive")
    if mode == "time":
        return {}, {"processingTime": f"{seconds} seconds"}
    size = {"minOffsetsPerTrigger": str(rows)}
    if mode == "hybrid":
        size["maxTriggerDelay"] = f"{seconds}s"
    return size, {"processingTime": "0 seconds"}


def start_ingest(
    messages: DataFrame,
    tables: stored.Tables,
    checkpoint: str,
    as_of: times.Clock = None,
    name: str | None = None,
    drop_replays: bool = False,
    extras: stored.Extras = stored.Extras(),
    **trigger: object,
) -> StreamingQuery:
    """Run the ingest over a stream of messages.

    With the default clock each micro-batch is judged by its own start time,
    which the checkpoint remembers, so a replayed batch is judged alike and
    replaces its earlier output. Tables and checkpoint belong together: batch
    numbers start over with a new checkpoint, so tables that another checkpoint
    has filled are refused. ``drop_replays`` leaves out messages that an earlier
    batch has stored, however long ago; ``extras`` says whether events sent again are
    left out too, and what is kept besides the tables.

    ``trigger`` is passed on; ``availableNow=True`` drains the topic and stops.
    """
    spark = messages.sparkSession
    stored.create_directories(spark, tables)
    known = files.read_text(spark, f"{checkpoint}/metadata")
    if (found := stored.owner(spark, tables)) is not None and (not known or json.loads(known)["id"] != found):
        raise ValueError(f"{tables.root} has been filled from another checkpoint than {checkpoint}")
    gated = events.gate(messages, as_of)
    routed = events.routed_rows(gated.observe("ingest", *reports.ingest_counts()))

    def store(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        stored.store_batch(batch, batch_id, tables, query, True, drop_replays, extras)

    writer = routed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    return writer.trigger(**trigger).start()


def drain(
    messages: DataFrame,
    tables: stored.Tables,
    checkpoint: str,
    as_of: times.Clock = None,
    drop_replays: bool = False,
    extras: stored.Extras = stored.Extras(),
) -> None:
    """Flush everything that is there now and return when it is stored."""
    query = start_ingest(
        messages, tables, checkpoint, as_of, drop_replays=drop_replays, extras=extras, availableNow=True
    )
    query.awaitTermination()
