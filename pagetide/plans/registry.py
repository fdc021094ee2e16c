"""Named queries over the driver's tables, one or more per operator.

Every query reads the whole ``events`` table as broker messages. Stored-table
and stream queries write below the shared folder of the session first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetide import session
from pagetide.functions import histogram, quality, times
from pagetide.operators import dedup, events, lifecycle, queries, reports, rollup, users
from pagetide.plans import fixture
from pagetide.schema import ERROR_ROUTE, HISTOGRAM_STATE, RAW_ROUTE
from pagetide.sources import buckets, catalog, publish, topic
from pagetide.sources import tables as stored
from pagetide.sources.parts import Parts
from pagetide.streaming import ingest, windows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def _presented(df: DataFrame) -> DataFrame:
    """Times without zone, so that results compare equal outside Spark."""
    return df.select(
        *[
            times.naive(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _presented(function(session.configure(spark), sf_dir))

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return run


def _gated(spark: SparkSession, sf_dir: str, as_of: str = fixture.MAIN) -> DataFrame:
    return events.gate(fixture.messages(spark, sf_dir), as_of)


def _raw(spark: SparkSession, sf_dir: str, as_of: str = fixture.MAIN) -> DataFrame:
    return events.raw_rows(_gated(spark, sf_dir, as_of))


def _errors(spark: SparkSession, sf_dir: str, as_of: str = fixture.MAIN) -> DataFrame:
    return events.error_rows(_gated(spark, sf_dir, as_of))


# Gate and row shapes


@query
def raw_events(spark, sf_dir):
    """Valid events as stored, with their month partition key."""
    return _raw(spark, sf_dir).withColumn("month", times.month(F.col("event_date")))


@query
def raw_ip_canonical(spark, sf_dir):
    """Canonical address of every valid event."""
    return _raw(spark, sf_dir).select("kafka_partition", "kafka_offset", "ip_address")


@query
def dead_letters(spark, sf_dir):
    return _errors(spark, sf_dir)


@query
def dead_letters_future(spark, sf_dir):
    """At a clock that half of the events lie ahead of."""
    return _errors(spark, sf_dir, fixture.EARLY)


@query
def dead_letters_old(spark, sf_dir):
    """At a clock half of the events are too old for."""
    return _errors(spark, sf_dir, fixture.LATE)


@query
def failures_by_rule(spark, sf_dir):
    return reports.failures_by_rule(_gated(spark, sf_dir))


@query
def failures_by_rule_late(spark, sf_dir):
    return reports.failures_by_rule(_gated(spark, sf_dir, fixture.LATE))


@query
def bounce_mismatch(spark, sf_dir):
    return (
        _raw(spark, sf_dir)
        .filter(quality.bounce_mismatch())
        .select("kafka_partition", "kafka_offset", "duration_ms", "is_bounce")
    )


# Aggregates


@query
def minute_aggregates(spark, sf_dir):
    return rollup.exact_aggregates(_raw(spark, sf_dir), times.minute)


@query
def hourly_rollup(spark, sf_dir):
    return rollup.with_ratios(rollup.exact_aggregates(_raw(spark, sf_dir), times.hour))


@query
def hourly_rollup_from_minutes(spark, sf_dir):
    """Hours cascaded from minute states within one job."""
    return rollup.hourly_rollup(rollup.minute_states(_raw(spark, sf_dir)))


def _stored_in_parts(
    spark: SparkSession, sf_dir: str, extras: stored.Extras = stored.Extras()
) -> stored.Tables:
    """Tables filled in four batches by topic partition, so that states overlap."""
    folder = session.run_folder(spark, "parts")
    tables = stored.Tables(f"{folder}/tables")
    stored.create_directories(spark, tables)
    messages = fixture.write_topic_partitions(spark, sf_dir, f"{folder}/topic")
    for batch_id in range(4):
        part = messages.filter(F.pmod("partition", F.lit(4)) == batch_id)
        stored.ingest_batch(part, batch_id, tables, fixture.MAIN, extras=extras)
    return tables


@query
def minute_states_merged(spark, sf_dir):
    """Minute rows merged from states stored by four batches."""
    tables = _stored_in_parts(spark, sf_dir)
    return rollup.minute_aggregates(stored.read_states(spark, tables))


@query
def minute_states_compacted(spark, sf_dir):
    """The same after two compactions, one on top of the other."""
    tables = _stored_in_parts(spark, sf_dir)
    lifecycle.compact(spark, tables, stored.MINUTE, last=1)
    lifecycle.compact(spark, tables, stored.MINUTE, last=2, first=0)
    return rollup.minute_aggregates(stored.read_states(spark, tables))


@query
def minute_users_exact(spark, sf_dir):
    """Exact distinct users per minute, from bitmaps stored by four batches."""
    tables = _stored_in_parts(spark, sf_dir, stored.Extras(exact_users=True))
    return users.distinct_users(stored.read_user_states(spark, tables))


@query
def hour_users_exact(spark, sf_dir):
    """The same bitmaps united to hours, in which users repeat over minutes."""
    tables = _stored_in_parts(spark, sf_dir, stored.Extras(exact_users=True))
    return users.distinct_users(stored.read_user_states(spark, tables), times.hour)


def _own_database(spark: SparkSession, folder: str) -> str:
    database = f"pagetide_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    return database


def _bucketed(spark: SparkSession, sf_dir: str) -> str:
    """A bucketed table of the minute states of four batches, in a database of its own."""
    folder = session.run_folder(spark, "bucketed")
    table = f"{_own_database(spark, folder)}.minute_states"
    messages = fixture.write_topic_partitions(spark, sf_dir, f"{folder}/topic")
    for batch_id in range(4):
        part = messages.filter(F.pmod("partition", F.lit(4)) == batch_id)
        raw = events.raw_rows(events.gate(part, fixture.MAIN))
        buckets.append_states(rollup.minute_states(raw), table, f"{folder}/states", buckets=8)
    return table


@query
def minute_states_bucketed(spark, sf_dir):
    """Minute rows merged from a table bucketed by page, without a shuffle."""
    return rollup.minute_aggregates(buckets.read_states(spark, _bucketed(spark, sf_dir)))


@query
def hour_states_bucketed(spark, sf_dir):
    """Hour rows from the same table, without a shuffle either."""
    return rollup.hourly_rollup(buckets.read_states(spark, _bucketed(spark, sf_dir)))


@query
def hour_states_merged(spark, sf_dir):
    """Hour rows merged from hour states stored by four batches."""
    tables = _stored_in_parts(spark, sf_dir)
    return rollup.hourly_rollup(stored.read_states(spark, tables, stored.HOUR))


def _compacted(spark: SparkSession, sf_dir: str, table: str) -> stored.Tables:
    """Tables of which one has been compacted twice and cleaned."""
    tables = _stored_in_parts(spark, sf_dir)
    lifecycle.compact(spark, tables, table, last=1)
    lifecycle.compact(spark, tables, table, last=2, first=0)
    lifecycle.clean(spark, tables, table, grace_seconds=0)
    return tables


@query
def raw_compacted(spark, sf_dir):
    """Raw events, three of four batches compacted."""
    raw = stored.read_raw(spark, _compacted(spark, sf_dir, RAW_ROUTE))
    return raw.drop("batch_id")


@query
def errors_compacted(spark, sf_dir):
    """Rejected messages, three of four batches compacted."""
    errors = stored.read_errors(spark, _compacted(spark, sf_dir, ERROR_ROUTE))
    return errors.drop("batch_id", "month")


@query
def sum_collapse_hour(spark, sf_dir):
    minutes = rollup.exact_aggregates(_raw(spark, sf_dir), times.minute)
    hours = minutes.withColumn("window_start", times.hour(F.col("window_start")))
    return rollup.sum_collapse(hours.drop("unique_users"), ["window_start", "page_id"])


# Served queries


@query
def latest_aggregates_1h(spark, sf_dir):
    states = rollup.minute_states(_raw(spark, sf_dir))
    return queries.latest_aggregates(states, fixture.MAIN, hours=1)


@query
def latest_aggregates_24h(spark, sf_dir):
    states = rollup.minute_states(_raw(spark, sf_dir))
    return queries.latest_aggregates(states, fixture.MAIN, hours=24)


@query
def latest_aggregates_stored(spark, sf_dir):
    """The latest minutes of the stored table, found by their keys first."""
    states = stored.read_states(spark, _stored_in_parts(spark, sf_dir))
    return queries.latest_aggregates(states, fixture.MAIN, hours=24, keys_first=True)


@query
def latest_errors_10(spark, sf_dir):
    return queries.latest_errors(_errors(spark, sf_dir), limit=10)


@query
def latest_errors_stored(spark, sf_dir):
    """The latest errors of the stored table, found by their times first."""
    tables = _stored_in_parts(spark, sf_dir)
    errors = stored.read_errors(spark, tables)
    return queries.latest_errors(errors, limit=100, narrow_first=True)


@query
def events_of_page_day(spark, sf_dir):
    """Stored events of one page and day, looked up by directory, order and filters."""
    raw = stored.read_raw(spark, _stored_in_parts(spark, sf_dir))
    return queries.events_of(raw, date(2024, 1, 10), page_id="page_3").drop("month", "batch_id")


@query
def events_of_user_day(spark, sf_dir):
    raw = stored.read_raw(spark, _stored_in_parts(spark, sf_dir))
    return queries.events_of(raw, date(2024, 1, 10), user_id="user_3").drop("month", "batch_id")


# Reports


@query
def offset_gaps(spark, sf_dir):
    """Offsets that the topic's partitions lack, as ranges; chunks of a few thousand here."""
    return reports.offset_gaps(fixture.messages(spark, sf_dir), chunk=4096)


@query
def next_offsets(spark, sf_dir):
    return reports.next_offsets(fixture.messages(spark, sf_dir))


@query
def partition_counts(spark, sf_dir):
    return reports.partition_counts(fixture.messages(spark, sf_dir))


@query
def consumer_lag(spark, sf_dir):
    """Lag of a consumer that has read what came in before the early clock."""
    seen = F.col("timestamp") < F.lit(fixture.EARLY).cast("timestamp")
    return reports.consumer_lag(fixture.messages(spark, sf_dir), seen)


@query
def ingest_status(spark, sf_dir):
    return reports.ingest_status(_gated(spark, sf_dir))


@query
def health(spark, sf_dir):
    return reports.health(_gated(spark, sf_dir))


@query
def health_late(spark, sf_dir):
    """Health at a clock most events are too old for, with source errors."""
    return reports.health(_gated(spark, sf_dir, fixture.LATE), source_errors=101)


@query
def delivery_health(spark, sf_dir):
    source = fixture.source_events(spark, sf_dir)
    return reports.delivery_health(source, F.col("event_type") != "error")


@query
def table_counts(spark, sf_dir):
    """Row counts of the stored raw and error tables."""
    tables = _stored_in_parts(spark, sf_dir)
    raw = reports.row_count(stored.read_raw(spark, tables), "page_views_raw")
    return raw.unionByName(
        reports.row_count(stored.read_errors(spark, tables), "processing_errors")
    )


@query
def writer_status(spark, sf_dir):
    """Stored rows, batches and latest write of tables filled in four batches."""
    tables = _stored_in_parts(spark, sf_dir)
    return reports.writer_status(
        stored.read_raw(spark, tables), stored.read_errors(spark, tables)
    )


@query
def event_mix(spark, sf_dir):
    return reports.event_mix(_gated(spark, sf_dir))


@query
def event_mix_by_period(spark, sf_dir):
    return reports.event_mix_by_period(_gated(spark, sf_dir))


@query
def duration_histogram(spark, sf_dir):
    edges = histogram.linear_edges(10, 10, 20)
    return reports.histogram(_raw(spark, sf_dir), reports.duration_seconds(), edges)


@query
def duration_histogram_exponential(spark, sf_dir):
    edges = histogram.exponential_edges(0.01, 2, 10)
    return reports.histogram(_raw(spark, sf_dir), reports.duration_seconds(), edges)


def _histograms(spark: SparkSession, sf_dir: str, edges: list[float]) -> DataFrame:
    """Histogram states per minute, stored by four batches."""
    folder = session.run_folder(spark, "histograms")
    parts = Parts(f"{folder}/states", HISTOGRAM_STATE, by=("month",))
    messages = fixture.write_topic_partitions(spark, sf_dir, f"{folder}/topic")
    for batch_id in range(4):
        part = messages.filter(F.pmod("partition", F.lit(4)) == batch_id)
        raw = events.raw_rows(events.gate(part, fixture.MAIN))
        states = reports.histogram_states(raw, reports.duration_seconds(), edges, times.minute(F.col("event_time")))
        parts.write(states.withColumn("month", times.month(F.col("window_start"))), batch_id)
    return parts.read(spark)


@query
def duration_histogram_merged(spark, sf_dir):
    """The histogram of all durations from stored minutes."""
    edges = histogram.linear_edges(10, 10, 20)
    merged = reports.merge_histograms(_histograms(spark, sf_dir, edges), len(edges) + 1)
    return reports.cumulated(merged, edges)


@query
def duration_histogram_by_day(spark, sf_dir):
    """One of each day, from the same kind of states."""
    edges = histogram.exponential_edges(0.01, 2, 10)
    day = F.date_trunc("day", "window_start")
    merged = reports.merge_histograms(_histograms(spark, sf_dir, edges), len(edges) + 1, day)
    return reports.cumulated(merged, edges)


@query
def ingest_lag_histogram(spark, sf_dir):
    edges = histogram.exponential_edges(3600, 2, 10)
    return reports.histogram(_raw(spark, sf_dir), reports.ingest_lag_seconds(), edges)


# Repeats


def _resent_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = events.gate(fixture.resent_messages(spark, sf_dir), fixture.MAIN)
    return events.raw_rows(gated)


@query
def duplicate_events(spark, sf_dir):
    return dedup.duplicate_events(_resent_raw(spark, sf_dir))


@query
def dedup_content(spark, sf_dir):
    return dedup.drop_resends(_resent_raw(spark, sf_dir))


@query
def dedup_replay(spark, sf_dir):
    once_each = dedup.drop_replays(fixture.replayed_messages(spark, sf_dir))
    gated = events.gate(once_each, fixture.MAIN)
    return events.raw_rows(gated).select(
        "kafka_partition", "kafka_offset", "event_time", "page_id", "user_id", "duration_ms"
    )


# Retention


@query
def retained_raw(spark, sf_dir):
    kept = lifecycle.apply_retention(
        _raw(spark, sf_dir), "event_date", lifecycle.RAW_DAYS, fixture.MAIN
    )
    return kept.select("kafka_partition", "kafka_offset", "event_date")


@query
def retained_minutes(spark, sf_dir):
    minutes = rollup.exact_aggregates(_raw(spark, sf_dir), times.minute)
    return lifecycle.apply_retention(
        minutes, "window_start", lifecycle.MINUTE_DAYS, fixture.MAIN
    )


@query
def retained_raw_stored(spark, sf_dir):
    """Raw events of the stored table that have not expired."""
    tables = _stored_in_parts(spark, sf_dir)
    kept = lifecycle.read_retained(spark, tables, RAW_ROUTE, fixture.MAIN)
    return kept.select("kafka_partition", "kafka_offset", "event_date")


@query
def retained_minutes_stored(spark, sf_dir):
    """Minutes merged from the stored states that have not expired."""
    tables = _stored_in_parts(spark, sf_dir)
    return rollup.minute_aggregates(lifecycle.read_retained(spark, tables, stored.MINUTE, fixture.MAIN))


@query
def schema_check(spark, sf_dir):
    """The four tables by name, after an ingest: there or not, and their rows.

    They are made in a database of their own, so none of the session's is touched.
    """
    tables = _stored_in_parts(spark, sf_dir)
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(_own_database(spark, session.run_folder(spark, "named")))
    try:
        catalog.init_schema(spark, tables)
        catalog.verify_schema(spark)
        return catalog.schema_check(spark)
    finally:
        spark.catalog.setCurrentDatabase(before)


@query
def storage_order(spark, sf_dir):
    """Rows of the stored tables, and those not in the order their files are skipped by."""
    tables = _stored_in_parts(spark, sf_dir)
    found = None
    for table, keys in ((RAW_ROUTE, ["event_date", "page_id", "user_id"]), (stored.MINUTE, ["window_start", "page_id"])):
        files = spark.read.schema(stored.SCHEMAS[table]).parquet(tables.live(table))
        row = reports.out_of_order(files, table, keys)
        found = row if found is None else found.unionByName(row)
    return found


@query
def codec_counts(spark, sf_dir):
    """Valid and rejected messages as read back from tables of every codec."""
    folder = session.run_folder(spark, "codecs")
    messages, found = fixture.messages(spark, sf_dir), None
    for codec in stored.CODECS:
        tables = stored.Tables(f"{folder}/{codec}", codec)
        stored.create_directories(spark, tables)
        stored.ingest_batch(messages, 0, tables, fixture.MAIN)
        for table, rows in ((RAW_ROUTE, stored.read_raw(spark, tables)), (ERROR_ROUTE, stored.read_errors(spark, tables))):
            row = reports.row_count(rows, table).withColumn("codec", F.lit(codec))
            found = row if found is None else found.unionByName(row)
    return found


# Publishing


@query
def publish_shape(spark, sf_dir):
    """Every event as the topic sink receives it, keyed by page."""
    rows = publish.publish_rows(fixture.source_events(spark, sf_dir))
    headers = [
        F.element_at("headers", i + 1)["value"].cast("string").alias(f"header_{name}")
        for i, name in enumerate(publish.HEADERS)
    ]
    return rows.select("key", "value", "timestamp", *headers)


@query
def key_strategy_mix(spark, sf_dir):
    """Events and keyed messages by key strategy, with the source's own bucket."""
    strategy = publish.mixed_strategy(F.col("k"))
    source = fixture.source_events(spark, sf_dir)
    labeled = source.select(
        strategy.alias("strategy"), publish.message_key(strategy).alias("key")
    )
    return labeled.groupBy("strategy").agg(
        F.count(F.lit(1)).alias("events"),
        F.count("key").alias("keyed"),
        F.count_if(F.col("key").startswith("random_")).alias("random_keys"),
    )


# Streams


def _streamed(
    spark: SparkSession, sf_dir: str, slices: list[int], drop_replays: bool = False
) -> stored.Tables:
    """Tables filled by draining a topic of files over several micro-batches."""
    folder = session.run_folder(spark, "stream")
    count = fixture.write_topic_slices(spark, sf_dir, f"{folder}/topic", slices)
    messages = topic.stream_files(spark, f"{folder}/topic", max(1, -(-count // 4)))
    tables = stored.Tables(f"{folder}/tables")
    ingest.drain(messages, tables, f"{folder}/checkpoint", fixture.MAIN, drop_replays)
    return tables


IN_ORDER = [0, 1, 2, 3]
OLDEST_LAST = [2, 3, 1, 0]


@query
def stream_raw_events(spark, sf_dir):
    raw = stored.read_raw(spark, _streamed(spark, sf_dir, IN_ORDER))
    return raw.drop("batch_id")


@query
def stream_dead_letters(spark, sf_dir):
    errors = stored.read_errors(spark, _streamed(spark, sf_dir, IN_ORDER))
    return errors.drop("batch_id", "month")


@query
def stream_minute_aggregates(spark, sf_dir):
    states = stored.read_states(spark, _streamed(spark, sf_dir, IN_ORDER))
    return rollup.minute_aggregates(states)


@query
def stream_hourly_rollup(spark, sf_dir):
    states = stored.read_states(spark, _streamed(spark, sf_dir, IN_ORDER), stored.HOUR)
    return rollup.hourly_rollup(states)


@query
def stream_late_data(spark, sf_dir):
    """Minutes and all, although the oldest events arrive last."""
    states = stored.read_states(spark, _streamed(spark, sf_dir, OLDEST_LAST))
    return rollup.minute_aggregates(states)


def _replayed(spark: SparkSession, sf_dir: str, slices: list[int]) -> DataFrame:
    """Offsets of both tables, of a stream that reads messages again."""
    tables = _streamed(spark, sf_dir, slices, drop_replays=True)
    keys = "kafka_partition", "kafka_offset"
    return stored.read_raw(spark, tables).select(*keys).unionByName(stored.read_errors(spark, tables).select(*keys))


@query
def stream_dedup(spark, sf_dir):
    """A topic read twice, its replays left out against what is stored."""
    return _replayed(spark, sf_dir, IN_ORDER + IN_ORDER)


@query
def stream_dedup_late(spark, sf_dir):
    """The same with the oldest messages first seen last, which none may be lost of."""
    return _replayed(spark, sf_dir, OLDEST_LAST[:2] + OLDEST_LAST)


# Events sent again, and windows that a stream closes


@query
def stream_dedup_content(spark, sf_dir):
    """Raw events of a topic whose signups are sent again after all others, in a later batch."""
    folder = session.run_folder(spark, "stream")
    count = fixture.write_topic_slices(spark, sf_dir, f"{folder}/topic", IN_ORDER)
    fixture.write_resends(spark, sf_dir, f"{folder}/topic")
    messages = topic.stream_files(spark, f"{folder}/topic", max(1, -(-count // 4)))
    tables = stored.Tables(f"{folder}/tables")
    extras = stored.Extras(drop_resends=True)
    ingest.drain(messages, tables, f"{folder}/checkpoint", fixture.MAIN, extras=extras)
    return stored.read_raw(spark, tables).drop("batch_id", "month")


@query
def stream_progress(spark, sf_dir):
    """Statistics of every micro-batch, a row each: one batch per slice of the topic."""
    folder = session.run_folder(spark, "stream")
    count = fixture.write_topic_slices(spark, sf_dir, f"{folder}/topic", IN_ORDER)
    messages = topic.stream_files(spark, f"{folder}/topic", max(1, -(-count // 4)))
    tables = stored.Tables(f"{folder}/tables")
    extras = stored.Extras(statistics=True)
    ingest.drain(messages, tables, f"{folder}/checkpoint", fixture.MAIN, extras=extras)
    return stored.read_statistics(spark, tables)


def _closed(spark: SparkSession, sf_dir: str, windowed: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """What a stream of raw events has emitted when its topic is drained.

    The delay spans more than a slice of the topic, so no event is late.
    """
    folder = session.run_folder(spark, "windows")
    count = fixture.write_topic_slices(spark, sf_dir, f"{folder}/topic", IN_ORDER)
    messages = topic.stream_files(spark, f"{folder}/topic", max(1, -(-count // 4)))
    rows = windowed(events.raw_rows(events.gate(messages, fixture.MAIN)), fixture.DELAY)
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


@query
def stream_exact_users(spark, sf_dir):
    """Exact distinct users of closed minutes, by two stateful steps in one stream."""
    return _closed(spark, sf_dir, windows.exact_users)


@query
def stream_closed_minutes(spark, sf_dir):
    """Minute rows, each once its watermark has passed."""
    return _closed(spark, sf_dir, windows.closed_minutes)


@query
def stream_closed_hours(spark, sf_dir):
    """Hour rows cascaded from closed minutes."""
    return _closed(spark, sf_dir, windows.closed_hours)
