"""Counters, health, mixes, histograms and offsets.

Every report is one pass with map-side partial aggregation; what is shuffled is
bounded by the number of partitions, rules, classes or buckets, never by rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetide.functions import quality, times

MAX_INVALID_RATE = 0.5
MAX_SOURCE_ERRORS = 100
MIN_DELIVERY_RATE = 0.95
MIN_DELIVERIES = 100


def next_offsets(messages: DataFrame) -> DataFrame:
    """Where to continue in each topic partition."""
    return messages.groupBy(F.col("partition").alias("kafka_partition")).agg(
        (F.max("offset") + 1).alias("next_offset")
    )


def partition_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy(F.col("partition").alias("kafka_partition")).agg(
        F.count(F.lit(1)).alias("messages")
    )


def consumer_lag(messages: DataFrame, consumed: Column) -> DataFrame:
    """Per partition, how far the consumed messages trail the end of the topic."""
    ends = messages.groupBy(F.col("partition").alias("kafka_partition")).agg(
        (F.max("offset") + 1).alias("end_offset"),
        F.coalesce(F.max(F.when(consumed, F.col("offset"))) + 1, F.min("offset")).alias(
            "next_offset"
        ),
    )
    return ends.withColumn("lag", F.col("end_offset") - F.col("next_offset"))


def ingest_counts() -> list[Column]:
    """Counters over gated messages, for an aggregate or a stream observation."""
    valid = F.col("is_valid")
    return [
        F.count(F.lit(1)).alias("messages_processed"),
        F.count_if(valid).alias("valid_messages"),
        F.count_if(~valid).alias("invalid_messages"),
        F.max("timestamp").alias("last_consume_time"),
    ]


def ingest_status(gated: DataFrame) -> DataFrame:
    return gated.agg(
        *ingest_counts(), F.max(F.date_trunc("second", "clock")).alias("last_insert_time")
    )


def _percent(rate: Column, text: str) -> Column:
    return F.format_string(f"{text}: %.2f%%", rate * 100)


def _verdict(counts: DataFrame, issues: list[Column]) -> DataFrame:
    joined = F.concat_ws("; ", *issues)
    return counts.withColumn("issues", joined).withColumn(
        "status", F.when(F.col("issues") == "", "healthy").otherwise("unhealthy")
    )


def health(gated: DataFrame, source_errors: int = 0) -> DataFrame:
    """Unhealthy above half invalid messages or a hundred source errors.

    Nothing processed counts as healthy.
    """
    counts = gated.agg(
        F.count(F.lit(1)).alias("messages_processed"),
        F.count_if(~F.col("is_valid")).alias("invalid_messages"),
    )
    rate = F.try_divide(F.col("invalid_messages"), F.col("messages_processed"))
    issues = [
        F.when(F.lit(source_errors > MAX_SOURCE_ERRORS), F.lit("High Kafka error count")),
        F.when(rate > MAX_INVALID_RATE, _percent(rate, "High invalid message rate")),
    ]
    return _verdict(counts.withColumn("invalid_rate", F.coalesce(rate, F.lit(0.0))), issues)


def delivery_health(sent: DataFrame, delivered: Column) -> DataFrame:
    """Unhealthy below 95 % delivered, once more than a hundred were sent."""
    counts = sent.agg(
        F.count(F.lit(1)).alias("sent_total"), F.count_if(delivered).alias("sent_success")
    )
    rate = F.try_divide(F.col("sent_success"), F.col("sent_total"))
    low = (F.col("sent_total") > MIN_DELIVERIES) & (rate < MIN_DELIVERY_RATE)
    counts = counts.withColumn("success_rate", F.coalesce(rate, F.lit(0.0)))
    return _verdict(counts, [F.when(low, _percent(rate, "Low success rate"))])


_CLASSES = ["normal", "bounce", "error"]
_PERIODS = ["day", "night"]


def _mix(gated: DataFrame, labels: dict[str, tuple[Column, list[str]]]) -> DataFrame:
    """Count and share of each combination of labels that occurs.

    The total rides along in the same aggregate, so no second pass or window
    over all rows is needed.
    """
    combinations: list[list[str]] = [[]]
    for _, values in labels.values():
        combinations = [c + [v] for c in combinations for v in values]
    named = gated.select(*[column.alias(name) for name, (column, _) in labels.items()])
    counters = []
    for i, combination in enumerate(combinations):
        match = F.lit(True)
        for name, value in zip(labels, combination):
            match = match & (F.col(name) == value)
        counters.append(F.count_if(match).alias(f"n{i}"))
    totals = named.agg(F.count(F.lit(1)).alias("total"), *counters)
    rows = [
        F.struct(
            *[F.lit(value).alias(name) for name, value in zip(labels, combination)],
            F.col(f"n{i}").alias("events"),
            (F.col(f"n{i}") / F.col("total")).alias("share"),
        )
        for i, combination in enumerate(combinations)
    ]
    return (
        totals.filter("total > 0").select(F.inline(F.array(*rows))).filter("events > 0")
    )


def event_mix(gated: DataFrame) -> DataFrame:
    """Events by class: normal, bounce, error."""
    return _mix(gated, {"event_class": (quality.event_class(), _CLASSES)})


def event_mix_by_period(gated: DataFrame) -> DataFrame:
    """Events by class and by night or day of their arrival."""
    return _mix(
        gated,
        {
            "period": (times.traffic_period(F.col("timestamp")), _PERIODS),
            "event_class": (quality.event_class(), _CLASSES),
        },
    )


def failures_by_rule(gated: DataFrame) -> DataFrame:
    """How often each rule failed; an event counts for every rule it fails."""
    failed = gated.filter("NOT is_valid").select(F.explode(quality.errors()).alias("error"))
    return failed.groupBy(
        F.col("error.field").alias("field"), F.col("error.message").alias("message")
    ).agg(F.count(F.lit(1)).alias("failures"))


def histogram(df: DataFrame, value: Column, edges: Sequence[float]) -> DataFrame:
    """Cumulative counts ``value <= le`` per edge; the last bucket has no edge."""
    counted = df.select(value.alias("v")).agg(
        *[F.count_if(F.col("v") <= edge).alias(f"b{i}") for i, edge in enumerate(edges)],
        F.count("v").alias(f"b{len(edges)}"),
    )
    bounds = [F.lit(float(edge)) for edge in edges] + [F.lit(None).cast("double")]
    rows = [
        F.struct(F.lit(i).alias("bucket"), le.alias("le"), F.col(f"b{i}").alias("cumulative_count"))
        for i, le in enumerate(bounds)
    ]
    return counted.select(F.inline(F.array(*rows)))


def histogram_states(
    df: DataFrame, value: Column, edges: Sequence[float], window: Column
) -> DataFrame:
    """Rows per window and bucket of fixed edges, as states that add up.

    Position i counts ``edges[i - 1] < value <= edges[i]``, the last one what is above
    all edges. States of one list of edges merge in any order and grouping.
    """
    bucket = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        bucket = F.when(F.col("v") <= edges[i], i).otherwise(bucket)
    named = df.select(window.alias("window_start"), value.alias("v")).filter("v IS NOT NULL")
    placed = named.select("window_start", bucket.alias("b"))
    counts = [F.count_if(F.col("b") == i) for i in range(len(edges) + 1)]
    return placed.groupBy("window_start").agg(F.array(*counts).alias("counts"))


def merge_histograms(states: DataFrame, buckets: int, window: Column | None = None) -> DataFrame:
    """States added up position by position, per ``window`` or in all."""
    sums = F.array(*[F.coalesce(F.sum(F.get("counts", F.lit(i))), F.lit(0)) for i in range(buckets)])
    grouped = states.groupBy() if window is None else states.groupBy(window.alias("window_start"))
    return grouped.agg(sums.alias("counts"))


def cumulated(merged: DataFrame, edges: Sequence[float]) -> DataFrame:
    """Merged states as rows ``value <= le``, as :func:`histogram` gives them."""
    rows = []
    for i, le in enumerate([*edges, None]):
        below = F.aggregate(F.slice("counts", 1, i + 1), F.lit(0).cast("bigint"), lambda a, n: a + n)
        bound = F.lit(None if le is None else float(le)).cast("double")
        rows.append(F.struct(F.lit(i).alias("bucket"), bound.alias("le"), below.alias("cumulative_count")))
    others = [name for name in merged.columns if name != "counts"]
    return merged.select(*others, F.inline(F.array(*rows)))


# Offsets of a partition that are sorted together.
OFFSETS_PER_CHUNK = 1_000_000


def offset_gaps(messages: DataFrame, chunk: int = OFFSETS_PER_CHUNK) -> DataFrame:
    """Ranges of offsets that are missing between others of their topic partition.

    Offsets are compared within chunks of a partition, and chunks by their ends, a row
    each, so a partition with most messages is sorted in many tasks. Repeated offsets
    count once.
    """
    places = messages.select(
        F.col("partition").alias("kafka_partition"), "offset", F.floor(F.col("offset") / chunk).alias("chunk")
    )
    inside = Window.partitionBy("kafka_partition", "chunk").orderBy("offset")
    within = places.select("kafka_partition", F.lag("offset").over(inside).alias("before"), "offset")
    ends = places.groupBy("kafka_partition", "chunk").agg(F.min("offset").alias("offset"), F.max("offset").alias("last"))
    along = Window.partitionBy("kafka_partition").orderBy("chunk")
    between = ends.select("kafka_partition", F.lag("last").over(along).alias("before"), "offset")
    gaps = within.unionByName(between).filter("offset > before + 1")
    return gaps.selectExpr(
        "kafka_partition", "before + 1 AS first_missing", "offset - 1 AS last_missing", "offset - before - 1 AS missing"
    )


def duration_seconds() -> Column:
    return F.col("duration_ms") / 1000.0


def ingest_lag_seconds() -> Column:
    """Seconds from the event to its processing."""
    return (
        F.unix_micros("processed_time") - F.unix_micros("event_time")
    ) / 1000000.0


def writer_status(raw: DataFrame, errors: DataFrame) -> DataFrame:
    """What has been stored: rows by table, batches, and when last."""
    both = raw.select("batch_id", F.lit(1).alias("raw"), F.col("processed_time").alias("at"))
    both = both.unionByName(
        errors.select("batch_id", F.lit(0).alias("raw"), F.col("error_time").alias("at"))
    )
    return both.agg(
        F.count_if(F.col("raw") == 1).alias("raw_inserted"),
        F.count_if(F.col("raw") == 0).alias("errors_inserted"),
        F.count_distinct("batch_id").alias("flush_count"),
        F.max("at").alias("last_insert_time"),
    )


def out_of_order(files: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows of a table's files, and those that stand after a row of greater keys in their file.

    ``files`` is read from files directly, which are compared one by one.
    """
    along = Window.partitionBy("file").orderBy("row")
    placed = files.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        F.struct(*keys).alias("key"),
    ).withColumn("before", F.lag("key").over(along))
    return placed.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("before") > F.col("key")).alias("out_of_order")).select(
        F.lit(table).alias("table_name"), "row_count", "out_of_order"
    )


def row_count(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"), "row_count"
    )
