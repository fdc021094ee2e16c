"""Publishing events to a topic: keys, JSON values, headers, codecs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetide.functions import event_json

# Fixed values of the message headers.
HEADERS = {"source": "event-generator", "version": "1.0"}

# Codecs of the producer; anything else is sent uncompressed.
PRODUCER_CODECS = ("none", "snappy", "lz4", "gzip")

BY_PAGE = "by_page"
ROUND_ROBIN = "round_robin"
RANDOM = "random"

# Shares of the strategies in percent when mixed: 70 / 20 / 10.
BY_PAGE_BELOW = 70
ROUND_ROBIN_BELOW = 90


def event_bucket() -> Column:
    """A number from 0 to 99 that stays with the event when a task runs again."""
    return F.pmod(F.xxhash64("user_id", "event_ts", "page_id"), F.lit(100))


def mixed_strategy(bucket: Column) -> Column:
    """Key strategy by bucket: 70 % by page, 20 % round-robin, 10 % random."""
    return (
        F.when(bucket < BY_PAGE_BELOW, BY_PAGE)
        .when(bucket < ROUND_ROBIN_BELOW, ROUND_ROBIN)
        .otherwise(RANDOM)
    )


def message_key(strategy: Column) -> Column:
    """Key that makes the broker spread messages as the strategy says.

    A null key lets it choose; a random key is a hash of the event, so that a
    repeated task sends the same key.
    """
    random_key = F.concat(F.lit("random_"), F.hex(F.xxhash64("user_id", "event_ts", "page_id")))
    return F.when(strategy == BY_PAGE, F.col("page_id")).when(strategy == RANDOM, random_key)


def publish_rows(events: DataFrame, strategy: Column | None = None) -> DataFrame:
    """Events in the shape the Kafka sink writes, keyed by page by default."""
    strategy = F.lit(BY_PAGE) if strategy is None else strategy
    headers = F.array(
        *[
            F.struct(F.lit(name).alias("key"), F.lit(text).cast("binary").alias("value"))
            for name, text in HEADERS.items()
        ]
    )
    return events.select(
        message_key(strategy).alias("key"),
        event_json.encode().alias("value"),
        headers.alias("headers"),
        F.col("event_ts").alias("timestamp"),
    )


def sink_options(servers: str, topic: str, codec: str = "snappy") -> dict[str, str]:
    """Options of the Kafka sink."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "includeHeaders": "true",
        "kafka.acks": "all",
        "kafka.compression.type": codec if codec in PRODUCER_CODECS else "none",
    }


def write_topic(rows: DataFrame, options: dict[str, str]) -> None:
    rows.write.format("kafka").options(**options).save()


def stream_to_topic(rows: DataFrame, options: dict[str, str], checkpoint: str):
    return (
        rows.writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .start()
    )
