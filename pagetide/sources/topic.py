"""Reading messages from a Kafka topic or from files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide.schema import MESSAGE

STARTS = ("earliest", "latest")


def topic_options(
    servers: str,
    topic: str,
    start: str = "earliest",
    max_rows_per_batch: int | None = 50_000_000,
    max_rows_per_task: int = 500_000,
    fetch_min_bytes: int | None = None,
    fetch_max_bytes: int | None = None,
    **flush: str,
) -> dict[str, str]:
    """Options of the Kafka source; ``flush`` takes those of ``flush_rule``.

    ``start`` applies to the first run only; later runs go on from the
    checkpoint. A batch takes at most ``max_rows_per_batch``, so that a first run
    from the earliest offset is not one batch of the whole topic. A topic partition that holds more than ``max_rows_per_task`` is
    read by several tasks, so one busy partition does not hold up the batch.
    """
    if start not in STARTS:
        raise ValueError(f"start must be one of {STARTS}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "maxRecordsPerPartition": str(max_rows_per_task),
    }
    if max_rows_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_rows_per_batch)
    if fetch_min_bytes is not None:
        options["kafka.fetch.min.bytes"] = str(fetch_min_bytes)
    if fetch_max_bytes is not None:
        options["kafka.fetch.max.bytes"] = str(fetch_max_bytes)
    return options | flush


def envelope(records: DataFrame) -> DataFrame:
    """The part of broker records the pipeline works on."""
    return records.select(*[F.col(name) for name in MESSAGE.fieldNames()])


def stream_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return envelope(spark.readStream.format("kafka").options(**options).load())


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """What the topic holds now, for backfills and reports."""
    batch = {k: v for k, v in options.items() if not k.endswith(("PerTrigger", "TriggerDelay"))}
    if batch.get("startingOffsets") == "latest":
        raise ValueError("a batch read cannot start at the latest offsets")
    return envelope(spark.read.format("kafka").options(**batch).load())


def stream_files(
    spark: SparkSession, path: str, max_files_per_batch: int | None = None
) -> DataFrame:
    """Messages from Parquet files, oldest file first."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE).parquet(path)
