"""Broker messages derived from the ``events`` table, as FIXTURES.md lays down."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide.functions import event_json
from pagetide.schema import MESSAGE

TOPIC = "page-views"
REGIONS = ["EU", "US", "ASIA", "SA", "AF", "AU"]
USER_AGENT = "Mozilla/5.0 (X11; Linux x86_64)"

# Clocks: no time failures; many events in the future; many events too old.
MAIN = "2024-01-31 00:00:00"
EARLY = "2024-01-15 00:00:00"
LATE = "2024-02-15 00:00:00"

# Resent events get offsets from here on.
RESEND_OFFSET = 1_000_000_000_000

# Purchases that break a rule or spell a key twice, by their number k: no user, over
# a day, no time, both ids empty and no duration, an empty page and a number for a
# page under another spelling of its key, a number for a page before its right value.
ODD = {11: "no_user", 22: "too_long", 33: "no_time", 44: "blank", 55: "twice", 66: "typed", 77: "before"}
TOO_LONG = 24 * 60 * 60 * 1000 + 1
AGAIN = {"twice": ',"Page_ID":""}', "typed": ',"Page_ID":7}'}
BEFORE = '{"page_id":7,'

# Days at which the topic is cut into files for the streams.
CUTS = ["2024-01-08", "2024-01-16", "2024-01-24"]

# How long the streams with watermarks wait for late events: more than a slice.
DELAY_DAYS = 10
DELAY = f"{DELAY_DAYS} days"

# Source rows to a file of the topic, so that batches are read by many tasks.
FILE_ROWS = 50_000


def source_events(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None, tasks: int = 1
) -> DataFrame:
    """Event fields by source row, before anything is broken on purpose.

    ``start`` and ``end`` bound the event time in the scan itself. With more ``tasks``
    than one, rows are dealt to so many, whatever the files' sizes.
    """
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    if start is not None:
        from_start = F.col("ts") >= F.lit(start).cast("timestamp_ntz")
        # rows without a time belong to the last slice
        rows = rows.filter(from_start | F.col("ts").isNull() if end is None else from_start)
    if end is not None:
        rows = rows.filter(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    if tasks > 1:
        rows = rows.repartition(tasks)
    rows = rows.selectExpr(
        "event_id",
        "CAST(ts AS TIMESTAMP) AS arrived",
        "user_id AS uid",
        "event_type",
        "CAST(round(value * 1000) AS BIGINT) AS ms",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
    )
    kind = "CASE WHEN event_type = 'error' THEN k % 3 ELSE -1 END"
    odd = " ".join(f"WHEN {k} THEN '{name}'" for k, name in ODD.items())
    regions = ", ".join(f"'{region}'" for region in REGIONS)
    # Clients of one event type call everything below six seconds a bounce.
    return rows.selectExpr(
        "*", f"{kind} AS kind", f"CASE WHEN event_type = 'purchase' THEN CASE k {odd} END END AS odd"
    ).selectExpr(
        "event_id",
        "event_type",
        "arrived",
        "CASE WHEN odd = 'no_time' THEN NULL ELSE arrived END AS event_ts",
        "k",
        "kind",
        "odd",
        "CASE WHEN kind = 0 OR odd <=> 'blank' THEN '' ELSE concat('page_', k % 10) END AS page_id",
        "CASE WHEN odd IN ('no_user', 'blank') THEN '' ELSE concat('user_', uid) END AS user_id",
        f"""CASE WHEN kind = 1 THEN -ms WHEN odd = 'blank' THEN 0
            WHEN odd = 'too_long' THEN ms + {TOO_LONG} ELSE ms END AS view_duration_ms""",
        f"CASE WHEN k % 7 = 0 THEN '' ELSE '{USER_AGENT}' END AS user_agent",
        """CASE WHEN k = 99 THEN 'not-an-ip'
            WHEN k % 5 = 0
            THEN concat('2001:0DB8:0000:0000:0000:0000:0000:', lpad(hex(k + 1), 4, '0'))
            ELSE concat('10.0.', uid % 256, '.', k) END AS ip_address""",
        f"element_at(array({regions}), CAST(uid % 6 + 1 AS INT)) AS region",
        "ms < CASE WHEN event_type = 'signup' THEN 6000 ELSE 5000 END AS is_bounce",
    )


BROKEN_JSON = """concat('{"page_id":"', page_id, '","user_id":"', user_id,
    '","view_duration_ms":', view_duration_ms, ',"timestamp":INVALID')"""


def messages_of(source: DataFrame, offset: str = "event_id") -> DataFrame:
    """Source rows as broker messages; every third error is broken JSON."""
    encoded = event_json.encode()
    value = F.when(F.col("kind") == 2, F.expr(BROKEN_JSON))
    for odd, tail in AGAIN.items():
        value = value.when(F.col("odd") == odd, F.concat(F.rtrim(encoded, F.lit("}")), F.lit(tail)))
    value = value.when(F.col("odd") == "before", F.concat(F.lit(BEFORE), F.ltrim(encoded, F.lit("{"))))
    return source.select(
        value.otherwise(encoded).alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.expr("k % 4").alias("partition"),
        F.expr(offset).alias("offset"),
        F.col("arrived").alias("timestamp"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of(source_events(spark, sf_dir))


def replayed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic read twice, as after a restart from the oldest offset."""
    once_read = messages(spark, sf_dir)
    return once_read.unionByName(once_read)


def resent_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic with every signup sent a second time, at a new offset."""
    source = source_events(spark, sf_dir)
    again = source.filter(F.col("event_type") == "signup")
    return messages_of(source).unionByName(
        messages_of(again, f"event_id + {RESEND_OFFSET}")
    )


def _files_to(spark: SparkSession, sf_dir: str, folders: int) -> int:
    """Files that each of so many parts of the topic is written to."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    return max(1, -(-rows // (folders * FILE_ROWS)))


def write_topic_slices(spark: SparkSession, sf_dir: str, path: str, slices: list[int]) -> int:
    """Write the messages in time slices, in the given order; returns the file count.

    Slices are written one after the other, so the order of their files'
    modification times is the order given. Together they cover all times.
    """
    bounds: list[str | None] = [None, *CUTS, None]
    tasks = _files_to(spark, sf_dir, len(bounds) - 1)
    for i in slices:
        part = messages_of(source_events(spark, sf_dir, bounds[i], bounds[i + 1], tasks))
        part.write.mode("append").parquet(path)
    return len(spark.read.schema(MESSAGE).parquet(path).inputFiles())


def write_resends(spark: SparkSession, sf_dir: str, path: str) -> int:
    """Add the signups sent again to a topic's files; returns the file count."""
    again = source_events(spark, sf_dir).filter(F.col("event_type") == "signup")
    messages_of(again, f"event_id + {RESEND_OFFSET}").write.mode("append").parquet(path)
    return len(spark.read.schema(MESSAGE).parquet(path).inputFiles())


def write_topic_partitions(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Write the messages by topic partition, so that one can be read alone."""
    source = source_events(spark, sf_dir, tasks=_files_to(spark, sf_dir, 4))
    messages_of(source).write.partitionBy("partition").parquet(path)
    return spark.read.schema(MESSAGE).parquet(path).select(*MESSAGE.fieldNames())
