"""Stored tables: layout, commits, replay-safe writing, reading.

    <root>/log/route=raw/month=YYYYMM/batch_id=N/      raw events
    <root>/log/route=errors/month=YYYYMM/batch_id=N/   rejected messages
    <root>/minute/month=YYYYMM/batch_id=N/             minute states
    <root>/hour/month=YYYYMM/batch_id=N/               hour states
    <root>/<table>_compacted/batches=A-B/month=YYYYMM/ batches A to B, merged
    <root>/commits/N.json, <root>/commits/A-B.json     what finished batches hold
    <root>/owner.json                                  whose batch numbers these are

A batch owns its directories. Its commit record is written last and taken away
first when the batch runs again, and readers and compaction look at recorded
batches only, so a half-written batch is never seen and a message is in exactly
one of the two tables. A complete compacted directory stands for its range of
batches; readers skip what it replaces, whether or not that has been deleted yet.
Reads bounded by time list only the months they need.

One ingest at a time may write below a root, and a root belongs to the first that
did: batch numbers start over with a new checkpoint, so another one is refused.
A query that has been planned before a batch is written again, or longer before
``lifecycle.clean`` than its grace period, may find its files gone and must be
asked again.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetide import session
from pagetide.functions import times
from pagetide.operators import events, rollup, users
from pagetide.schema import BATCH_STATUS, ERROR_ROUTE, ERRORS, MINUTE_STATE, RAW, RAW_ROUTE
from pagetide.sources import content, files
from pagetide.sources.parts import Parts

# Names a user may ask for, and what Parquet calls them.
CODECS = {"none": "uncompressed", "snappy": "snappy", "lz4": "lz4_raw", "gzip": "gzip", "zstd": "zstd"}

# Columns with Bloom filters in the log's files, and values to a row group at most.
FILTERED = {"page_id": 20_000, "user_id": 200_000}

MINUTE = "minute"
HOUR = "hour"
SCHEMAS = {RAW_ROUTE: RAW, ERROR_ROUTE: ERRORS, MINUTE: MINUTE_STATE, HOUR: MINUTE_STATE}

# Who owns a root that is filled without a stream.
BATCH_OWNER = "batch"

_MONTH = T.StructField("month", T.IntegerType())
_BATCH = T.StructField("batch_id", T.LongType())


@dataclass(frozen=True)
class Tables:
    """Where the tables live and how their files are compressed."""

    root: str
    codec: str = "zstd"

    def __post_init__(self) -> None:
        if self.codec not in CODECS:
            raise ValueError(f"unknown codec {self.codec!r}, use one of {sorted(CODECS)}")

    def live(self, table: str) -> str:
        """Directory of the batches of ``raw``, ``errors``, ``minute`` or ``hour``."""
        return f"{self.root}/log/route={table}" if table in (RAW_ROUTE, ERROR_ROUTE) else f"{self.root}/{table}"

    def compacted(self, table: str) -> str:
        return f"{self.root}/{table}_compacted"

    @property
    def commits(self) -> str:
        return f"{self.root}/commits"

    def writer_options(self) -> dict[str, str]:
        return {
            "compression": CODECS[self.codec],
            "partitionOverwriteMode": "static",
            "mapreduce.fileoutputcommitter.marksuccessfuljobs": "true",
        }

    def log_options(self) -> dict[str, str]:
        """Those of the log, with filters per row group for looking up a page or a user."""
        options = self.writer_options()
        for column, distinct in FILTERED.items():
            options[f"parquet.bloom.filter.enabled#{column}"] = "true"
            options[f"parquet.bloom.filter.expected.ndv#{column}"] = str(distinct)
        return options


@dataclass(frozen=True)
class Extras:
    """What an ingest does besides the four tables.

    ``drop_resends`` leaves out valid events whose content this or an earlier batch has
    stored within the days that the gate lets in. ``exact_users`` keeps bitmaps of users,
    ``statistics`` a row of counts per batch. They must be on from the first batch on to
    cover all.
    """

    drop_resends: bool = False
    exact_users: bool = False
    statistics: bool = False


def create_directories(spark: SparkSession, tables: Tables) -> None:
    for path in (*map(tables.live, SCHEMAS), tables.commits):
        files.make_directory(spark, path)


# Owners and commits


def owner(spark: SparkSession, tables: Tables) -> str | None:
    text = files.read_text(spark, f"{tables.root}/owner.json")
    return json.loads(text)["owner"] if text else None


def claim(spark: SparkSession, tables: Tables, name: str) -> None:
    """Take the root, or raise if another has it."""
    found = owner(spark, tables)
    if found is None:
        files.write_text(spark, f"{tables.root}/owner.json", json.dumps({"owner": name}))
    elif found != name:
        raise ValueError(f"{tables.root} is filled by {found}, whose batch numbers {name} would replace")


def commits(spark: SparkSession, tables: Tables) -> list[dict]:
    """Records of finished batches, ascending: ``first`` and ``last`` batch, and
    ``offsets``, the first and last offset of every topic partition.

    Older records have been folded together, so their number stays bounded.
    """
    found = [json.loads(files.read_text(spark, p)) for p in files.matching(spark, f"{tables.commits}/*.json")]
    found.sort(key=lambda r: (r["first"], -r["last"]))
    kept: list[dict] = []
    for record in found:
        if not kept or record["last"] > kept[-1]["last"]:
            kept.append(record)
    return kept


def _commit_path(tables: Tables, first: int, last: int) -> str:
    return f"{tables.commits}/{first if first == last else f'{first}-{last}'}.json"


def committed_ranges(spark: SparkSession, tables: Tables) -> list[tuple[int, int]]:
    """Finished batches as ranges without gaps, from the records' names alone."""
    ranges: list[tuple[int, int]] = []
    for path in files.matching(spark, f"{tables.commits}/*.json"):
        first, _, last = path.rsplit("/", 1)[1].removesuffix(".json").partition("-")
        ranges.append((int(first), int(last or first)))
    return _adjoined(ranges)


def _adjoined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of batches with those that touch as one."""
    merged: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if merged and first <= merged[-1][1] + 1:
            merged[-1] = merged[-1][0], max(last, merged[-1][1])
        else:
            merged.append((first, last))
    return merged


def commit(spark: SparkSession, tables: Tables, batch_id: int) -> None:
    """Record a batch as finished, with the offsets it holds."""
    places = None
    for route in (RAW_ROUTE, ERROR_ROUTE):
        rows = _read_batch(spark, tables, route, batch_id).select("kafka_partition", "kafka_offset")
        places = rows if places is None else places.unionByName(rows)
    ends = places.groupBy("kafka_partition").agg(F.min("kafka_offset"), F.max("kafka_offset"))
    offsets = {str(partition): [low, high] for partition, low, high in ends.collect()}  # a row per topic partition
    record = {"first": batch_id, "last": batch_id, "offsets": offsets}
    files.write_text(spark, _commit_path(tables, batch_id, batch_id), json.dumps(record))


def fold_commits(spark: SparkSession, tables: Tables, last: int) -> None:
    """One record for all finished batches up to ``last``, in place of theirs."""
    records = [r for r in commits(spark, tables) if r["last"] <= last]
    if len(records) < 2:
        return
    first, last = records[0]["first"], records[-1]["last"]
    if any(a["last"] + 1 != b["first"] for a, b in zip(records, records[1:])):
        raise ValueError(f"batches {first} to {last} are not all finished")
    offsets: dict[str, list[int]] = {}
    for record in records:
        for partition, (low, high) in record["offsets"].items():
            known = offsets.get(partition, [low, high])
            offsets[partition] = [min(low, known[0]), max(high, known[1])]
    folded = {"first": first, "last": last, "offsets": offsets}
    files.write_text(spark, _commit_path(tables, first, last), json.dumps(folded))
    for record in records:
        files.delete(spark, _commit_path(tables, record["first"], record["last"]))


# Writing


def _delete_batch(spark: SparkSession, tables: Tables, table: str, batch_id: int) -> None:
    for path in files.matching(spark, f"{tables.live(table)}/month=*/batch_id={batch_id}"):
        files.delete(spark, path)


def write_log(
    routed: DataFrame, tables: Tables, batch_id: int, rebalance: bool = False
) -> None:
    """Store valid events and rejected messages of one batch, in one pass.

    The batch counts as unfinished from here until ``commit``. Rows are sorted
    within each task, so that row-group statistics can skip. With ``rebalance``
    the rows are first gathered by table and month into files of the advisory
    partition size, splitting large and merging small ones: worth a shuffle where
    many source partitions each hold little. Adaptive execution does the
    splitting, so without it rows stay where they are.
    """
    spark = session.configure(routed.sparkSession)
    if any(first <= batch_id <= last for t in SCHEMAS for first, last in compacted_ranges(spark, tables, t)):
        raise ValueError(f"batch {batch_id} has been compacted and cannot be written again")
    if rebalance and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        routed = routed.hint("rebalance", "route", "month")
    files.delete(spark, _commit_path(tables, batch_id, batch_id))
    for table in SCHEMAS:
        _delete_batch(spark, tables, table, batch_id)
    (
        routed.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .sortWithinPartitions("route", "month", "batch_id", "event_date", "page_id", "user_id")
        .write.mode("append")
        .options(**tables.log_options())
        .partitionBy("route", "month", "batch_id")
        .parquet(f"{tables.root}/log")
    )


def _write_states(states: DataFrame, tables: Tables, table: str, batch_id: int) -> None:
    (
        _with_month(states)
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("append")
        .options(**tables.writer_options())
        .partitionBy("month", "batch_id")
        .parquet(tables.live(table))
    )


def _with_month(states: DataFrame) -> DataFrame:
    session.configure(states.sparkSession)
    dated = states.select(*MINUTE_STATE.fieldNames()).withColumn("month", times.month(F.col("window_start")))
    return dated.sortWithinPartitions("month", "window_start", "page_id")


def write_batch_states(spark: SparkSession, tables: Tables, batch_id: int) -> None:
    """Minute states from the batch's stored raw events, hour states from those."""
    for table in (MINUTE, HOUR):
        _delete_batch(spark, tables, table, batch_id)
    raw = _read_batch(spark, tables, RAW_ROUTE, batch_id)
    _write_states(rollup.minute_states(raw), tables, MINUTE, batch_id)
    minutes = _read_batch(spark, tables, MINUTE, batch_id)
    _write_states(rollup.hour_states(minutes), tables, HOUR, batch_id)


def write_compacted(rows: DataFrame, tables: Tables, table: str, first: int, last: int) -> None:
    """One directory that stands for batches ``first`` to ``last``."""
    session.configure(rows.sparkSession)
    options = tables.log_options()
    if table in (MINUTE, HOUR):
        rows, options = _with_month(rows), tables.writer_options()
    rows.write.mode("overwrite").options(**options).partitionBy("month").parquet(
        f"{tables.compacted(table)}/batches={first}-{last}"
    )


def ingest_batch(
    messages: DataFrame,
    batch_id: int,
    tables: Tables,
    as_of: times.Clock = None,
    rebalance: bool = False,
    owned_by: str = BATCH_OWNER,
    drop_replays: bool = False,
    extras: Extras = Extras(),
) -> None:
    """Gate one batch of messages and bring all tables up to date with it.

    Running a batch again replaces what it wrote before. A backfill whose
    splits are large needs no ``rebalance``. ``drop_replays`` leaves out messages
    that another batch has stored.
    """
    routed = events.routed_rows(events.gate(messages, as_of))
    store_batch(routed, batch_id, tables, owned_by, rebalance, drop_replays, extras)


def store_batch(
    routed: DataFrame,
    batch_id: int,
    tables: Tables,
    owned_by: str,
    rebalance: bool,
    drop_replays: bool = False,
    extras: Extras = Extras(),
) -> None:
    """Store rows of both tables with their states, and record the batch last."""
    spark = session.configure(routed.sparkSession)
    claim(spark, tables, owned_by)
    asked = drop_replays or extras.drop_resends  # for offsets or days, before it is written
    if asked:  # so that messages are decoded once
        routed = routed.persist(StorageLevel.DISK_ONLY)
    try:
        kept = without_replays(routed, tables, batch_id) if drop_replays else routed
        if extras.drop_resends:
            kept = content.without_resends(kept, tables.root, batch_id)
        seen = Observation()
        if extras.statistics:
            kept = kept.observe(seen, *_batch_status())
        write_log(kept, tables, batch_id, rebalance)
    finally:
        if asked:
            routed.unpersist()
    write_batch_states(spark, tables, batch_id)
    raw = _read_batch(spark, tables, RAW_ROUTE, batch_id)
    if extras.drop_resends:
        content.write_batch_keys(raw, tables.root, batch_id)
    if extras.exact_users:
        users.write_batch_users(raw, tables.root, batch_id)
    if extras.statistics:
        row = spark.createDataFrame([tuple(seen.get[name] for name in BATCH_STATUS.fieldNames())], BATCH_STATUS)
        batch_statistics(tables).write(row, batch_id, rebalance=False)
    commit(spark, tables, batch_id)


def _batch_status() -> list[Column]:
    valid = F.col("route") == RAW_ROUTE
    return [
        F.count(F.lit(1)).alias("messages_processed"),
        F.count_if(valid).alias("valid_messages"),
        F.count_if(~valid).alias("invalid_messages"),
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("last_event_time"),
        F.max(F.coalesce("processed_time", "error_time")).alias("last_insert_time"),
    ]


def batch_statistics(tables: Tables) -> Parts:
    """Counts and times of every batch, a row each, taken while it was written."""
    return Parts(f"{tables.root}/batch_statistics", BATCH_STATUS)


def read_statistics(spark: SparkSession, tables: Tables) -> DataFrame:
    """Statistics of finished batches, where these were stored with them."""
    done = committed_ranges(spark, tables)
    return batch_statistics(tables).read(spark).filter(_in_ranges(done))


def read_user_states(spark: SparkSession, tables: Tables) -> DataFrame:
    """Bitmaps of users of finished batches, where these were stored with them."""
    return users.read_user_states(spark, tables.root).filter(_in_ranges(committed_ranges(spark, tables)))


def without_replays(routed: DataFrame, tables: Tables, batch_id: int) -> DataFrame:
    """Rows whose topic partition and offset occur once here and in no other batch.

    The records of finished batches tell which of them hold offsets in question;
    only their two key columns are read, neighbouring batches at once, and nothing
    where no range overlaps. All of them are compared in one join.
    """
    spark = routed.sparkSession
    keys = ["kafka_partition", "kafka_offset"]
    once_each = routed.dropDuplicates(keys)
    ends = routed.groupBy("kafka_partition").agg(F.min("kafka_offset"), F.max("kafka_offset")).collect()
    overlapping = [
        record
        for record in commits(spark, tables)
        if not record["first"] <= batch_id <= record["last"]
        and any(
            low <= record["offsets"][str(p)][1] and high >= record["offsets"][str(p)][0]
            for p, low, high in ends
            if str(p) in record["offsets"]
        )
    ]
    seen = None
    for first, last in _adjoined([(record["first"], record["last"]) for record in overlapping]):
        for route in (RAW_ROUTE, ERROR_ROUTE):
            places = read(spark, tables, route, whole_range=(first, last)).filter(F.col("batch_id") != batch_id)
            places = places.select(*keys)
            seen = places if seen is None else seen.unionByName(places)
    return once_each if seen is None else once_each.join(seen, keys, "left_anti")


# Reading


def compacted_ranges(spark: SparkSession, tables: Tables, table: str) -> list[tuple[int, int]]:
    """Batch ranges that complete compacted directories stand for, ascending.

    A range inside a wider one has been compacted further and is left out.
    """
    done = files.matching(spark, f"{tables.compacted(table)}/batches=*/_SUCCESS")
    ranges = []
    for path in done:
        first, last = files.partition_value(path.rsplit("/", 1)[0]).split("-")
        ranges.append((int(first), int(last)))
    return sorted(
        r
        for r in ranges
        if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in ranges)
    )


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _months(spark: SparkSession, pattern: str, since: date | None) -> list[str]:
    """Month directories matching the pattern, from the month of ``since`` on."""
    least = 0 if since is None else since.year * 100 + since.month
    return [p for p in files.matching(spark, pattern) if int(files.partition_value(p)) >= least]


def _read_batch(spark: SparkSession, tables: Tables, table: str, batch_id: int) -> DataFrame:
    """One batch of a table, finished or not, listing its own directories only."""
    paths = files.matching(spark, f"{tables.live(table)}/month=*/batch_id={batch_id}")
    if not paths:
        return _empty(spark, SCHEMAS[table])
    reader = spark.read.schema(SCHEMAS[table]).option("basePath", tables.live(table))
    return reader.parquet(*paths)


def _in_ranges(ranges: list[tuple[int, int]]) -> Column:
    inside = F.lit(False)
    for first, last in ranges:
        inside = inside | F.col("batch_id").between(first, last)
    return inside


def read(
    spark: SparkSession,
    tables: Tables,
    table: str,
    first: int = 0,
    last: int | None = None,
    since: date | None = None,
    whole_range: tuple[int, int] | None = None,
) -> DataFrame:
    """Rows of finished batches, with their ``month`` and ``batch_id``.

    Compacted rows carry the last batch of their range. ``first`` and ``last`` bound
    the batches and may not cut through a compacted range; ``whole_range`` asks for
    all ranges that touch it instead. With ``since`` only directories of its month
    and later ones are listed and read.
    """
    ranges = compacted_ranges(spark, tables, table)
    after = max((r[1] for r in ranges), default=-1)
    if whole_range is not None:
        first, last = whole_range
    wanted = [r for r in ranges if r[1] >= first and (last is None or r[0] <= last)]
    if whole_range is None and any(r[0] < first or (last is not None and r[1] > last) for r in wanted):
        raise ValueError(f"batches {first} to {last} cut through compacted ranges {wanted}")
    schema = T.StructType([*SCHEMAS[table].fields, _MONTH, _BATCH])
    out = _empty(spark, schema)
    live = _months(spark, f"{tables.live(table)}/month=*", since)
    done = [
        (max(a, first, after + 1), b if last is None else min(b, last))
        for a, b in committed_ranges(spark, tables)
    ]
    if live and (done := [(a, b) for a, b in done if a <= b]):
        rows = spark.read.schema(schema).option("basePath", tables.live(table)).parquet(*live)
        out = rows.filter(_in_ranges(done))
    merged = T.StructType([*SCHEMAS[table].fields, _MONTH])
    for a, b in wanted:
        base = f"{tables.compacted(table)}/batches={a}-{b}"
        if paths := _months(spark, f"{base}/month=*", since):
            rows = spark.read.schema(merged).option("basePath", base).parquet(*paths)
            out = out.unionByName(rows.withColumn("batch_id", F.lit(b).cast("bigint")))
    return out


def read_raw(spark: SparkSession, tables: Tables, since: date | None = None) -> DataFrame:
    """Raw events of finished batches, with ``month`` and ``batch_id``."""
    return read(spark, tables, RAW_ROUTE, since=since)


def read_errors(spark: SparkSession, tables: Tables, since: date | None = None) -> DataFrame:
    """Rejected messages of finished batches, with ``month`` and ``batch_id``."""
    return read(spark, tables, ERROR_ROUTE, since=since)


def read_states(
    spark: SparkSession,
    tables: Tables,
    grain: str = MINUTE,
    first: int = 0,
    last: int | None = None,
    since: date | None = None,
) -> DataFrame:
    """State rows of all finished batches, or of some, with ``month``."""
    return read(spark, tables, grain, first, last, since).drop("batch_id")
