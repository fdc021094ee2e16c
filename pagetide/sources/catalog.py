"""Tables and views by name: create, verify, drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetide.operators import rollup
from pagetide.schema import (
    ERROR_ROUTE,
    ERROR_TABLE,
    ERRORS,
    HOUR,
    HOUR_TABLE,
    MINUTE_STATE,
    MINUTE_TABLE,
    RAW,
    RAW_ROUTE,
    RAW_TABLE,
)
from pagetide.sources import files
from pagetide.sources import tables as stored

MINUTE_VIEW = "page_views_raw_to_minute"
HOUR_VIEW = "page_views_minute_to_hour"
HOUR_STATE_TABLE = "page_views_hour_states"

# External tables, by the stored table they show.
_EXTERNAL = {
    RAW_TABLE: RAW_ROUTE,
    ERROR_TABLE: ERROR_ROUTE,
    MINUTE_TABLE: stored.MINUTE,
    HOUR_STATE_TABLE: stored.HOUR,
}
_EXPECTED = {RAW_TABLE: RAW, ERROR_TABLE: ERRORS, MINUTE_TABLE: MINUTE_STATE, HOUR_TABLE: HOUR}


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _merged(unit: str, source: str) -> str:
    size = rollup.SKETCH_LOG_SIZE
    return f"""SELECT date_trunc('{unit}', window_start) AS window_start, page_id,
        sum(view_count_s) AS view_count, sum(total_duration_s) AS total_duration,
        theta_sketch_estimate(theta_union_agg(unique_users_s, {size})) AS unique_users,
        sum(bounce_count_s) AS bounce_count
        FROM {source} GROUP BY 1, 2"""


def _hours(source: str) -> str:
    return f"""SELECT window_start, page_id, view_count, total_duration / view_count AS avg_duration,
        unique_users, bounce_count * 100.0D / view_count AS bounce_rate
        FROM ({_merged('hour', source)})"""


def _partitions(spark: SparkSession, tables: stored.Tables, table: str) -> dict[tuple[int, int], str]:
    """Places of all finished data, by month and batch; a range goes by its last."""
    ranges = stored.compacted_ranges(spark, tables, table)
    after = max((r[1] for r in ranges), default=-1)
    found = {}
    done = stored.committed_ranges(spark, tables)
    for path in files.matching(spark, f"{tables.live(table)}/month=*/batch_id=*"):
        batch = int(files.partition_value(path))
        if batch > after and any(a <= batch <= b for a, b in done):
            found[int(files.partition_value(path.rsplit("/", 1)[0])), batch] = path
    for a, b in ranges:
        for path in files.matching(spark, f"{tables.compacted(table)}/batches={a}-{b}/month=*"):
            found[int(files.partition_value(path)), b] = path
    return found


def _sync(spark: SparkSession, name: str, wanted: dict[tuple[int, int], str]) -> None:
    """Add and drop partitions, so that the table shows ``wanted`` and no others.

    A partition whose place has changed, as by compaction, is added anew.
    """
    known = {
        tuple(int(part.split("=")[1]) for part in row[0].split("/"))
        for row in spark.sql(f"SHOW PARTITIONS {name}").collect()  # a row per month and batch not compacted yet
    }
    moved = {key for key in known & set(wanted) if "_compacted/" in wanted[key]}
    for month, batch in sorted((known - set(wanted)) | moved):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (month={month}, batch_id={batch})")
    new = sorted((set(wanted) - known) | moved)
    for i in range(0, len(new), 500):
        places = " ".join(
            f"PARTITION (month={m}, batch_id={b}) LOCATION '{wanted[m, b]}'" for m, b in new[i : i + 500]
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
    spark.catalog.refreshTable(name)


def init_schema(spark: SparkSession, tables: stored.Tables) -> None:
    """Create what is missing, then show the finished batches.

    Raw events, errors, minute states and hour states are external tables; hours and
    the two further views merge states when they are read. Call it again after new
    batches, a compaction or a clean-up: it adds and drops the partitions that
    changed.
    """
    stored.create_directories(spark, tables)
    for name, table in _EXTERNAL.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_columns(stored.SCHEMAS[table])}, month INT, batch_id BIGINT) "
            f"USING parquet PARTITIONED BY (month, batch_id) LOCATION '{tables.live(table)}'"
        )
        _sync(spark, name, _partitions(spark, tables, table))
    spark.sql(f"CREATE OR REPLACE VIEW {MINUTE_VIEW} AS {_merged('minute', MINUTE_TABLE)}")
    spark.sql(f"CREATE OR REPLACE VIEW {HOUR_VIEW} AS {_hours(MINUTE_TABLE)}")
    spark.sql(f"CREATE OR REPLACE VIEW {HOUR_TABLE} AS {_hours(HOUR_STATE_TABLE)}")


def missing_tables(spark: SparkSession) -> list[str]:
    return [name for name in _EXPECTED if not spark.catalog.tableExists(name)]


def verify_schema(spark: SparkSession) -> None:
    """Raise unless all four tables exist with the expected columns."""
    missing = missing_tables(spark)
    if missing:
        raise ValueError(f"table {missing[0]} does not exist")
    for name, expected in _EXPECTED.items():
        found = {f.name: f.dataType for f in spark.table(name).schema.fields}
        for field in expected.fields:
            if found.get(field.name) != field.dataType:
                raise ValueError(f"table {name} has no {field.name} {field.dataType.simpleString()}")


def drop_schema(spark: SparkSession, tables: stored.Tables | None = None) -> None:
    """Drop views and tables, and their data too when ``tables`` names its place."""
    for view in (MINUTE_VIEW, HOUR_VIEW, HOUR_TABLE):
        spark.sql(f"DROP VIEW IF EXISTS {view}")
    for name in _EXTERNAL:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if tables is not None:
        paths = [f"{tables.root}/log", f"{tables.root}/owner.json", tables.commits]
        paths += [tables.live(stored.MINUTE), tables.live(stored.HOUR)]
        for path in (*paths, *map(tables.compacted, stored.SCHEMAS)):
            files.delete(spark, path)


def schema_check(spark: SparkSession) -> DataFrame:
    """Per table whether it exists and how many rows it shows."""
    rows = None
    for name in _EXPECTED:
        exists = spark.catalog.tableExists(name)
        counted = spark.table(name) if exists else spark.range(0)
        row = counted.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(exists).alias("table_exists"), "row_count"
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows
