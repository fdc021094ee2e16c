"""Every registered query against its SQL on DuckDB, and the shape of plans."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of
from helpers import event, messages
from pagetide.functions import times
from pagetide.operators import events, queries, rollup
from pagetide.plans import fixture
from pagetide.plans.expected import SQL
from pagetide.plans.registry import QUERIES
from pagetide.sources import tables as stored


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    expected = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(df.columns)
    got = [tuple(row) for row in df.collect()]
    assert rows_of(df.columns, got) == rows_of(columns, expected.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_results_hold_no_binary_and_no_zoned_times(spark, sf_dir):
    for name in ("raw_events", "hourly_rollup", "latest_aggregates_1h", "ingest_status"):
        kinds = {t for _, t in entry.queries()[name](spark, sf_dir).dtypes}
        assert not kinds & {"binary", "timestamp"}, name


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_messages_are_parsed_once(spark, sf_dir):
    gated = events.gate(fixture.messages(spark, sf_dir), fixture.MAIN)
    for df in (
        events.raw_rows(gated),
        events.error_rows(gated),
        rollup.exact_aggregates(events.raw_rows(gated), times.hour),
    ):
        text = plan(df)
        assert text.count("from_json(ArrayType(StructType(StructField(page_id,StringType") == 1
        assert text.count("from_json(ArrayType(StructType(StructField(page_id,VariantType") == 1
        assert "Python" not in text


def test_shuffles(spark):
    gated = events.gate(messages(spark, [event()]), fixture.MAIN)
    raw = events.raw_rows(gated)
    assert plan(raw).count("Exchange") == 0
    assert plan(rollup.minute_states(raw)).count("Exchange hashpartitioning") == 1
    assert "TakeOrderedAndProject" in plan(
        queries.latest_errors(events.error_rows(gated))
    )


def test_stored_states_are_pruned(spark, sf_dir):
    from pagetide import session

    tables = stored.Tables(session.run_folder(spark, "pruned"))
    stored.create_directories(spark, tables)
    stored.ingest_batch(fixture.messages(spark, sf_dir), 0, tables, fixture.MAIN)
    recent = queries.latest_aggregates(stored.read_states(spark, tables), fixture.MAIN)
    text = plan(recent)
    assert "PushedFilters: [IsNotNull(window_start), GreaterThanOrEqual(window_start" in text
    assert "month" in text.split("PartitionFilters: [")[1].split("]")[0]
    counted = stored.read_raw(spark, tables).groupBy("page_id").count()
    assert "ReadSchema: struct<page_id:string>" in plan(counted)
    narrow = plan(queries.latest_aggregates(stored.read_states(spark, tables), fixture.MAIN, keys_first=True))
    assert "ReadSchema: struct<window_start:timestamp,page_id:string>" in narrow
    # the plan's text is cut after the second bound, which is the subquery's
    assert "GreaterThanOrEqual(window_start,2024-01-30 23:00:00.0), GreaterThanOrEq" in narrow


def test_resends_are_dropped_by_hashing(spark, sf_dir):
    text = plan(QUERIES["dedup_content"](spark, sf_dir))
    assert "SortAggregate" not in text and "HashAggregate" in text
