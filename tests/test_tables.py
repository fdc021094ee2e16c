"""Stored tables: replays, crashes, compaction, retention, names."""

import glob
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import NOW, event, messages, multiset
from pagetide import session
from pagetide.functions import times
from pagetide.operators import events, lifecycle, queries, rollup
from pagetide.plans import fixture
from pagetide.schema import ERROR_ROUTE, RAW_ROUTE
from pagetide.sources import catalog, files
from pagetide.sources import tables as stored


@pytest.fixture
def tables(spark):
    made = stored.Tables(session.run_folder(spark, "tables"))
    stored.create_directories(spark, made)
    return made


@pytest.fixture(scope="module")
def source(spark, sf_dir):
    return fixture.messages(spark, sf_dir).persist()


def fill(source, tables, batches=4, as_of=NOW):
    for batch_id in range(batches):
        part = source.filter(F.col("partition") == batch_id)
        stored.ingest_batch(part, batch_id, tables, as_of)


def contents(spark, tables):
    return {
        "raw": multiset(stored.read_raw(spark, tables)),
        "errors": multiset(stored.read_errors(spark, tables)),
        "minutes": multiset(rollup.minute_aggregates(stored.read_states(spark, tables))),
        "hours": multiset(rollup.hourly_rollup(stored.read_states(spark, tables, stored.HOUR))),
    }


def test_tables_hold_what_the_operators_make(spark, tables, source):
    fill(source, tables)
    gated = events.gate(source, NOW)
    raw = events.raw_rows(gated)
    columns = raw.columns
    assert multiset(stored.read_raw(spark, tables).select(*columns)) == multiset(raw)
    errors = events.error_rows(gated)
    assert multiset(stored.read_errors(spark, tables).select(*errors.columns)) == multiset(errors)
    minutes = rollup.exact_aggregates(raw, times.minute)
    assert multiset(rollup.minute_aggregates(stored.read_states(spark, tables))) == multiset(minutes)


def test_a_replayed_batch_replaces_itself(spark, tables, source):
    fill(source, tables)
    before = contents(spark, tables)
    stored.ingest_batch(source.filter("partition = 2"), 2, tables, NOW)
    assert contents(spark, tables) == before


def test_a_replay_leaves_nothing_of_the_first_run(spark, tables):
    stored.ingest_batch(messages(spark, [event(), "x"]), 0, tables, NOW)
    stored.ingest_batch(messages(spark, [event(timestamp="2024-01-30T00:00:00Z")]), 0, tables, NOW)
    assert stored.read_errors(spark, tables).count() == 0
    assert stored.read_raw(spark, tables).count() == 1
    assert stored.read_states(spark, tables).count() == 1
    stored.ingest_batch(messages(spark, ["x"]), 0, tables, NOW)
    assert stored.read_raw(spark, tables).count() == 0
    assert stored.read_states(spark, tables).count() == 0


@pytest.mark.parametrize("lost", ["write_batch_states", "commit"])
def test_a_half_written_batch_is_not_seen(spark, tables, source, monkeypatch, lost):
    fill(source, tables, batches=3)
    before = contents(spark, tables)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr(stored, lost, fail)
        stored.ingest_batch(source.filter("partition = 3"), 3, tables, NOW)
    for table in (RAW_ROUTE, ERROR_ROUTE):
        assert files.matching(spark, f"{tables.live(table)}/month=*/batch_id=3")
    assert contents(spark, tables) == before
    with pytest.raises(ValueError, match="not all finished"):
        lifecycle.compact(spark, tables, stored.MINUTE, last=3)
    stored.ingest_batch(source.filter("partition = 3"), 3, tables, NOW)
    assert contents(spark, tables) != before
    assert stored.read_raw(spark, tables).filter("batch_id = 3").count() > 0


def test_a_batch_that_runs_again_is_not_seen_half(spark, tables, source, monkeypatch):
    fill(source, tables)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr(stored, "write_batch_states", fail)
        stored.ingest_batch(source.filter("partition = 2"), 2, tables, NOW)
    assert stored.committed_ranges(spark, tables) == [(0, 1), (3, 3)]
    assert stored.read_raw(spark, tables).filter("batch_id = 2").count() == 0


def test_a_root_has_one_owner(spark, tables):
    stored.ingest_batch(messages(spark, [event()]), 0, tables, NOW)
    with pytest.raises(ValueError, match="whose batch numbers"):
        stored.ingest_batch(messages(spark, [event()]), 0, tables, NOW, owned_by="another")


def test_replays_are_left_out_whatever_batch_holds_them(spark, tables):
    stored.ingest_batch(messages(spark, [event(), "x"], start=0), 0, tables, NOW)
    stored.ingest_batch(messages(spark, [event()], start=7), 1, tables, NOW)
    for table in (RAW_ROUTE, ERROR_ROUTE, stored.MINUTE, stored.HOUR):
        lifecycle.compact(spark, tables, table, last=1)
        lifecycle.clean(spark, tables, table, grace_seconds=0)
    assert [(r["first"], r["last"], r["offsets"]) for r in stored.commits(spark, tables)] == [(0, 1, {"0": [0, 7]})]
    sent = messages(spark, [event(), "x", event(), event()], start=0)
    again = sent.unionByName(messages(spark, [event()], start=3))
    stored.ingest_batch(again, 2, tables, NOW, drop_replays=True)
    stored.ingest_batch(again, 2, tables, NOW, drop_replays=True)  # its own rows are no replays
    assert sorted(r.kafka_offset for r in stored.read_raw(spark, tables).collect()) == [0, 2, 3, 7]
    assert stored.read_errors(spark, tables).count() == 1


def test_replays_are_asked_for_without_reading_messages_twice(spark, tables):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    sent = messages(spark, [event() for _ in range(5)], start=0)
    again = sent.mapInArrow(counted, sent.schema)
    stored.ingest_batch(sent.limit(2), 0, tables, NOW)
    stored.ingest_batch(again, 1, tables, NOW, drop_replays=True)
    assert read.value == 5
    assert sorted(r.kafka_offset for r in stored.read_raw(spark, tables).collect()) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("table", [RAW_ROUTE, ERROR_ROUTE])
def test_rows_are_compacted(spark, tables, source, table):
    fill(source, tables)
    before = contents(spark, tables)
    lifecycle.compact(spark, tables, table, last=2)
    rows = stored.read(spark, tables, table)
    assert {r.batch_id for r in rows.select("batch_id").distinct().collect()} == {2, 3}
    lifecycle.clean(spark, tables, table)  # within the grace period nothing goes
    assert len({files.partition_value(p) for p in files.matching(spark, f"{tables.live(table)}/month=*/batch_id=*")}) == 4
    lifecycle.clean(spark, tables, table, grace_seconds=0)
    assert {files.partition_value(p) for p in files.matching(spark, f"{tables.live(table)}/month=*/batch_id=*")} == {"3"}
    after = contents(spark, tables)
    columns = [c for c in stored.read(spark, tables, table).columns if c != "batch_id"]
    assert {k: v for k, v in after.items() if k != table} == {k: v for k, v in before.items() if k != table}
    assert len(after[table]) == len(before[table])
    assert multiset(stored.read(spark, tables, table).select(*columns)) == multiset(rows.select(*columns))
    with pytest.raises(ValueError, match="has been compacted"):
        stored.ingest_batch(source.filter("partition = 1"), 1, tables, NOW)


def test_a_read_bounded_by_time_lists_its_months_only(spark, tables):
    for batch_id, day in enumerate(("2024-01-03", "2024-02-03", "2024-03-03")):
        sent = [event(timestamp=f"{day}T00:00:00Z")]
        stored.ingest_batch(messages(spark, sent, start=batch_id), batch_id, tables, f"{day} 00:00:00")
    for table in (RAW_ROUTE, stored.MINUTE):
        found = stored.read(spark, tables, table, since=date(2024, 3, 2))
        assert found.count() == 1
        assert all("month=202403" in name for name in found.inputFiles())
    lifecycle.compact(spark, tables, RAW_ROUTE, last=1)
    found = stored.read_raw(spark, tables, since=date(2024, 3, 2))
    assert all("month=202403" in name for name in found.inputFiles()) and found.count() == 1


def test_stored_retention_is_pushed_down(spark, tables, source):
    fill(source, tables)
    for table, column in ((RAW_ROUTE, "event_date"), (stored.MINUTE, "window_start")):
        kept = lifecycle.read_retained(spark, tables, table, NOW)
        text = kept._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThan({column}" in text.split("PushedFilters: [")[1].split("\n")[0]


def test_empty_tables_and_batches(spark, tables):
    assert contents(spark, tables) == {"raw": [], "errors": [], "minutes": [], "hours": []}
    stored.ingest_batch(messages(spark, [event()]).limit(0), 0, tables, NOW)
    assert contents(spark, tables) == {"raw": [], "errors": [], "minutes": [], "hours": []}


@pytest.mark.parametrize("grain", [stored.MINUTE, stored.HOUR])
def test_compaction_changes_no_result(spark, tables, source, grain):
    fill(source, tables)
    before = contents(spark, tables)
    lifecycle.compact(spark, tables, grain, last=1)
    assert contents(spark, tables) == before
    lifecycle.compact(spark, tables, grain, last=2)
    assert stored.compacted_ranges(spark, tables, grain) == [(0, 1), (2, 2)]
    assert contents(spark, tables) == before
    lifecycle.compact(spark, tables, grain, last=2, first=0)
    assert stored.compacted_ranges(spark, tables, grain) == [(0, 2)]
    assert contents(spark, tables) == before
    lifecycle.clean(spark, tables, grain, grace_seconds=0)
    assert contents(spark, tables) == before
    left = files.matching(spark, f"{tables.live(grain)}/month=*/batch_id=*")
    assert {files.partition_value(p) for p in left} == {"3"}
    merged = stored.read_states(spark, tables, grain, last=2)
    assert merged.count() == merged.select("window_start", "page_id").distinct().count()


def test_an_unfinished_compaction_is_not_read(spark, tables, source):
    fill(source, tables)
    before = contents(spark, tables)
    lifecycle.compact(spark, tables, stored.MINUTE, last=1)
    files.delete(spark, f"{tables.compacted(stored.MINUTE)}/batches=0-1/_SUCCESS")
    assert contents(spark, tables) == before


def test_compaction_bounds(spark, tables, source):
    fill(source, tables)
    lifecycle.compact(spark, tables, stored.MINUTE, last=1)
    with pytest.raises(ValueError, match="nothing to compact"):
        lifecycle.compact(spark, tables, stored.MINUTE, last=1)
    with pytest.raises(ValueError, match="not compacted yet"):
        lifecycle.compact(spark, tables, stored.MINUTE, last=3, first=3)
    with pytest.raises(ValueError, match="cut through"):
        stored.read_states(spark, tables, stored.MINUTE, last=0)


def test_latest_errors_read_only_what_they_need(spark, tables):
    for batch_id, day in enumerate(("2024-01-03", "2024-02-03", "2024-03-03")):
        sent = messages(spark, ["x", "y"], start=2 * batch_id)
        stored.ingest_batch(sent, batch_id, tables, f"{day} 00:00:00")
    errors = stored.read_errors(spark, tables)
    for limit in (1, 2, 3, 6, 10):
        narrow = queries.latest_errors(errors, limit, narrow_first=True)
        assert narrow.collect() == queries.latest_errors(errors, limit).collect()
        assert narrow.count() == min(limit, 6)
    plan = queries.latest_errors(errors, 3, narrow_first=True)._jdf.queryExecution()
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)  # the filters in full
    text = plan.executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(error_time,ScalarSubquery" in text
    pruned = [part.split("PushedFilters")[0] for part in text.split("PartitionFilters: [")[1:]]
    assert any("month" in part and "Subquery" in part for part in pruned)
    assert queries.latest_errors(errors.limit(0), 3, narrow_first=True).collect() == []


def test_retention_filter(spark):
    rows = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "d string")
    rows = rows.select(F.col("d").cast("date").alias("event_date"))
    kept = lifecycle.apply_retention(rows, "event_date", 30, "2024-01-31 00:00:00").collect()
    assert [str(r.event_date) for r in kept] == ["2024-01-02"]


def test_expired_months_are_dropped_whole(spark, tables):
    sent = [event(timestamp="2024-01-31T23:59:59Z"), event(timestamp="2024-02-01T00:00:00Z"), "x"]
    stored.ingest_batch(messages(spark, sent), 0, tables, "2024-02-01 00:00:00")
    assert lifecycle.drop_expired(spark, tables, datetime(2024, 2, 7, 23, 59)) == []
    dropped = lifecycle.drop_expired(spark, tables, datetime(2024, 2, 8))
    assert [p.split(tables.root)[1] for p in dropped] == ["/minute/month=202401"]
    assert stored.read_states(spark, tables).count() == 1
    assert stored.read_raw(spark, tables).count() == 2
    assert stored.read_states(spark, tables, stored.HOUR).count() == 2
    lifecycle.drop_expired(spark, tables, datetime(2024, 3, 2))
    assert [str(r.event_date) for r in stored.read_raw(spark, tables).collect()] == ["2024-02-01"]
    assert stored.read_errors(spark, tables).count() == 1
    catalog.drop_schema(spark)
    catalog.init_schema(spark, tables)
    partitions = [r[0] for r in spark.sql("SHOW PARTITIONS page_views_raw").collect()]
    assert partitions == ["month=202402/batch_id=0"]
    catalog.drop_schema(spark)


@pytest.mark.parametrize("codec", sorted(stored.CODECS))
def test_codecs(spark, codec):
    tables = stored.Tables(session.run_folder(spark, "codec"), codec)
    stored.create_directories(spark, tables)
    stored.ingest_batch(messages(spark, [event()]), 0, tables, NOW)
    assert stored.read_raw(spark, tables).count() == 1


@pytest.mark.parametrize(
    "path, column", [("minute", "window_start"), ("log/route=raw", "event_time")]
)
def test_files_can_be_skipped_by_time(spark, tables, path, column):
    spark.conf.unset("spark.sql.parquet.outputTimestampType")
    stored.ingest_batch(messages(spark, [event()]), 0, tables, NOW)
    (file,) = glob.glob(f"{tables.root}/{path}/month=202401/batch_id=0/*.parquet")
    parquet = pq.ParquetFile(file)
    found = parquet.metadata.row_group(0).column(parquet.schema.names.index(column))
    assert found.statistics.has_min_max


def test_unknown_codec():
    with pytest.raises(ValueError, match="unknown codec"):
        stored.Tables("/nowhere", "rar")


def test_schema_lifecycle(spark, tables, source):
    catalog.drop_schema(spark)
    assert len(catalog.missing_tables(spark)) == 4
    with pytest.raises(ValueError, match="does not exist"):
        catalog.verify_schema(spark)
    catalog.init_schema(spark, tables)
    catalog.verify_schema(spark)
    assert spark.table("page_views_raw").count() == 0
    fill(source, tables)
    catalog.init_schema(spark, tables)
    catalog.verify_schema(spark)
    counted = spark.sql(
        "SELECT (SELECT count(*) FROM page_views_raw) AS raw, "
        "(SELECT count(*) FROM processing_errors) AS errors"
    ).first()
    assert counted.raw == stored.read_raw(spark, tables).count() > 0
    assert counted.errors == stored.read_errors(spark, tables).count() > 0
    found = contents(spark, tables)
    assert multiset(spark.table("page_views_raw_to_minute")) == found["minutes"]
    assert multiset(spark.table("page_views_minute_to_hour")) == found["hours"]
    assert multiset(spark.table("page_views_agg_hour")) == found["hours"]
    for table in (RAW_ROUTE, stored.MINUTE):
        lifecycle.compact(spark, tables, table, last=2)
        lifecycle.clean(spark, tables, table, grace_seconds=0)
    lifecycle.drop_expired(spark, tables, datetime(2024, 2, 20))
    catalog.init_schema(spark, tables)
    assert spark.table("page_views_raw").count() == counted.raw
    assert spark.table("page_views_agg_minute").count() == 0
    assert spark.sql("SHOW PARTITIONS page_views_agg_minute").count() == 0
    catalog.drop_schema(spark, tables)
    assert len(catalog.missing_tables(spark)) == 4
    assert not files.exists(spark, f"{tables.root}/log")
    catalog.drop_schema(spark)


def test_verify_finds_a_wrong_column(spark, tables):
    catalog.init_schema(spark, tables)
    spark.sql("SELECT 'x' AS window_start").createOrReplaceTempView("page_views_agg_minute")
    with pytest.raises(ValueError, match="page_views_agg_minute has no window_start"):
        catalog.verify_schema(spark)
    catalog.drop_schema(spark)


def test_a_large_topic_is_many_files_of_the_same_messages(spark, sf_dir, source, monkeypatch):
    monkeypatch.setattr(fixture, "FILE_ROWS", source.count() // 12 + 1)  # three files to a fourth of the rows
    folder = session.run_folder(spark, "topic")
    assert fixture.write_topic_slices(spark, sf_dir, f"{folder}/slices", [0, 1, 2, 3]) == 12
    parts = fixture.write_topic_partitions(spark, sf_dir, f"{folder}/parts")
    assert len(parts.inputFiles()) == 12
    sent = source.select(*parts.columns)
    assert multiset(parts) == multiset(sent)
    assert multiset(spark.read.schema(parts.schema).parquet(f"{folder}/slices").select(*parts.columns)) == multiset(sent)
