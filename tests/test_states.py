"""States that merge, lookups that skip, resends and gaps."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import NOW, event, messages, multiset
from pagetide import session
from pagetide.functions import histogram, times
from pagetide.operators import events, lifecycle, queries, reports, rollup, users
from pagetide.schema import MESSAGE, RAW
from pagetide.sources import buckets, content, topic
from pagetide.sources import tables as stored
from pagetide.streaming import ingest, windows


@pytest.fixture
def folder(spark):
    return session.run_folder(spark, "states")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after the query has run."""
    df.collect()
    return plan(df)


def views(spark, first, last, page="p", minute=0):
    """A view per user number of the range, in one minute."""
    at = f"TIMESTAMP '2024-01-10 10:{minute:02d}:00' + make_interval(0, 0, 0, 0, 0, 0, id % 60)"
    return spark.range(first, last).selectExpr(
        f"to_date({at}) AS event_date", f"{at} AS event_time", f"'{page}' AS page_id", "concat('u', id) AS user_id",
        "id AS duration_ms", "'a' AS user_agent", "'::' AS ip_address", "'EU' AS region", "CAST(0 AS TINYINT) AS is_bounce",
        "id AS kafka_offset", "0 AS kafka_partition", "TIMESTAMP '2024-01-10 11:00:00' AS processed_time",
    )


# Exact users


def test_more_users_than_a_sketch_keeps(spark, folder):
    """Four overlapping batches, over 65,536 users in one minute of one page."""
    parts = [(0, 40_000), (30_000, 80_000), (80_000, 120_000), (0, 120_000)]
    rows = [views(spark, a, b) for a, b in parts]
    rows[1] = rows[1].unionByName(views(spark, 5, 9, page="q", minute=1))
    for batch_id, raw in enumerate(rows):
        users.write_batch_users(raw, folder, batch_id)
    everything = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])
    states = users.read_user_states(spark, folder)
    for unit in (times.minute, times.hour):
        expected = rollup.exact_aggregates(everything, unit).select("window_start", "page_id", "unique_users")
        assert multiset(users.distinct_users(states, unit)) == multiset(expected)
    assert users.distinct_users(states).agg(F.max("unique_users")).first()[0] == 120_000
    sizes = states.filter("page_id = 'p'").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r["batch_id"]: r["n"] for r in sizes}[3] == 4  # buckets of 32,768
    numbers = users.number_parts(folder).read(spark)
    assert numbers.agg(F.min("number"), F.max("number"), F.count_distinct("number"), F.count("*")).first()[:] == (1, 120_000, 120_000, 120_000)


def test_a_batch_of_users_run_again_replaces_itself(spark, folder):
    users.write_batch_users(views(spark, 0, 50), folder, 0)
    users.write_batch_users(views(spark, 40, 90), folder, 1)
    before = multiset(users.read_user_states(spark, folder))
    users.write_batch_users(views(spark, 40, 90), folder, 1)
    assert multiset(users.read_user_states(spark, folder)) == before
    merged = users.merge_user_states(users.read_user_states(spark, folder))
    assert users.distinct_users(merged).first()["unique_users"] == 90
    assert users.distinct_users(users.read_user_states(spark, f"{folder}/none")).collect() == []


def test_users_of_finished_batches_only(spark, folder, monkeypatch):
    tables = stored.Tables(folder)
    extras = stored.Extras(exact_users=True, statistics=True)
    stored.create_directories(spark, tables)
    stored.ingest_batch(messages(spark, [event(), event(user_id="b"), "x"]), 0, tables, NOW, extras=extras)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(stored, "commit", fail)
        with pytest.raises(RuntimeError):
            stored.ingest_batch(messages(spark, [event(user_id="c")], start=9), 1, tables, NOW, extras=extras)
    assert users.distinct_users(stored.read_user_states(spark, tables)).first()["unique_users"] == 2
    assert [r["valid_messages"] for r in stored.read_statistics(spark, tables).collect()] == [2]
    stored.ingest_batch(messages(spark, [event(user_id="c")], start=9), 1, tables, NOW, extras=extras)
    assert users.distinct_users(stored.read_user_states(spark, tables)).first()["unique_users"] == 3
    rows = stored.read_statistics(spark, tables).orderBy("batch_id").collect()
    assert [(r["messages_processed"], r["valid_messages"], r["invalid_messages"]) for r in rows] == [(3, 2, 1), (1, 1, 0)]


def test_statistics_of_a_batch_without_valid_events(spark, folder):
    tables = stored.Tables(folder)
    stored.create_directories(spark, tables)
    extras = stored.Extras(exact_users=True, statistics=True, drop_resends=True)
    stored.ingest_batch(messages(spark, ["x", "y"]), 0, tables, NOW, extras=extras)
    row = stored.read_statistics(spark, tables).first()
    assert (row["messages_processed"], row["valid_messages"], row["first_event_time"]) == (2, 0, None)
    assert stored.read_user_states(spark, tables).collect() == []


# Resends


def test_resends_are_left_out_across_batches(spark, folder):
    tables = stored.Tables(folder)
    stored.create_directories(spark, tables)
    extras = stored.Extras(drop_resends=True)

    def run(batch_id, values, start):
        stored.ingest_batch(messages(spark, values, start=start), batch_id, tables, NOW, extras=extras)

    def offsets():
        return sorted(r["kafka_offset"] for r in stored.read_raw(spark, tables).collect())

    other_day = event(timestamp="2024-01-05T00:00:00Z")
    run(0, [event(), event(), other_day, "broken"], 0)
    assert offsets() == [0, 2]
    run(1, [event(), event(user_id="new"), other_day, "broken"], 10)
    assert offsets() == [0, 2, 11]
    run(1, [event(), event(user_id="new"), other_day, "broken"], 10)  # again, alike
    assert offsets() == [0, 2, 11]
    assert stored.read_errors(spark, tables).count() == 2  # rejected messages are not compared
    run(2, [event(is_bounce=True), event(user_id="new")], 20)
    assert offsets() == [0, 2, 11, 20]


def test_only_the_days_of_the_batch_are_compared(spark, folder):
    for batch_id in range(2):
        rows = [views(spark, 0, 5).withColumn("event_date", F.date_add("event_date", day)) for day in range(6)]
        for more in rows[1:]:
            rows[0] = rows[0].unionByName(more)
        content.write_batch_keys(rows[0], folder, batch_id)
    batch = content.with_key(views(spark, 3, 8))
    seen = content.seen_on_days_of(batch, folder, 2)
    assert seen.count() == 10
    text = final_plan(seen)
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", text), text
    assert content.seen_on_days_of(batch, folder, 1).count() == 5
    gone = content.drop_days_before(spark, folder, date(2024, 1, 13))
    assert sorted(p.rsplit("=", 1)[1] for p in gone) == ["2024-01-10", "2024-01-11", "2024-01-12"]
    assert content.index(folder).read(spark).select("event_date").distinct().count() == 3


def test_expired_days_of_the_index_go_with_retention(spark, folder):
    tables = stored.Tables(folder)
    stored.create_directories(spark, tables)
    old, new = event(timestamp="2024-01-02T00:00:00Z"), event(timestamp="2024-01-29T00:00:00Z")
    stored.ingest_batch(messages(spark, [old, new]), 0, tables, NOW, extras=stored.Extras(drop_resends=True))
    dropped = lifecycle.drop_expired(spark, tables, datetime(2024, 2, 2))
    assert [p for p in dropped if "content_index" in p] == [f for f in dropped if f.endswith("event_date=2024-01-02")]
    assert content.index(folder).read(spark).count() == 1


# Lookups and merges without a shuffle


def test_merging_bucketed_states_does_not_shuffle(spark, folder):
    database = "states_test"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/db'")
    rows = [views(spark, i * 10, i * 10 + 25, page=f"p{i % 3}", minute=i) for i in range(6)]
    for raw in rows:
        buckets.append_states(rollup.minute_states(raw), f"{database}.states", f"{folder}/states", buckets=4)
    states = buckets.read_states(spark, f"{database}.states")
    everything = rows[0]
    for raw in rows[1:]:
        everything = everything.unionByName(raw)
    minutes, hours = rollup.minute_aggregates(states), rollup.hourly_rollup(states)
    for df in (minutes, hours):
        assert "Exchange" not in final_plan(df)
    assert multiset(minutes) == multiset(rollup.exact_aggregates(everything, times.minute))
    assert multiset(hours) == multiset(rollup.with_ratios(rollup.exact_aggregates(everything, times.hour)))
    spark.sql(f"DROP DATABASE {database} CASCADE")


def scanned_rows(spark, df):
    """Rows that the scan itself has handed on."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        if name.startswith("AdaptiveSparkPlan"):
            walk(node.executedPlan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(text)
    return sum(found)


def test_a_user_is_looked_up_by_filters(spark, folder, monkeypatch):
    tables = stored.Tables(folder)
    rows = views(spark, 0, 4000).withColumn("route", F.lit("raw")).withColumn("month", F.lit(202401))
    rows = rows.withColumn("error_time", F.lit(None).cast("timestamp")).withColumn("raw_message", F.lit(None).cast("string"))
    rows = rows.withColumn("error_reason", F.lit(None).cast("string"))
    stored.create_directories(spark, tables)
    stored.write_log(rows.repartition(4), tables, 0)
    stored.commit(spark, tables, 0)
    raw = stored.read_raw(spark, tables)
    spark.conf.set("parquet.filter.dictionary.enabled", "false")
    try:
        there = queries.events_of(raw, date(2024, 1, 10), user_id="u77")
        absent = queries.events_of(raw, date(2024, 1, 10), user_id="u77x", page_id="p")
        assert there.count() == 1 and absent.count() == 0
        few, none = scanned_rows(spark, there), scanned_rows(spark, absent)
        assert few <= 1500 and none == 0
        spark.conf.set("parquet.filter.bloom.enabled", "false")
        assert scanned_rows(spark, queries.events_of(raw, date(2024, 1, 10), user_id="u77x", page_id="p")) > 0
    finally:
        spark.conf.unset("parquet.filter.dictionary.enabled")
        spark.conf.unset("parquet.filter.bloom.enabled")
    with pytest.raises(ValueError):
        queries.events_of(raw, date(2024, 1, 10))


# Histograms and gaps


def test_histogram_states_add_up(spark):
    edges = histogram.exponential_edges(1, 2, 5)
    rng = random.Random(2)
    rows = [(datetime(2024, 1, 1, 0, rng.randrange(5)), rng.choice([None, 0.5, 1.0, 2.0, 3.0, 16.0, 99.0, float("nan")])) for _ in range(300)]
    df = spark.createDataFrame(rows, "at timestamp, v double")
    parts = [reports.histogram_states(df.filter(F.pmod(F.hash("at", "v"), F.lit(4)) == i), F.col("v"), edges, times.minute(F.col("at"))) for i in range(4)]
    states = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    merged = reports.cumulated(reports.merge_histograms(states, 6), edges)
    assert multiset(merged) == multiset(reports.histogram(df, F.col("v"), edges))
    hours = reports.merge_histograms(states, 6, times.hour(F.col("window_start")))
    assert multiset(reports.cumulated(hours, edges).drop("window_start")) == multiset(merged)
    again = reports.merge_histograms(reports.merge_histograms(states, 6, F.col("window_start")), 6)
    assert multiset(reports.cumulated(again, edges)) == multiset(merged)
    assert [r["cumulative_count"] for r in reports.cumulated(reports.merge_histograms(states.limit(0), 6), edges).collect()] == [0] * 6


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_offset_gaps(spark, chunk):
    rng = random.Random(chunk)
    held = {p: sorted(rng.sample(range(p * 10, 200), 60)) for p in range(3)}
    held[3] = [5]
    rows = [("", "t", p, o, datetime(2024, 1, 1)) for p, offsets in held.items() for o in [*offsets, offsets[0]]]
    expected = []
    for p, offsets in held.items():
        for a, b in zip(offsets, offsets[1:]):
            if b > a + 1:
                expected.append((p, a + 1, b - 1, b - a - 1))
    got = [tuple(r) for r in reports.offset_gaps(spark.createDataFrame(rows, MESSAGE), chunk).collect()]
    assert sorted(got) == expected


# Distinct users of a stream


def test_users_of_a_stream_count_once(spark, folder):
    """Repeats within and across batches, late ones included, count once; nothing is late
    within the delay."""
    def at(minute, second, user, page="p"):
        return event(timestamp=f"2024-01-30T10:{minute:02d}:{second:02d}Z", user_id=user, page_id=page)

    waves = [
        [at(0, 1, "a"), at(0, 9, "a"), at(0, 5, "b"), at(1, 0, "a")],
        [at(0, 30, "a"), at(0, 40, "c"), at(2, 0, "a"), at(0, 59, "a", "q")],
        [at(1, 1, "b"), at(0, 2, "c"), at(30, 0, "z")],
        [at(59, 59, "end")],
    ]
    for i, values in enumerate(waves):
        messages(spark, values, start=10 * i).coalesce(1).write.mode("append").parquet(f"{folder}/topic")
    raw = events.raw_rows(events.gate(topic.stream_files(spark, f"{folder}/topic", 1), NOW))
    counted = windows.exact_users(raw, "5 minutes")
    query = counted.writeStream.format("parquet").option("checkpointLocation", f"{folder}/c").outputMode("append")
    query.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    got = {(r["window_start"].minute, r["page_id"]): r["unique_users"] for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {(0, "p"): 3, (0, "q"): 1, (1, "p"): 2, (2, "p"): 1, (30, "p"): 1}
    state = spark.read.format("statestore").load(f"{folder}/c")
    assert state.count() < 10  # what the watermark has passed is forgotten


def test_statistics_of_a_stream(spark, folder):
    for i in range(3):
        messages(spark, [event()] * (i + 1) + ["x"], start=10 * i).coalesce(1).write.mode("append").parquet(f"{folder}/topic")
    tables = stored.Tables(f"{folder}/tables")
    ingest.drain(topic.stream_files(spark, f"{folder}/topic", 1), tables, f"{folder}/c", NOW, extras=stored.Extras(statistics=True))
    rows = stored.read_statistics(spark, tables).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["valid_messages"], r["invalid_messages"]) for r in rows] == [(0, 1, 1), (1, 2, 1), (2, 3, 1)]
    assert rows[0]["last_event_time"] - rows[0]["first_event_time"] == timedelta(0)
    assert set(RAW.fieldNames()) <= set(stored.read_raw(spark, tables).columns)
