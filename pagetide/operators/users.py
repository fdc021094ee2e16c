"""Exact distinct users of any number as states that merge.

Users get dense numbers, and a state is a bitmap of the numbers seen: a row per
(window, page, bucket of 32,768 numbers), so a page with very many users is spread
over rows and tasks, and a row has a bound. Bitmaps of one key are united in any order
and grouping, and what is counted is bits, so counts are exact however the events were
split into batches. The sketches of ``rollup`` remain the smaller form where 65,536
exact users are enough.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagetide.functions import times
from pagetide.schema import USER_NUMBER, USER_STATE
from pagetide.sources.parts import Parts

#: Groups in which users are numbered one after the other, each within one task.
GROUPS = 4096


def numbered(users: DataFrame, start: int) -> DataFrame:
    """Distinct ``user_id`` with numbers from ``start`` on, without gaps.

    The users are dealt to groups by hash and numbered inside each; only the groups'
    sizes are added up in order. The same users always get the same numbers.
    """
    dealt = users.select("user_id", F.pmod(F.xxhash64("user_id"), F.lit(GROUPS)).alias("group"))
    sizes = dealt.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("group", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("group").orderBy("user_id"))
    ranked = dealt.withColumn("rank", within).join(F.broadcast(offsets), "group")  # a row per group
    return ranked.select("user_id", (F.col("offset") + F.col("rank") - 1 + start).cast("bigint").alias("number"))


def user_states(raw: DataFrame, numbers: DataFrame, window: Callable[[Column], Column] = times.minute) -> DataFrame:
    """Bitmaps of the users of raw rows by (window, page, bucket).

    Repeated views of a user collapse before the join with the numbers.
    """
    seen = raw.select(window(F.col("event_time")).alias("window_start"), "page_id", "user_id").distinct()
    met = seen.join(numbers.select("user_id", "number"), "user_id")
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return met.groupBy("window_start", "page_id", bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")
    )


def merge_user_states(states: DataFrame, window: Callable[[Column], Column] = lambda start: start) -> DataFrame:
    """States united by page, bucket and ``window`` of their window, still mergeable."""
    key = window(F.col("window_start")).alias("window_start")
    return states.groupBy(key, "page_id", "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def distinct_users(states: DataFrame, window: Callable[[Column], Column] = lambda start: start) -> DataFrame:
    """Exact distinct users per window and page."""
    counted = merge_user_states(states, window).select("window_start", "page_id", F.bitmap_count("users").alias("n"))
    return counted.groupBy("window_start", "page_id").agg(F.sum("n").alias("unique_users"))


def number_parts(root: str) -> Parts:
    return Parts(f"{root}/user_numbers", USER_NUMBER)


def state_parts(root: str) -> Parts:
    return Parts(f"{root}/user_states", USER_STATE, by=("month",))


def write_batch_users(raw: DataFrame, root: str, batch_id: int) -> None:
    """Number the users a batch is the first to see, and store its bitmaps.

    Both follow from the batch and from earlier ones, so running it again replaces
    them by the same rows.
    """
    spark, numbers = raw.sparkSession, number_parts(root)
    known = numbers.read(spark, before=batch_id)
    last = known.agg(F.max("number")).first()[0]
    fresh = raw.select("user_id").distinct().join(known, "user_id", "left_anti")
    numbers.write(numbered(fresh, 1 if last is None else last + 1), batch_id)
    states = user_states(raw, numbers.read(spark, before=batch_id + 1))
    state_parts(root).write(states.withColumn("month", times.month(F.col("window_start"))), batch_id)


def read_user_states(spark: SparkSession, root: str) -> DataFrame:
    return state_parts(root).read(spark)
