"""Minute states as a table bucketed by page, which merges without a shuffle.

Every append deals its rows to the same buckets by page, so states of one page lie in
files of one bucket number, whichever batch they came with. Merging to minutes or hours
groups by page as well, and reads each bucket in one task. States are aggregated per
batch, minute and page already, so no page has more rows than minutes times batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide import session
from pagetide.functions import times
from pagetide.schema import MINUTE_STATE

#: Buckets of a new table: as many tasks read a month, whatever its size.
BUCKETS = 512


def append_states(states: DataFrame, table: str, path: str | None = None, buckets: int = BUCKETS) -> None:
    """Add states to the bucketed table ``table``, which is made where there is none.

    ``path`` and ``buckets`` hold for a new table; an append keeps to those it has.
    """
    session.configure(states.sparkSession)
    rows = states.select(*MINUTE_STATE.fieldNames()).withColumn("month", times.month(F.col("window_start")))
    rows = rows.repartition(buckets, "page_id").sortWithinPartitions("month", "page_id", "window_start")
    writer = rows.write.format("parquet").mode("append").partitionBy("month").option("compression", "zstd")
    writer = writer.bucketBy(buckets, "page_id").sortBy("page_id", "window_start")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def read_states(spark: SparkSession, table: str) -> DataFrame:
    return session.configure(spark).table(table)
