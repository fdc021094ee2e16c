"""Plain Parquet folders to which every batch adds a part that it replaces when it runs again.

    <root>/[day=D/]batch_id=N/

For what is kept beside the tables: user numbers and bitmaps, histogram states,
content keys, statistics. A part depends on its own batch and on earlier ones only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetide import session
from pagetide.sources import files


@dataclass(frozen=True)
class Parts:
    """A folder with the columns of ``schema``; those in ``by`` are directories."""

    root: str
    schema: T.StructType
    by: tuple[str, ...] = field(default=())

    def write(self, df: DataFrame, batch_id: int, rebalance: bool = True) -> None:
        spark = session.configure(df.sparkSession)
        levels = "".join(f"{name}=*/" for name in self.by)
        for path in files.matching(spark, f"{self.root}/{levels}batch_id={batch_id}"):
            files.delete(spark, path)
        rows = df.select(*self.schema.fieldNames())
        if rebalance and spark.conf.get("spark.sql.adaptive.enabled") == "true":
            rows = rows.hint("rebalance", *self.by)
        rows = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        writer = rows.write.mode("append").option("compression", "zstd").option("partitionOverwriteMode", "static")
        writer.partitionBy(*self.by, "batch_id").parquet(self.root)

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All parts, or those of batches below ``before``, with their ``batch_id``."""
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        if not files.matching(spark, f"{self.root}/*=*"):
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).parquet(self.root).select(*schema.fieldNames())
        return rows if before is None else rows.filter(F.col("batch_id") < before)
