"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that results and tables rely on.

    All times are UTC. Parquet keeps minima and maxima of timestamps only in the
    standard encoding, not in Spark's default one, and skipping needs them.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only when the setting is absent and the
    session is a single local process, as in tests; it goes when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="pagetide-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh, uniquely named folder below the shared one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Let streams started from now on keep their state in RocksDB.

    For operators that remember every message of a period, which would not fit
    the executors' memory.
    """
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
