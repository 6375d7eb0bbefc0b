"""Session settings and the shared folder for materialised intermediate data."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from touchline.sources.folders import delete, size

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # no call-site capture for every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "touchline", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own,
    removed when Python ends; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.TemporaryDirectory(prefix="touchline-", ignore_cleanup_errors=True)
    atexit.register(own.cleanup)
    spark.conf.set("spark.checkpoint.dir", own.name)
    return own.name


def share_code(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver found it (on a cluster: also in --py-files)."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (here, known)))


_made: list[str] = []


def new_folder(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Removes all folders made so far. Call it when no table that reads them is needed any more."""
    while _made:
        delete(spark, _made.pop())


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting its lineage.

    Survives executor loss, and gives every later pass the very same rows.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def joined_where_they_lie(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside join tables that both lie by some of the join's columns without exchanging them by all.

    Spark exchanges them by default, against skew; that costs both tables whole.
    """
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: stored bytes for each task of ``dealt_by_size``
TASK_BYTES = 2 << 20


@contextmanager
def dealt_by_size(stored: DataFrame) -> Iterator[None]:
    """Jobs run inside deal rows to more tasks the larger ``stored``, a materialised table, is: no task grows with it."""
    spark, key = stored.sparkSession, "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    parts = size(spark, os.path.dirname(stored.inputFiles()[0])) // TASK_BYTES
    spark.conf.set(key, str(max(int(before), parts)))
    try:
        yield
    finally:
        spark.conf.set(key, before)
