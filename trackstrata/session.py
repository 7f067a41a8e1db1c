"""Session set-up, tables that a job holds on the way, and size checks.

``hold`` computes a table once and writes it as Parquet below the folder that ``spark.checkpoint.dir`` names (else below the
warehouse, which executors share as well). Lost executors then cost a read, and later steps still prune its columns.
The tables of a ``holding`` block are deleted when the block ends; those held outside of one when the JVM ends.
``broadcast_if_small`` is the only place a broadcast hint is given to a table whose size is not fixed by its definition: it
holds the table and hints only below a number of rows and of bytes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
#: a row in memory takes at most about so many times its bytes in Parquet
UNPACKED = 8

_OPEN: list[str] = []
_OF_APPLICATION: dict[str, str] = {}


def get_spark(app: str = "trackstrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect. Settings of the cluster (submitted, or of the active
    session) win over those; ``conf`` wins over all."""
    active = SparkSession.getActiveSession()
    builder = SparkSession.builder
    if active is None:
        builder = builder.appName(app).master(master) if master else builder.appName(app)
        first = SparkConf()
        for key, value in conf.items():
            first.set(key, value)
        SparkContext._ensure_initialized(conf=first)  # what was submitted is known to the JVM only
        given = dict(SparkConf().getAll())
    else:
        given = dict(active.sparkContext.getConf().getAll())
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # no call-site capture per column: it doubles the time to build a plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings = {key: value for key, value in settings.items() if key not in given} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def new_folder(spark: SparkSession) -> str:
    """A new folder that all executors share; removed when the JVM ends, if not before."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/trackstrata-{uuid.uuid4().hex}"
    path, files = _files(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, files = _files(spark, folder)
    files.delete(path, True)


def folder_bytes(spark: SparkSession, folder: str) -> int:
    path, files = _files(spark, folder)
    return files.getContentSummary(path).getLength()


def start_holding(spark: SparkSession) -> str:
    """Hold tables in a new folder from now on, until ``stop_holding``; the caller deletes it."""
    folder = new_folder(spark)
    _OPEN.append(folder)
    return folder


def stop_holding(folder: str) -> None:
    _OPEN.remove(folder)


@contextmanager
def holding(spark: SparkSession) -> Iterator[str]:
    """Delete the tables that operators hold inside the block when it ends: write results to their own place before."""
    folder = start_holding(spark)
    try:
        yield folder
    finally:
        stop_holding(folder)
        delete_folder(spark, folder)


def held_in(spark: SparkSession) -> str:
    """The folder of the innermost ``holding`` block, else the application's own."""
    if _OPEN:
        return _OPEN[-1]
    application = spark.sparkContext.applicationId
    if application not in _OF_APPLICATION:
        _OF_APPLICATION[application] = new_folder(spark)
    return _OF_APPLICATION[application]


def _held(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{held_in(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def hold(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from its stored rows."""
    return _held(df)[0]


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Hold ``df`` and hint a broadcast if it has at most ``rows`` rows and about ``size`` bytes; otherwise leave the join to
    the shuffle path, where adaptive execution splits skewed partitions."""
    held, path = _held(df)
    small = folder_bytes(df.sparkSession, path) * UNPACKED <= size and has_at_most(held, rows)
    return F.broadcast(held) if small else held


def has_at_most(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows
