"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import RDD, StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lagline", cores: str | int = "*") -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written tables, under the cluster's shared checkpoint folder.

    Only a local master without that setting falls back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


# Spark's setting: a query's shuffle files go when it has ended.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITERS: list[str | None] = []  # one entry for each write that runs; the first holds what the setting was before
_WRITERS_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside give their shuffle files back as they end: what they were for has been written by then."""
    with _WRITERS_LOCK:
        if not _WRITERS:
            _WRITERS.append(spark.conf.get(FREE_SHUFFLES, None))
            spark.conf.set(FREE_SHUFFLES, "true")
        _WRITERS.append(None)
    try:
        yield
    finally:
        with _WRITERS_LOCK:
            _WRITERS.pop()
            if len(_WRITERS) == 1:
                before = _WRITERS.pop()
                spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result that one query reads several times, and read it back.

    Unlike a checkpoint, which remembers how its rows were dealt, equal reads of a table share their scans and exchanges.
    """
    path = work_dir(df.sparkSession, purpose)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_KEPT: list[DataFrame | RDD] = []


def settle(df: DataFrame) -> DataFrame:
    """Keep a frame that several jobs read.

    Where the cluster names a shared checkpoint folder the frame is written there first, so a lost executor costs a
    read and not the whole lineage. `release` frees all frames that are kept.
    """
    if df.sparkSession.conf.get("spark.checkpoint.dir", None):
        df = df.checkpoint()
    _KEPT.append(df.persist(StorageLevel.MEMORY_AND_DISK))
    return df


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`settle` of rows whose order and partitions do not matter: the shared folder has them once, as compressed columns."""
    return written(df, purpose) if df.sparkSession.conf.get("spark.checkpoint.dir", None) else settle(df)


def hold(rows: RDD | DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> RDD | DataFrame:
    """Keep what several jobs read in another form than a frame, or a part of a frame that is kept; `release` frees it."""
    _KEPT.append(rows.persist(level))
    return rows


def at_once(spark: SparkSession, work: Callable, items: Sequence) -> list:
    """`work` of each item, in their order, from a thread each: short jobs of one fill the cores that those of another leave."""
    if len(items) < 2:
        return [work(x) for x in items]
    with ThreadPool(len(items)) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, 1)


def release() -> None:
    """Free every frame that `settle` has kept, and what `hold` has; frames freed before are not touched."""
    while _KEPT:
        _KEPT.pop().unpersist()
