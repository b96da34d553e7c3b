"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

IN_FLIGHT = 4    # jobs that run at the same time, such as models that are fitted


def build_session(master: str = "local[*]", app: str = "plumbline", shuffle_partitions: int = 8,
                  memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and the local bench; a cluster brings its own."""
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Without this every column expression records its Python call site.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names; a temporary one only where driver and executors are one process."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None and re.fullmatch(r"local(\[.*\])?", context.master):
        folder = tempfile.mkdtemp(prefix="plumbline-")
    if folder is not None and context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def materialised(df: DataFrame, spread: bool = True) -> DataFrame:
    """Compute ``df`` once for the several passes that follow.

    With a checkpoint folder the rows are written there, so a lost executor
    costs a re-read and not the shuffles behind it. Without one the rows are
    persisted, which recomputes lost blocks from lineage. Rows that sit in
    fewer partitions than there are cores (one small file) are spread when read, unless ``spread`` is false.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if checkpoint_dir(df.sparkSession) is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    written = df.checkpoint(eager=True)
    if not spread or written.rdd.getNumPartitions() * 2 > cores:
        return written
    return written.repartition(cores)


def side_by_side(jobs: Sequence[Callable[[], object]], df: DataFrame, most: int = IN_FLIGHT) -> list:
    """Results of ``jobs`` in order, at most ``most`` of them running at once, each in a scheduler pool of its own.

    The first failure cancels what still runs on the cluster, and is raised.
    """
    context = df.sparkSession.sparkContext
    tag = f"side-by-side-{uuid.uuid4().hex}"

    def start(number: int, job: Callable[[], object]):
        context.setLocalProperty("spark.scheduler.pool", f"model-{number % most}")
        context.addJobTag(tag)
        try:
            return job()
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, min(most, len(jobs)))) as pool:
        running = [pool.submit(inheritable_thread_target(df.sparkSession)(start), i, job) for i, job in enumerate(jobs)]
        done, _ = wait(running, return_when=FIRST_EXCEPTION)
        if any(r.exception() for r in done):
            for r in running:
                r.cancel()
            context.cancelJobsWithTag(tag)
            raise next(r.exception() for r in done if r.exception())
        return [r.result() for r in running]
