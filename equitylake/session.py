"""Session settings the engine relies on, and the shared scratch location."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

# Settings every job here assumes. Applied to an existing session too, since
# they are all runtime-settable SQL confs.
SESSION_CONF = {
    # Stored instants are UTC; the DuckDB oracle is compared in UTC as well.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed ones, and turn
    # a sort-merge join into a broadcast once the real build size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lists of symbols are looked up in dictionaries and Bloom filters of row
    # groups up to this length (beyond it only by smallest and largest).
    "spark.sql.parquet.pushdown.inFilterThreshold": "200",
    # Path-borne values (symbol=..., part=...) stay text; callers cast them.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    # Listing a landing zone with thousands of directories: by default Spark
    # starts one listing task per directory (up to 10,000), which costs more
    # than the listing itself. Two tasks per core keeps it parallel on a
    # cluster without flooding the scheduler.
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(max(8, 2 * cores)))
    return spark


def get_session(
    master: str | None = None,
    app_name: str = "equitylake",
    shuffle_partitions: int | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    ``master`` defaults to whatever the launcher provides; local runs pass
    ``local[N]``. The UI stays off: nothing here reads it.
    """
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # Checkpoint files go when their frame is gone (read once, when the context starts).
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    # Concurrent jobs share the executors instead of queueing (pools are named where jobs start).
    builder = builder.config("spark.scheduler.mode", "FAIR")
    builder = builder.config("spark.driver.memory", os.environ.get("EQUITYLAKE_DRIVER_MEMORY", "8g"))
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master (tests, single-node benches) may fall back to a
    private temporary folder; on a cluster a node-local path would be
    invisible to the other executors, so its absence is an error.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="equitylake-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    sc.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/equitylake/{label}-{uuid.uuid4().hex[:12]}"


def side_by_side(spark: SparkSession, jobs: Mapping[str, Callable[[], Result]], parallel: int | None = None) -> dict[str, Result]:
    """Run independent jobs as concurrent Spark jobs, each in a scheduler pool of its name.

    Threads take over the caller's job properties (group, description). Under
    the FAIR scheduler the pools share the executors, so no job's stages wait
    for all of another's.
    """
    def run(name: str, job: Callable[[], Result]) -> Result:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return job()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, parallel or len(jobs))) as threads:
        # A target per job: each takes a copy of the properties as they are here.
        futures = {name: threads.submit(inheritable_thread_target(spark)(run), name, job) for name, job in jobs.items()}
        return {name: future.result() for name, future in futures.items()}
