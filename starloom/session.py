"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job of this library wants.  They only let Spark
# re-plan from measured shuffle sizes; none of them depends on the data volume.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where the split costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # hash join instead of sorting both sides where every partition is known to fit
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # bloom filter from a small join side into the scan of a large one
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "starloom", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and single-node runs; on a cluster use spark-submit settings."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    return apply_runtime_conf(spark)


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="starloom-")


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Without that setting a local session gets a temporary folder of its own; a
    cluster session is refused, because a machine-local folder would be lost
    with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_scratch()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder for one run."""
    return f"{scratch_root(spark)}/starloom/{name}-{uuid.uuid4().hex}"


def _estimate(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's estimate of ``df`` (an upper bound, from file sizes) is below the session's broadcast threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return _estimate(df) <= limit


# Fixed value: bytes of files, by the planner's estimate, that are worth a task of their own.
TASK_BYTES = 1 << 18


def spread(df: DataFrame) -> DataFrame:
    """``df``, a scan, dealt over more tasks where its files make few of them.

    Spark cuts files into parts of some MB, and a parquet file of one row group not at all; the work on a row costs more
    than reading it.  No more tasks than cores, and none for less than ``TASK_BYTES``.
    """
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, _estimate(df) // TASK_BYTES)
    return df.repartition(tasks) if tasks > 1 and df.rdd.getNumPartitions() < tasks else df


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store Spark writes to; an absent one is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def exclusive(spark: SparkSession, path: str, lease_seconds: float) -> Iterator[bool]:
    """Whether this run alone holds the file ``path``, which it creates and in the end deletes.

    Rests on the exclusive create of the store.  A file older than the lease is left from a run that died, and is taken
    over.
    """
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = file.getFileSystem(spark._jsc.hadoopConfiguration())

    def create() -> bool:
        try:
            store.create(file, False).close()
        except Py4JJavaError:
            if store.exists(file):
                return False
            raise
        return True

    def made() -> int | None:
        return store.getFileStatus(file).getModificationTime() if store.exists(file) else None

    held = create()
    if not held and (since := made()) is not None and time.time() - since / 1000 > lease_seconds:
        store.delete(file, False)
        held = create()
    since = made() if held else None
    try:
        yield held
    finally:
        # not that of a run that has taken over
        if held and made() == since:
            store.delete(file, False)


def stage(df: DataFrame, name: str, scratch: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch area and read it back.

    ``scratch`` is the folder of a run that deletes it in the end; without it
    the folder stays until the scratch area is cleared.

    Cuts the lineage in a way that survives lost executors, computes a plan
    that forks into several outputs once, and gives the planner the true size
    of the result, so the later choice between broadcast and shuffle rests on
    a measured size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name) if scratch is None else f"{scratch}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
