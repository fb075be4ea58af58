"""Session helpers: recommended settings, shared scratch space, size checks."""

from __future__ import annotations

import gc
import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

# A side is broadcast only when its measured size stays below this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Ratings of a block in model training. A block is gathered and sorted by one task, which takes some
# 50 bytes a rating.
BLOCK_RATINGS = 6_000_000
MIN_MODEL_BLOCKS = 4
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Threads inside ``_shuffles_removed`` by session, and the setting that they found.
_LOCK, _INSIDE = Lock(), {}


def recommended_conf() -> dict[str, str]:
    """Settings the jobs are written for; none of them fixes a master or a path."""
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="shelfwise-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Gives iterative training a place to cut its lineage."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back.

    For intermediate tables with several readers: lost executors cost a re-read instead of a
    re-run, and later joins see the real size of the table. The shuffles that made it are removed
    as soon as it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffles of the commands inside when they end."""
    session = spark._jsparkSession.sessionUUID()
    with _LOCK:
        inside, before = _INSIDE.get(session, (0, spark.conf.get(CLEANUP, None)))
        _INSIDE[session] = inside + 1, before
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            inside, before = _INSIDE.pop(session)
            if inside > 1:
                _INSIDE[session] = inside - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def removed(stored: DataFrame) -> None:
    """Deletes the files of a ``staged`` table that has no more readers."""
    spark = stored.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in {file.rpartition("/")[0] for file in stored.inputFiles()}:
        path = hadoop(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def released(spark: SparkSession) -> None:
    """Lets Spark remove the shuffles and cached blocks of what nothing refers to any more. It does so
    by itself only when the driver collects its garbage, which may be after the disks are full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def compute_slots(spark: SparkSession, units: int) -> int:
    """Partitions for CPU-bound work whose input bytes are too few to guide adaptive planning."""
    return max(1, min(units, 3 * _cluster_width(spark)))


def model_blocks(spark: SparkSession, ratings: int = 0) -> int:
    """Blocks for model training, so that it can use the whole cluster and none has too many ratings.

    A vector is sent to every block that rates it, so there are no more than needed.
    """
    return max(MIN_MODEL_BLOCKS, _cluster_width(spark), math.ceil(ratings / BLOCK_RATINGS))


def _cluster_width(spark: SparkSession) -> int:
    # A cluster that grows on demand may still be small when this is asked; the number of shuffle
    # partitions then tells what the session was set up for.
    now = spark.sparkContext.defaultParallelism
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return max(now, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return now
