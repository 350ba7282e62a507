"""Session set-up and the shared folder used for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Options every job wants.  Join strategy, partition coalescing and skew
# splitting are left to adaptive execution, which works from measured sizes.
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
RUNTIME_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A task that joins and folds holds up to 50 bytes for each (compressed) byte it reads.
    ADVISORY: "8m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even if the split costs one more shuffle later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def apply_runtime_options(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_OPTIONS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


@contextmanager
def file_sizes(spark: SparkSession) -> Iterator[None]:
    """For writes that rebalance: a partition becomes a file, so it may be larger than a step in between."""
    small = spark.conf.get(ADVISORY) == RUNTIME_OPTIONS[ADVISORY]  # else the session's own choice
    if small:
        spark.conf.set(ADVISORY, "64m")
    try:
        yield
    finally:
        if small:
            spark.conf.set(ADVISORY, RUNTIME_OPTIONS[ADVISORY])


MB = 1 << 20
# Small partitions as long as there are few, larger ones when their number would be a burden.
SMALL_SHUFFLE_BYTES, SMALL_SHUFFLES, SHUFFLE_INPUT_BYTES = 8 * MB, 4096, 256 * MB
SMALL_SCAN_BYTES, SMALL_SCANS = 32 * MB, 8192
SCAN_BYTES, LARGEST_SCAN_BYTES, SCAN_TASKS = 128 * MB, 512 * MB, 200_000
OWN_PARTITIONS = "spark.daymill.ownShufflePartitions"
SET_PARTITIONS = "spark.daymill.setShufflePartitions"


def size_for_input(spark: SparkSession, input_bytes: int) -> None:
    """Set shuffle partitions and scan splits for a job that reads ``input_bytes``.

    Adaptive execution merges partitions that turn out small but never makes
    more than it started with, so the start has to fit the input.  The
    session's own number is the lower bound.
    """
    now = spark.conf.get("spark.sql.shuffle.partitions")
    if now != spark.conf.get(SET_PARTITIONS, None):  # first call, or set by the user since
        spark.conf.set(OWN_PARTITIONS, now)
    own = int(spark.conf.get(OWN_PARTITIONS))
    small = min(SMALL_SHUFFLES, -(-input_bytes // SMALL_SHUFFLE_BYTES))
    wanted = str(max(own, small, -(-input_bytes // SHUFFLE_INPUT_BYTES)))
    spark.conf.set("spark.sql.shuffle.partitions", wanted)
    spark.conf.set(SET_PARTITIONS, wanted)
    split = min(SCAN_BYTES, max(SMALL_SCAN_BYTES, input_bytes // SMALL_SCANS))
    split = min(LARGEST_SCAN_BYTES, max(split, input_bytes // SCAN_TASKS))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))


def stored_bytes(df) -> int:
    """Size of the files behind a frame that was just read, from their listing."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "daymill") -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="daymill-wh-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_runtime_options(spark)


LOCAL_SHARED_DIR = "spark.daymill.localSharedDir"


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can see: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting falls back to a temporary
    folder; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_SHARED_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="daymill-")
    spark.conf.set(LOCAL_SHARED_DIR, folder)
    return folder


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is written yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
