"""Session settings the plans rely on, and where durable intermediate files go."""

import re
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Table files are compressed: judge what may be broadcast by about its size in memory.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.adaptive.enabled": "true",
    # Keys of streams lie on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the next step then needs a shuffle it would else save.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def split_hot_keys(spark: SparkSession) -> None:
    """Let joins split a hot key even where rows must then be shuffled again, in any session.

    For operators that collapse rows where a join has left them: there a hot key is not split by
    default.
    """
    for key in ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(key, SETTINGS[key])


# Most bytes a task reads of a file or a shuffle. Lines take 30 to 50 bytes compressed and several
# hundred in the sorts and hash tables of one task, so the usual 64 and 128 MB make these spill.
TASK_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}
#: Most bytes of a batch of rows that a task passes to Python at once, for steps on whole texts.
BATCH_BYTES = 4 << 20
_UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}


def _bytes(size: str) -> int:
    """A size as settings give it: 1024, 64MB, 16m."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << _UNITS[unit]


def broadcast_bytes(spark: SparkSession) -> int:
    """Up to what size Spark broadcasts a side of a join; -1 turns that off."""
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return -1 if size.startswith("-") else _bytes(size)


def small_tasks(spark: SparkSession) -> None:
    """Lower the bytes a task reads to ``TASK_BYTES``; sessions with smaller tasks keep theirs."""
    for key, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))


@contextmanager
def small_batches(spark: SparkSession):
    """Pass rows to Python a few MB at a time: a batch of long texts is held several times over."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(_bytes(before), BATCH_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def full_files(spark: SparkSession):
    """Let streams started inside gather what a batch writes into files as large as a task may read.

    By default adaptive execution leaves a file for each core, however little it holds; streams
    further on that take so many files a batch then have a batch for every few of them.
    """
    key = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def open_files(spark: SparkSession, most: int):
    """Let tasks that write by folder keep ``most`` files open; with more folders they sort what is left."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(most, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Remove the shuffle files of each write made inside once it is done, not when Java collects garbage.

    For stages that hand over written tables; a table run twice inside would be shuffled again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Where intermediates go in a session without ``spark.checkpoint.dir``: for tests on one machine.
WORK_DIR = "orderflow.work.dir"


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory for written intermediates, stream checkpoints included.

    It lies in the shared folder named by ``spark.checkpoint.dir``. A session without that
    setting must name a folder in ``orderflow.work.dir``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(WORK_DIR, None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def counters_kept(spark: SparkSession):
    """Keep observed counts of jobs that turn out to write nothing.

    Adaptive execution replaces a plan by an empty one once a stage has no rows, and the
    counters in the plan go with it.
    """
    key = "spark.sql.adaptive.optimizer.excludedRules"
    before = spark.conf.get(key, "")
    rule = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    spark.conf.set(key, f"{before},{rule}" if before else rule)
    try:
        yield
    finally:
        spark.conf.set(key, before)
