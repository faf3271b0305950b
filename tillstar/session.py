"""Session settings and the shared working folder."""

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(app_name="tillstar", cores=None, **extra):
    """A session for jobs, tests and the bench. On a cluster, spark-submit's settings win."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Recording the Python line of every column expression costs driver round trips.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if cores:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", os.environ.get("TILLSTAR_DRIVER_MEMORY", "8g"))
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# Shuffled bytes per task that fit an executor core's share of memory without spilling.
BYTES_PER_TASK = 256 * 1024 * 1024

# Spark's stand-in for a size it does not know is beyond this.
UNKNOWN_BYTES = 1 << 60


def partitions_for(input_bytes, least=200):
    """Shuffle partitions for a batch of this size; AQE merges those that turn out small."""
    return max(least, -(-input_bytes // BYTES_PER_TASK))


def input_bytes(df):
    """Size of the files and tables a frame reads, as far as Spark knows it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


# Whether the shuffle files of a query are removed when it ends. Otherwise they stay until the driver
# collects the garbage of its plans, which may be long after.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _set_within(confs, key, value):
    """value: of what the setting was."""
    before = [conf.get(key) for conf in confs]
    for conf, old in zip(confs, before, strict=True):
        conf.set(key, value(old))
    try:
        yield
    finally:
        for conf, old in zip(confs, before, strict=True):
            conf.set(key, old)


@contextmanager
def released_shuffles(*sessions):
    """Within, what a query shuffled is removed when it ends: for steps whose results are tables."""
    with _set_within([s.conf for s in sessions], RELEASE, lambda old: "true"):
        yield


@contextmanager
def sized_shuffles(df, *sessions, partitions=None):
    """Within, shuffles have partitions of a size that fits a task for what the frame reads, and their
    files go with the query.

    Never fewer than the session has set. partitions: a number to use instead.
    """
    sessions = list({id(s): s for s in (df.sparkSession, *sessions)}.values())

    def sized(old):
        return str(partitions or partitions_for(input_bytes(df), int(old)))

    with _set_within([s.conf for s in sessions], "spark.sql.shuffle.partitions", sized), released_shuffles(*sessions):
        yield


def shared_folder(spark):
    """The folder for checkpoints and working tables.

    The cluster names it in spark.checkpoint.dir. Only a local session without the
    setting (a test) gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tillstar-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder
