"""Session settings, the shared working folder and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: The JVM does not compile methods beyond 8000 bytes. Wide projections are over
#: it when generated as one method; with this limit Spark splits them instead.
COMPILED_METHOD_LIMIT = {"spark.sql.codegen.hugeMethodLimit": "8000"}

#: For tables of texts and hashes: hex digits take half the space that Spark's default leaves them.
TEXT_CODEC = "zstd"

#: A side is broadcast only when rows x bytes stay under this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def cluster_conf(input_bytes: int, partition_bytes: int = 1 << 30) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of history.

    A shuffle has as many blocks as map tasks times partitions, so both sides
    are kept coarse: partitions of about 1 GB, which sorts and windows spill
    when they must, over scan tasks of 512 MB. AQE merges what turns out small
    and splits skewed joins.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
        **COMPILED_METHOD_LIMIT,
    }


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks, with its own working folder."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stayledger")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config(CHECKPOINT_DIR, tempfile.mkdtemp(prefix="stayledger-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="stayledger-warehouse-"))
    )
    for key, value in {**COMPILED_METHOD_LIMIT, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without the setting gets a folder of this machine.
    """
    context = spark.sparkContext
    folder = context.getConf().get(CHECKPOINT_DIR) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stayledger-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


#: The folder that a running job's intermediate tables share, see ``scratch``; each thread has its own.
_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the working folder that no other run uses."""
    folder = _job_folder.get() or work_folder(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession):
    """Intermediate tables made inside stand in one folder, which is removed at the end.

    For a job that keeps its results elsewhere. Jobs may stand in others.
    """
    folder = new_path(spark, "job")
    outer = _job_folder.set(folder)
    try:
        yield folder
    finally:
        _job_folder.reset(outer)
        remove_folder(spark, folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Spark's own setting: a query's shuffle files go when it has ended, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writes_lock = threading.Lock()
_writes: dict[str, list] = {}  # by session: writes that run, and the setting before them


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Writes inside leave no shuffle files; several threads may write at once."""
    key = spark._jsparkSession.sessionUUID()
    with _writes_lock:
        running = _writes.setdefault(key, [0, spark.conf.get(SHUFFLE_CLEANUP, None)])
        running[0] += 1
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _writes_lock:
            running[0] -= 1
            if not running[0]:
                _, before = _writes.pop(key)
                if before is None:
                    spark.conf.unset(SHUFFLE_CLEANUP)
                else:
                    spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str, codec: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the working folder and return a scan of it.

    Cuts the lineage with a table that outlives executors, and later reads
    still prune columns and push filters. ``codec``: another compression than the session's;
    ``path``: another place than a new one of this name.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    with shuffles_removed(spark):
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, written once; the intermediate tables that it writes on the way are removed."""
    path = new_path(spark, name)
    with scratch(spark), shuffles_removed(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Give a session the settings that it does not have by its own start."""
    have = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in conf.items():
        if key not in have and spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def materialize_all(frames: dict[str, DataFrame], at_once: int = 4) -> dict[str, DataFrame]:
    """Write independent results as tables, several jobs at a time so that the
    last tasks of one do not leave the cluster idle."""
    with ThreadPoolExecutor(at_once) as pool:
        written = {name: pool.submit(copy_context().run, materialize, df, name) for name, df in frames.items()}
        return {name: table.result() for name, table in written.items()}


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int = 256) -> DataFrame:
    """Mark ``df`` for broadcast when its counted size is under the limit;
    beyond it Spark chooses a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_LIMIT_BYTES else df
