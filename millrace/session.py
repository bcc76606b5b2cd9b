"""Session settings, scratch space and object-store access."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Of compressed columns, which take some thirty times as much as rows of messages in a task's memory.
BYTES_PER_SHUFFLE_PARTITION = 8 * 1024 * 1024


def app_session(name: str, shuffle_partitions: int | None = None, master: str | None = None,
                packages: str | None = None, **settings: str) -> SparkSession:
    """Session of a standalone application.

    ``shuffle_partitions`` also fixes the number of state partitions of every
    stateful query and cannot change once that query has a checkpoint.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    if packages:
        builder = builder.config("spark.jars.packages", packages)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def engine_session(spark: SparkSession, input_bytes: int = 0, state_partitions: int | None = None,
                   **settings: str) -> SparkSession:
    """A session on the same cluster, with the caller's settings and the engine's own.

    ``state_partitions`` counts where the caller has configured none.

    Kept apart from the caller's session because the time zone and the state settings
    must hold for these dataflows and for nothing else.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)

    session.conf.set("spark.sql.session.timeZone", "UTC")
    # State is never dropped (no watermark), so it has to live outside the heap.
    _default(session, "spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    _default(session, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # Counting the rows of a store costs a lookup per write.
    _default(session, "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")

    # State partitions are the configured number, as a checkpoint fixes them for good.
    if state_partitions:
        _default(session, "spark.sql.shuffle.partitions", str(state_partitions))
    # Batch shuffles start from the input size and are coalesced at run time.
    wanted = -(-input_bytes // BYTES_PER_SHUFFLE_PARTITION)
    partitions = max(int(session.conf.get("spark.sql.shuffle.partitions")), wanted)
    _default(session, "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))

    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def _default(session: SparkSession, key: str, value: str) -> None:
    if session.conf.get(key, None) is None:
        session.conf.set(key, value)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder path on storage that every executor reaches."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="millrace-")
    return f"{root.rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, files) below a path on any Hadoop file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    summary = file_system.getContentSummary(jvm_path)
    return summary.getLength(), summary.getFileCount()


def content_identity(spark: SparkSession, path: str) -> str:
    """Changes with any file below a path: from names, sizes and modification times, not contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return "/".join(map(str, files.agg(F.count(F.lit(1)), F.sum(one)).first()))


def use_object_store(spark: SparkSession, endpoint: str, credentials_provider: str | None = None,
                     path_style: bool = True, tls: bool = False) -> None:
    """Let ``s3a://`` paths reach an S3-compatible store (needs the hadoop-aws package).

    Secrets come from the named credential provider class, or from wherever the store's
    default chain finds them (environment, instance, Hadoop configuration); never from here.
    """
    hadoop = spark._jsc.hadoopConfiguration()
    if credentials_provider:
        hadoop.set("fs.s3a.aws.credentials.provider", credentials_provider)
    for key, value in {
        "endpoint": endpoint,
        "path.style.access": str(path_style).lower(),
        "connection.ssl.enabled": str(tls).lower(),
    }.items():
        hadoop.set(f"fs.s3a.{key}", value)
