"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job of this package relies on. ANSI mode and AQE stay at their
# Spark 4 defaults (on); nothing here depends on the size of the data.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # a payload with a repeated key keeps the last value, as JSON parsers usually do
    "spark.sql.variant.allowDuplicateKeys": "true",
    # checkpoint files go once no frame refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # streaming dedup keeps its state on disk instead of the executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


MB = 1024 * 1024
TASK_BYTES = 512 * MB
LEAST_PARTITIONS = 200
# A task that writes a few folders keeps a file of each open instead of sorting its rows by folder; beyond that it sorts.
UNSORTED_WRITES = {"spark.sql.maxConcurrentOutputFileWriters": "8"}


def sizing(input_bytes: int) -> dict[str, str]:
    """Partition settings for a job over ``input_bytes``: about 512 MB per task at every size.

    AQE merges small shuffle partitions but never adds any, so the starting number has to
    fit the data.
    """
    partitions = max(-(-input_bytes // TASK_BYTES), LEAST_PARTITIONS)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
    }


def listed_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files below the paths, from their listing; no file is read. Absent paths
    count nothing."""
    total = 0
    for path in paths:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        try:
            row = files.load(path).agg(F.sum("length").alias("bytes")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        total += row.bytes or 0
    return total


def size_session(spark: SparkSession, *paths: str) -> int:
    """Set the partition settings of the session for a job over the paths; returns their bytes."""
    found = listed_bytes(spark, *paths)
    for key, value in sizing(found).items():
        spark.conf.set(key, value)
    return found


def build_session(
    app_name: str, master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Create (or get) a session with the job settings; extra settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = sizing(input_bytes) if input_bytes else {}
    for key, value in {**JOB_CONF, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def with_settings(spark: SparkSession, **conf: str) -> SparkSession:
    """A session with the settings of this one and further ones. Frames that are read through it run under them."""
    session = spark.newSession()
    for key, value in {**spark.conf.getAll, **conf}.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder, because there
    the driver and the executors are one process.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="shoreline-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused between runs."""
    return f"{shared_folder(spark).rstrip('/')}/shoreline-{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared folder, so lost executors cost no recompute."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
