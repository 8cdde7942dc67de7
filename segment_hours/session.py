"""Session construction and the scratch location shared by the executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from segment_hours.sources.files import input_bytes

# Settings every job of this package relies on. Sizes (memory, cores, shuffle partitions) belong
# to the cluster and are passed in by the caller.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app="segment-hours", master=None, stages=None, **conf):
    """Session with the package settings; ``conf`` keys use ``__`` where Spark uses a dot.

    ``stages`` is the folder for intermediate tables, shared by the driver and all executors.
    """
    builder = SparkSession.builder.appName(app)
    if stages:
        builder = builder.config("spark.checkpoint.dir", str(stages))
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


_LOCAL_ROOT = []


def checkpoint_root(spark):
    """The cluster's ``spark.checkpoint.dir``; where it is unset, a temporary folder of this process in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="segment-hours-"))
    return _LOCAL_ROOT[0]


def scratch_path(spark, name):
    """A path no other run uses, under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, name="stage"):
    """Write ``df`` to the shared folder and read it back, so that lost executors re-read files."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Stored bytes of input whose rows one task holds in its aggregates.
TASK_BYTES = 8 << 20


def sized(df, *keys):
    """Shuffles by ``keys`` into partitions of about ``TASK_BYTES`` of the files that ``df`` reads; left alone where the session has as many.

    For aggregates with nearly as many groups as rows: memory of a task then stays the same however large the input is.
    """
    parts = -(-input_bytes(df) // TASK_BYTES)
    return df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def spread(df, *keys):
    """Shuffles by ``keys`` into a fixed number of partitions, which AQE does not merge.

    For small rows that each stand for much work after the shuffle (an archive to read, a day to
    unfold): merged by their size they would leave that work to one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
