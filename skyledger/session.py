"""Session settings the plans rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# The code of a stage is one method; with many columns it is longer than the JVM compiles and runs interpreted. Beyond so many
# columns, and where a method is longer than that, each projection becomes several short methods.
WIDE_ROWS = {"spark.sql.codegen.maxFields": "56", "spark.sql.codegen.hugeMethodLimit": "8000"}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # wide rows are not sorted for a join whose other side fits in memory, partition by partition
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    **WIDE_ROWS,
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "skyledger", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` takes further ``spark.*`` settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def short_methods(spark: SparkSession) -> None:
    """The settings for wide rows, in a session that was built without them."""
    for key, value in WIDE_ROWS.items():
        spark.conf.set(key, value)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; a local session without that setting gets a temporary one."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="skyledger-", dir="/tmp"))
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, named by the cluster in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set: name a folder shared by all executors")
    return folder
