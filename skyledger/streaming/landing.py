"""Land new files with Structured Streaming, each file once.

The file source remembers paths, so landing folders should hold every publication under a path of
its own (for instance with its fingerprint). Whether a content is new is decided by the manifest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.plans.runs import land
from skyledger.session import shared_folder

BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def land_new_files(
    spark: SparkSession, inbox: str, root: str, checkpoint: str | None = None, pattern: str | None = None
):
    """Run over the files that have arrived since the last run, then stop; returns the query.

    A batch does what a batch run does, so a batch that runs again after a failure changes nothing.
    """
    reader = spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)

    def land_batch(batch: DataFrame, _: int) -> None:
        land(batch.sparkSession, root, batch)

    place = checkpoint or f"{shared_folder(spark)}/skyledger-landing"
    return (
        reader.load(inbox).writeStream.foreachBatch(land_batch).option("checkpointLocation", place).trigger(availableNow=True).start()
    )
