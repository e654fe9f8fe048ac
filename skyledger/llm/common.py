"""Tables, the shared folder of the cluster, and small helpers of the operators."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skyledger.session import scratch_folder

BATCH_ROWS = 500
#: Words are what stands between these characters; the same as ``bytes.split()`` without arguments.
WORD = re.compile("[^\x20\x09-\x0d]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by Spark's reader only: the folder may be in any store that Spark reaches."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders that this driver has taken and not removed.
_FOLDERS: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of these operators in the shared one."""
    folder = scratch_folder(spark, f"llm/{name}")
    _FOLDERS.append(folder)
    return folder


def folders() -> list[str]:
    """The folders of these operators that are there, oldest first."""
    return list(_FOLDERS)


def remove(spark: SparkSession, taken: Iterable[str]) -> None:
    """Remove folders of these operators; results that still read them are lost."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for folder in list(taken):
        path = hadoop.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _FOLDERS.remove(folder)


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write a table into the shared folder and read it back: computed once, and safe from lost executors."""
    spark = df.sparkSession
    folder = scratch(spark, name)
    df.write.option("compression", codec).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


#: Applications whose workers have the modules of this package.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the modules of this package to the workers, once for an application."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    name = f"{tempfile.mkdtemp(prefix='package-')}/{package.name}-modules.zip"
    with zipfile.ZipFile(name, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    spark.sparkContext.addPyFile(name)
    _SHIPPED.add(spark.sparkContext.applicationId)


def map_rows(
    df: DataFrame, schema: str | T.StructType, work: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]
) -> DataFrame:
    """``mapInArrow`` in batches of few rows, since texts may be long.

    Spark has no limit by bytes; the session's limit by rows is lowered to ``BATCH_ROWS`` if it is higher. The modules
    of this package go to the workers by Spark's own file server, wherever the driver was started.
    """
    ship(df.sparkSession)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(rows)) <= BATCH_ROWS:
        df.sparkSession.conf.set(rows, BATCH_ROWS)
    return df.mapInArrow(work, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a simple DDL text, for batches made in tasks."""
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(),
        "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()),
        "array<string>": pa.list_(pa.string()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def batch_of(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
