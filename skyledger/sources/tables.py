"""Readers of delimited text, rates, manifests and processed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.numbers import null_tokens
from skyledger.functions.text import period_in_name
from skyledger.operators.shape import quoted, trimmed_header


def with_period(df: DataFrame, name: str = "file") -> DataFrame:
    """Adds the year and month named in the file."""
    period = period_in_name(F.col(name))
    return df.withColumns({"year": F.year(period), "month": F.month(period)})


def normalised(df: DataFrame) -> DataFrame:
    """Null for every text that means "no value"."""
    return df.select(*[
        null_tokens(quoted(field.name)).alias(field.name) if field.dataType.simpleString() == "string" else quoted(field.name)
        for field in df.schema
    ])


def delimited(spark: SparkSession, path: str | list[str], separator: str = ";") -> DataFrame:
    """UTF-8 text with a header, every column as text, with the name of the file.

    All files must have the header of the first one: a file with other columns stops the read
    instead of being taken for something else.
    """
    frame = spark.read.csv(path, sep=separator, header=True, enforceSchema=False)
    return normalised(trimmed_header(frame).withColumn("file", F.col("_metadata.file_path")))


def schedule_file(spark: SparkSession, path: str) -> DataFrame:
    """The schedule file: a line of text first, the header below it."""
    header = spark.read.text(path).limit(2).collect()[1][0]
    names = [name.strip().strip('"') for name in header.split(";")]
    fields = ", ".join(f"`{name}` string" for name in names)
    frame = spark.read.csv(path, schema=fields, sep=";", header=True, enforceSchema=True)
    return normalised(frame.where(~F.trim(quoted(names[0])).eqNullSafe(names[0])))


def rates_file(spark: SparkSession, path: str) -> DataFrame:
    """Rate rows with their position in the file."""
    return delimited(spark, path).select("KeyDolar", "taxa", F.monotonically_increasing_id().alias("line"))


def rate_payload(documents: DataFrame, column: str = "value") -> DataFrame:
    """Month key and rate of each item of a rate service answer; items without a month or value go."""
    items = F.from_json(F.col(column), "struct<value: array<struct<VALDATA: string, VALVALOR: double>>>")
    rows = documents.select(F.explode(items.getField("value")).alias("item")).select("item.*")
    year, month = F.substring("VALDATA", 1, 4).try_cast("int"), F.substring("VALDATA", 6, 2).try_cast("int")
    dated = rows.where(year.isNotNull() & month.isNotNull() & F.col("VALVALOR").isNotNull())
    return dated.select(
        F.format_string("%d - %02d", year, month).alias("rate_key"), F.col("VALVALOR").cast("decimal(18,6)").alias("rate")
    )


def table(spark: SparkSession, path: str) -> DataFrame:
    """A processed table."""
    return spark.read.parquet(path)
