"""What runs have counted, month by month, and months that lose matches from one run to the next."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.operators.shape import quoted

HISTORY = "run timestamp, year int, month int, rows bigint, with_fare bigint, departures bigint"
#: A share of rows with a fare that is lower by this is told.
TOLERANCE = 0.01


def metrics(mart: DataFrame, run: datetime) -> DataFrame:
    """Rows, rows with a fare, and departures of each month; reads three columns."""
    counted = mart.groupBy("year", "month").agg(
        F.count("*").alias("rows"), F.count(quoted("Tkt Avg")).alias("with_fare"), F.count_if(F.col("Tipo") == L.DEPARTURE).alias("departures"))
    return counted.select(F.lit(run).alias("run"), "year", "month", "rows", "with_fare", "departures")


def note(mart: DataFrame, path: str, run: datetime) -> None:
    """Add the counts of a run to the stored history."""
    metrics(mart, run).coalesce(1).write.mode("append").parquet(path)


def history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(path)


def compared(runs: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Every month of every run with the share of rows that have a fare, the share in the run before, and whether it
    ``fell``: lower by more than ``tolerance``, or fewer rows."""
    before = Window.partitionBy("year", "month").orderBy("run")  # as many rows as a month had runs
    share = F.col("with_fare") / F.nullif(F.col("rows"), F.lit(0))
    both = runs.withColumn("share", share).withColumns({"share_before": F.lag("share").over(before), "rows_before": F.lag("rows").over(before)})
    lower = (F.col("share_before") - F.coalesce("share", F.lit(0.0)) > tolerance) | (F.col("rows") < F.col("rows_before"))
    return both.withColumn("fell", F.coalesce(lower, F.lit(False))).drop("rows_before")
