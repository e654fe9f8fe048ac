"""What lies in the landing area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.text import base_name, fare_kind, period_in_name
from skyledger.operators.dedup import keep_first
from skyledger.operators.lookup import lookup_join


def dashed(name: Column) -> Column:
    """Whether a file is named ``2026-01`` rather than ``202601``: this form goes first, whatever its time."""
    return F.lower(base_name(name)).rlike(r"\d{4}-\d{2}")


def unseen(files: DataFrame, seen: DataFrame) -> DataFrame:
    """Files whose path, time and size have not been seen; both have ``path, modified, bytes``. Nothing is opened for this."""
    known = seen.select("path", "modified", "bytes")
    return lookup_join(files, known, {name: name for name in known.columns}, "left_anti", null_safe=True)


def not_older(found: DataFrame, index: DataFrame) -> DataFrame:
    """Discovered files (``folder, year, month, sha256, modified, dashed``) that what has been landed for their month does not
    go before: a dashed name first, then the newest time. Adds ``known``: the content has been landed."""
    keys = ["folder", "year", "month"]
    before = index.select(*keys, F.col("impressao").alias("_content"), F.struct(F.coalesce("dashed", F.lit(False)), "modified").alias("_order"))
    both = lookup_join(found, before, {key: key for key in keys})
    # null, an unknown time, is less than any other
    late = F.col("_order").isNull() | (F.struct(F.coalesce("dashed", F.lit(False)), "modified") >= F.col("_order"))
    return both.where(late).withColumn("known", F.coalesce(F.col("_content") == F.col("sha256"), F.lit(False))).drop("_content", "_order")


def discover(files: DataFrame, path: str = "path") -> DataFrame:
    """The movement and fare files among ``files``, with kind, year and month: one per kind and month.

    ``2026-01`` in a name goes before ``202601``, then the newest ``modificationTime`` where the files have
    one, then the path; other columns of the files are kept.
    """
    name = F.lower(base_name(F.col(path)))
    movement = F.when(name.endswith(".txt"), F.regexp_extract(name, r"^(basica|combinada)\d{4}-?\d{2}", 1))
    fares = fare_kind(F.col(path))
    period = period_in_name(F.col(path))
    found = files.withColumns({
        "kind": F.when(movement != "", movement).when(fares.isNotNull(), F.concat(F.lit("tarifas/"), fares)),
        "year": F.year(period), "month": F.month(period), "_plain": ~dashed(F.col(path)),
    }).where(F.col("kind").isNotNull() & F.col("year").isNotNull())
    age = -F.unix_micros("modificationTime") if "modificationTime" in files.columns else F.lit(0)
    order = ["_plain", "_age", path, *[name for name in ("path",) if name in files.columns and name != path]]
    return keep_first(found.withColumn("_age", age), ["kind", "year", "month"], order).drop("_plain", "_age")
