"""Market summaries of the schedule, and its frozen months."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.functions.dates import month_start, weekday_label
from skyledger.operators.shape import quoted
from skyledger.operators.sums import sum_or_zero


def _departures(schedule: DataFrame, nature: str, airports: Sequence[str]) -> DataFrame:
    return schedule.where(
        (F.col("Tipo") == L.DEPARTURE) & (F.col("Natureza") == nature) & quoted("Aero Icao").isin(list(airports))
    )


def international_daily(
    schedule: DataFrame, extracted: date | Column, airports: Sequence[str] = L.INTERNATIONAL_AIRPORTS
) -> DataFrame:
    """One row per international departure from the watched airports; rows without a date go."""
    rows = _departures(schedule, L.INTERNATIONAL, airports).where(F.col("Data").isNotNull())
    return rows.select(
        F.col("Data").alias("data_local"),
        weekday_label(F.col("Data")).alias("dia_semana"),
        month_start(F.col("Data")).alias("mes_ref"),
        *[quoted(name).alias(new) for name, new in L.INTERNATIONAL_NAMES.items()],
        F.col("Seats").alias("assentos"),
        F.col("Group").alias("tipo"),
        F.col("Hora").alias("hora_local"),
        (extracted if isinstance(extracted, Column) else F.lit(extracted)).alias("data_extracao"),
    )


def domestic_monthly(
    schedule: DataFrame, extracted: date | Column, airports: Sequence[str] = L.DOMESTIC_AIRPORTS
) -> DataFrame:
    """Departures and seats per month, route and airline; groups with null parts stay."""
    rows = _departures(schedule, L.DOMESTIC, airports)
    keys = [month_start(F.col("Data")).alias("mes_ref")] + [quoted(n).alias(new) for n, new in L.DOMESTIC_NAMES.items()]
    return rows.groupBy(*keys).agg(
        F.count("Voo").alias("partidas_mes"),
        sum_or_zero(F.coalesce(F.col("Seats"), F.lit(0))).alias("assentos_totais_mes"),
    ).withColumn("data_extracao", extracted if isinstance(extracted, Column) else F.lit(extracted))


def month_slice(table: DataFrame, month: date, column: str = "Data") -> DataFrame:
    """The rows of one calendar month, as a half-open range that a scan can use."""
    following = date(month.year + month.month // 12, month.month % 12 + 1, 1)
    return table.where((quoted(column) >= F.lit(month)) & (quoted(column) < F.lit(following)))


def unfrozen_month(table: DataFrame, manifest: DataFrame, month: date, column: str = "Data") -> DataFrame:
    """The rows of a month with their manifest key; none if the month has been frozen before."""
    key = f"{L.FROZEN_PREFIX}{month:%Y-%m}"
    frozen = manifest.where(F.col("key") == key)
    return month_slice(table, month, column).withColumn("key", F.lit(key)).where(~frozen.exists())
