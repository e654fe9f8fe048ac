"""Months to years, years to stacks, and the running year with its future flights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.operators.lookup import lookup_join
from skyledger.operators.shape import align, quoted


def year_table(mart: DataFrame, year: int) -> DataFrame:
    """All months of one year; a partition filter, nothing is moved."""
    return mart.where(F.col("year") == year)


def month_completeness(mart: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """Months present per year and whether all twelve are there."""
    months = mart.select(F.col(year).alias("year"), F.col(month).alias("month")).groupBy("year", "month").agg(
        F.count("*").alias("rows")
    )
    return months.groupBy("year").agg(
        F.count("*").alias("months"), F.min("month").alias("first"), F.max("month").alias("last"), F.sum("rows").alias("rows")
    ).withColumn("complete", F.col("months") == 12)


def stack(mart: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    """The rows of a range of years; years that are not there are skipped."""
    return mart.where(F.col(year).between(first, last))


def stack_label(stacked: DataFrame, year: str = "year") -> DataFrame:
    """``first-last`` of the years that are present."""
    span = stacked.agg(F.min(year).alias("first"), F.max(year).alias("last"))
    return span.select("first", "last", F.concat_ws("-", "first", "last").alias("label"))


def closed_through(history: DataFrame) -> Column:
    """Last day of the last month in history, from the file months and not from the rows' dates."""
    newest = history.agg(F.max(F.make_date("year", "month", F.lit(1))).alias("m"))
    return newest.select(F.last_day("m")).scalar()


def after_cutoff(schedule: DataFrame, cutoff: Column, date: str = "Data") -> DataFrame:
    """Flights after the closed months; rows without a date go."""
    return schedule.where(quoted(date) > cutoff)


def without_known(
    schedule: DataFrame, history: DataFrame, key: Sequence[str], date: str, cutoff: Column | None = None
) -> DataFrame:
    """The schedule without the flights that are in history under the same key on the same day.

    Blanks around a text do not count and null equals blank. The schedule only has dates past
    ``cutoff``, so only the few history rows that leaked past it can match: they are picked first
    and made unique, then an anti join takes out the rest.
    """
    plain = {
        name: F.coalesce(quoted(name).cast("string"), F.lit("")) if name == date
        else F.coalesce(F.trim(quoted(name)), F.lit(""))
        for name in key
    }
    leaked = history if cutoff is None else history.where(quoted(date) > cutoff)
    known = leaked.select(*[part.alias(f"_h{i}") for i, part in enumerate(plain.values())]).distinct()
    keyed = schedule.withColumns({f"_s{i}": part for i, part in enumerate(plain.values())})
    fresh = lookup_join(keyed, known, {f"_s{i}": f"_h{i}" for i in range(len(plain))}, "left_anti")
    return fresh.drop(*[f"_s{i}" for i in range(len(plain))])


def future_flights(
    history: DataFrame, schedule: DataFrame, year: int, columns: Sequence[str] = L.MART_COLUMNS,
    counts: tuple[Observation, Observation] | None = None, cutoff: Column | None = None,
) -> DataFrame:
    """The scheduled flights from the day after the closed months of a year on, in the columns of history.

    A column the schedule does not have is null. ``counts`` are told the flights after the cutoff and those of
    them that are not in history, while the result is written. With a ``cutoff`` that is a plain date the history
    rows past it are picked by the scan.
    """
    closed = year_table(history, year)
    cutoff = closed_through(closed) if cutoff is None else cutoff
    after = after_cutoff(schedule, cutoff)
    if counts:
        after = after.observe(counts[0], F.count("*").alias("rows"))
    future = without_known(after, closed, L.BORDER_KEY, "Data", cutoff)
    if counts:
        future = future.observe(counts[1], F.count("*").alias("rows"))
    return align(future, columns, closed.schema)


def running_year(
    history: DataFrame, schedule: DataFrame, year: int, columns: Sequence[str] = L.MART_COLUMNS, future: DataFrame | None = None
) -> DataFrame:
    """The closed months of a year and, from the next day on, the scheduled flights (``future``, if they have been
    stored). History gives the types."""
    flights = future_flights(history, schedule, year, columns) if future is None else future
    return align(year_table(history, year), columns).unionByName(flights.select(*[quoted(name) for name in columns]))
