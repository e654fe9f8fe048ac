"""Years, stacks, the border between history and schedule, and the running year."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.bindings.raw import table
from skyledger.plans import years

COLUMNS = [*L.BORDER_KEY, "Base", "Seats", "Etapa"]


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as history. A row is filed under the month of the day two days before, so the first
    days of a month also stand in the file of the month before."""
    filed = F.col("o_orderdate") - F.expr("interval 2 days")
    return table(spark, sf_dir, "orders").select(
        F.year(filed).alias("year"), F.month(filed).alias("month"),
        F.substring("o_orderpriority", 1, 1).alias("Airline Icao"),
        F.nullif(F.col("o_custkey").cast("string"), F.lit("11")).alias("Voo"),
        F.col("o_orderstatus").alias("Aero Icao"), F.lit("X").alias("OD Icao"),
        F.col("o_orderdate").cast("date").alias("Data"), F.lit("Anac").alias("Base"),
        F.col("o_totalprice").cast("bigint").alias("Seats"), F.col("o_orderkey").cast("string").alias("Etapa"),
    )


def _timetable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flights as a schedule, with blanks around the texts, and their return flights."""
    out = _history(spark, sf_dir).drop("year", "month", "Etapa").withColumns({
        "Voo": F.when(F.col("Voo").isNull(), "").otherwise(F.concat(F.lit(" "), F.col("Voo"))), "Base": F.lit("Siros"),
    })
    back = out.withColumns({"Aero Icao": F.lit("X"), "OD Icao": F.col("`Aero Icao`")})
    return out.unionByName(back)


def border_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights after a fixed cutoff that are not in the files of the closed months."""
    closed = _history(spark, sf_dir).where(F.col("year") <= 1999)
    cutoff = F.lit(date(1999, 12, 31))
    future = years.after_cutoff(_timetable(spark, sf_dir), cutoff)
    return years.without_known(future, closed, L.BORDER_KEY, "Data", cutoff)


def live_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of the year 2000 up to its last closed month, then the schedule."""
    history = _history(spark, sf_dir).where((F.col("year") < 2000) | (F.col("month") <= 6))
    return years.running_year(history, _timetable(spark, sf_dir), 2000, COLUMNS)


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})


def year_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of years 1993 to 1997, of which the first two are not there, with the label of the stack."""
    stacked = years.stack(_dated(spark, sf_dir), 1993, 1997)
    label = years.stack_label(stacked).select("label").scalar()
    return stacked.select("o_orderkey", "year", "month", label.alias("label"))


def month_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return years.month_completeness(_dated(spark, sf_dir))


def year_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return years.year_table(_dated(spark, sf_dir), 1997)


_HISTORY = """
  select year(o_orderdate - interval 2 day) as year, month(o_orderdate - interval 2 day) as month,
    substr(o_orderpriority, 1, 1) as "Airline Icao", nullif(cast(o_custkey as varchar), '11') as "Voo",
    o_orderstatus as "Aero Icao", 'X' as "OD Icao", cast(o_orderdate as date) as "Data", 'Anac' as "Base",
    cast(trunc(o_totalprice) as bigint) as "Seats", cast(o_orderkey as varchar) as "Etapa"
  from orders"""
_TIMETABLE = f"""
  select "Airline Icao", case when "Voo" is null then '' else ' ' || "Voo" end as "Voo", "Aero Icao", "OD Icao", "Data",
    'Siros' as "Base", "Seats" from ({_HISTORY})
  union all
  select "Airline Icao", case when "Voo" is null then '' else ' ' || "Voo" end, 'X', "Aero Icao", "Data", 'Siros', "Seats"
  from ({_HISTORY})"""


def _future(closed: str, last_day: str) -> str:
    return f"""
      select * from ({_TIMETABLE}) t where "Data" > {last_day} and not exists (
        select 1 from ({_HISTORY}) h where {closed} and h."Airline Icao" = t."Airline Icao" and coalesce(h."Voo", '') = trim(t."Voo")
          and h."Aero Icao" = t."Aero Icao" and h."OD Icao" = t."OD Icao" and h."Data" = t."Data")"""


QUERIES = {
    "border_anti_join": border_anti_join,
    "live_year": live_year,
    "year_stack": year_stack,
    "month_completeness": month_completeness,
    "year_rows": year_rows,
}

SQL = {
    "border_anti_join": _future("h.year <= 1999", "date '1999-12-31'"),
    "live_year": f"""
        select * exclude (year, month) from ({_HISTORY}) where year = 2000 and month <= 6
        union all by name
        select *, cast(null as varchar) as "Etapa"
        from ({_future("h.year = 2000 and h.month <= 6", "date '2000-06-30'")})""",
    "year_stack": """
        select o_orderkey, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
          min(year(o_orderdate)) over () || '-' || max(year(o_orderdate)) over () as label
        from orders where year(o_orderdate) between 1993 and 1997""",
    "month_completeness": """
        select cast(year(o_orderdate) as int) as year, count(distinct month(o_orderdate)) as months,
          cast(min(month(o_orderdate)) as int) as first, cast(max(month(o_orderdate)) as int) as last, count(*) as rows, count(distinct month(o_orderdate)) = 12 as complete
        from orders group by all""",
    "year_rows": """
        select *, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month from orders where year(o_orderdate) = 1997""",
}
