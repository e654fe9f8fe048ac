"""The schedule and its market summaries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.bindings import raw
from skyledger.bindings.raw import spark_rows, table
from skyledger.functions import dates, flights
from skyledger.plans import dimensions, markets, schedule

WATCHED = ["A0", "A1", "A2", "A3", "A5", "A8", "A13", "A21", "A28"]
EXTRACTED = date(2024, 2, 1)


def _departures(spark: SparkSession, sf_dir: str, arrival_offset: str = "origin") -> DataFrame:
    return schedule.departures(
        spark_rows(spark, sf_dir, raw.SCHEDULE),
        dimensions.airports(spark_rows(spark, sf_dir, raw.AIRPORTS)),
        dimensions.airlines(spark_rows(spark, sf_dir, raw.AIRLINES)),
        dimensions.aircraft(spark_rows(spark, sf_dir, raw.AIRCRAFT)),
        arrival_offset,
    )


def schedule_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.schedule(_departures(spark, sf_dir))


def schedule_destination_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals only, with the arrival in the time of the destination."""
    return schedule.schedule(_departures(spark, sf_dir, "destination"), view=L.ARRIVAL)


def airport_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.airports(spark_rows(spark, sf_dir, raw.AIRPORTS))


def schedule_localised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as text, parsed and moved by an offset text."""
    text = F.when(F.hour("ts") == 13, "31/02/2024 10:00:00").otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
    offsets = F.array(*[F.lit(t) for t in ("-03:00", "−05:30", "+02:00", "4", "", "Z", "-12:45")])
    rows = table(spark, sf_dir, "events").select(
        "event_id", dates.stamp(text).alias("utc"),
        dates.offset_hours(F.element_at(offsets, (F.pmod("user_id", F.lit(7)) + 1).cast("int"))).alias("hours"), "value",
    ).withColumn("local", dates.shifted(F.col("utc"), F.col("hours")))
    return rows.select(
        "event_id", "hours", F.col("local").cast("date").alias("day"), dates.clock(F.col("local")).alias("clock"),
        flights.expected_passengers(F.col("value").cast("bigint")).alias("expected"),
    )


def flight_type_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    column = L.SCHEDULE_RAW["flight_type"]
    parts = flights.flight_type_parts(F.col(f"`{column}`"))
    rows = spark_rows(spark, sf_dir, raw.SCHEDULE)
    return rows.select(F.col(f"`{column}`").alias("text"), *[part.alias(name) for name, part in parts.items()]).groupBy(
        "text", *[f"`{name}`" for name in parts]
    ).agg(F.count("*").alias("flights"))


def market_intl_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    departures = schedule.schedule(_departures(spark, sf_dir), view=L.DEPARTURE)
    return markets.international_daily(departures, EXTRACTED, WATCHED)


def market_dom_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    departures = schedule.schedule(_departures(spark, sf_dir), view=L.DEPARTURE)
    return markets.domestic_monthly(departures, EXTRACTED, WATCHED[:6])


def month_freeze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month of a schedule that has not been frozen; the manifest has the months before it."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("Data"))
    manifest = orders.where(F.col("Data") < date(1999, 5, 1)).select(
        F.concat(F.lit(L.FROZEN_PREFIX), F.date_format("Data", "yyyy-MM")).alias("key")
    )
    done = markets.unfrozen_month(orders, manifest, date(1999, 4, 1))
    return done.unionByName(markets.unfrozen_month(orders, manifest, date(1999, 5, 1)))


def month_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markets.month_slice(table(spark, sf_dir, "orders"), date(1998, 12, 1), "o_orderdate")


# --- the same rows in plain SQL ----------------------------------------------------------


def _hours(text: str) -> str:
    plain = f"trim(replace({text}, '−', '-'))"
    digits = f"try_cast(nullif(regexp_extract({plain}, '^[+-]?([0-9]{{1,2}})', 1), '') as int)"
    return f"coalesce(case when {plain} like '-%' then -{digits} else {digits} end, -3)"


_PLACES = f"""(
    select 'A' || n_nationkey as icao, 'I' || n_nationkey as iata, n_name as country, r_name as area,
      {_hours(raw.OFFSET_TEXT)} as hours
    from nation join region on n_regionkey = r_regionkey)"""
_CRAFT = """(
    select 'E' || p_size as craft, arg_min(p_type, p_partkey) as "Acft Group",
      cast(arg_min(p_retailprice, p_partkey) as varchar) as "Mtow", arg_min(p_brand, p_partkey) as "Acft Fra Group"
    from part group by all)"""


def _stamp(column: str) -> str:
    return f"""try_strptime({column}, '%d/%m/%Y %H:%M:%S')"""


def _departure_sql(arrival_hours: str = "o.hours") -> str:
    leaves = f"({_stamp('"Data Partida Prevista UTC"')} + to_hours(coalesce(o.hours, -3)))"
    lands = f"({_stamp('"Data Chegada Prevista UTC"')} + to_hours(coalesce({arrival_hours}, -3)))"
    kind = '"Tipo de Voo"'
    body = f"trim(replace(replace(upper({kind}), 'INTERNACIONAL', ''), 'DOMÉSTICA', ''))"
    line = (f"case when {body} like '%PASSAGEIRO%' then 'Passageiros' when {body} like '%CARGA%' or {body} like '%CORREIO%' "
            f"then 'Carga' when {kind} is not null then 'Others' end")
    seats = """cast(trunc(try_cast("Quantidade de Assentos Previstos" as double)) as bigint)"""
    return f"""
      select "Sigla ICAO Empresa Aérea" as "Airline Icao", substr("Sigla ICAO Empresa Aérea", 1, 2) as "Airline",
        "Número Voo" as "Voo", coalesce("Sigla ICAO Empresa Aérea", '') || coalesce("Número Voo", '') as "Fln Icao",
        coalesce(substr("Sigla ICAO Empresa Aérea", 1, 2), '') || coalesce("Número Voo", '') as "Fln",
        array_to_string(list_transform(string_split({body}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') as "Id Voo",
        {line} as "Id Linha",
        case when upper({kind}) like '%INTERNACIONAL%' then 'Internacional' when {kind} is not null then 'Doméstica' end as "Natureza",
        'DEP' as "Tipo", 'Siros' as "Base", cast("Número Etapa" as bigint) as "Etapa",
        strftime({leaves}, '%H:%M:%S') as "Hora", cast({leaves} as date) as "Data",
        strftime({lands}, '%H:%M:%S') as "OD Hora", cast({lands} as date) as "OD Data",
        "Sigla ICAO Aeroporto Origem" as "Aero Icao", o.iata as "Aero", o.country as "State/Country", o.area as "Region",
        "Sigla ICAO Aeroporto Destino" as "OD Icao", d.iata as "OD", d.country as "OD State/Country", d.area as "OD Region",
        "Sigla ICAO Modelo Aeronave" as "Aircraft", "Acft Group", "Mtow", "Acft Fra Group",
        {seats} as "Seats", 1 as "Decolagens", cast(round_even({seats} * 0.8::double, 0) as bigint) as "Pax Total",
        case {line} when 'Passageiros' then 'Pax' when 'Carga' then 'Cargo' else 'Others' end as "Group"
      from ({raw.SCHEDULE}) s
      left join {_PLACES} o on o.icao = "Sigla ICAO Aeroporto Origem"
      left join {_PLACES} d on d.icao = "Sigla ICAO Aeroporto Destino"
      left join {_CRAFT} k on k.craft = "Sigla ICAO Modelo Aeronave" """


def _arrival_sql(departures: str) -> str:
    partner = {**L.SCHEDULE_PAIRS, **{b: a for a, b in L.SCHEDULE_PAIRS.items()}, "Tipo": None}
    columns = ", ".join("'ARR' as \"Tipo\"" if n == "Tipo" else f'"{partner.get(n, n)}" as "{n}"' for n in L.SCHEDULE_COLUMNS)
    return f"select {columns} from ({departures})"


SCHEDULE_SQL = f"({_departure_sql()}) union all by name ({_arrival_sql(_departure_sql())})"
_WEEKDAY = "case isodow(\"Data\") " + " ".join(f"when {i + 1} then '{name}'" for i, name in enumerate(L.WEEKDAYS)) + " end"
_IN = "(" + ", ".join(f"'{code}'" for code in WATCHED) + ")"
_IN_HOME = "(" + ", ".join(f"'{code}'" for code in WATCHED[:6]) + ")"

QUERIES = {
    "schedule_mart": schedule_mart,
    "schedule_destination_offset": schedule_destination_offset,
    "airport_dimension": airport_dimension,
    "schedule_localised": schedule_localised,
    "flight_type_classify": flight_type_classify,
    "market_intl_daily": market_intl_daily,
    "market_dom_monthly": market_dom_monthly,
    "month_freeze": month_freeze,
    "month_slice": month_slice,
}

SQL = {
    "schedule_mart": SCHEDULE_SQL,
    "schedule_destination_offset": _arrival_sql(_departure_sql("d.hours")),
    "airport_dimension": f"""
        select icao as "ICAO", iata as "IATA", country as "State/Country", area as "Region", hours as "offset" from {_PLACES}""",
    "schedule_localised": """
        with e as (select event_id, value, case when hour(ts) <> 13 then date_trunc('second', ts) end as utc,
            [-3, -5, 2, 4, -3, -3, -12][user_id % 7 + 1] as hours from events)
        select event_id, hours, cast(utc + to_hours(hours) as date) as day, strftime(utc + to_hours(hours), '%H:%M:%S') as clock,
          cast(round_even(trunc(value) * 0.8::double, 0) as bigint) as expected from e""",
    "flight_type_classify": f"""
        select s."Tipo de Voo" as text, "Id Voo", "Id Linha", "Natureza", "Group", count(*) as flights
        from (select *, "Id Voo" as i from ({_departure_sql().replace('select "Sigla ICAO Empresa Aérea" as "Airline Icao"',
              'select "Tipo de Voo", "Sigla ICAO Empresa Aérea" as "Airline Icao"', 1)})) s
        group by all""",
    "market_intl_daily": f"""
        select "Data" as data_local, {_WEEKDAY} as dia_semana, cast(date_trunc('month', "Data") as date) as mes_ref,
          "Aero Icao" as aeroporto_icao, "Aero" as aeroporto_iata, "OD Icao" as od_icao, "OD" as od_iata,
          "OD State/Country" as od_pais, "Airline Icao" as empresa_icao, "Airline" as empresa_nome, "Voo" as voo,
          "Aircraft" as aeronave, "Seats" as assentos, "Group" as tipo, "Hora" as hora_local, date '2024-02-01' as data_extracao
        from ({_departure_sql()}) where "Natureza" = 'Internacional' and "Aero Icao" in {_IN} and "Data" is not null""",
    "market_dom_monthly": f"""
        select cast(date_trunc('month', "Data") as date) as mes_ref, "Aero Icao" as aeroporto_icao, "OD Icao" as od_icao,
          "OD" as od_iata, "Airline Icao" as empresa_icao, "Airline" as empresa_nome, count("Voo") as partidas_mes,
          cast(sum(coalesce("Seats", 0)) as bigint) as assentos_totais_mes, date '2024-02-01' as data_extracao
        from ({_departure_sql()}) where "Natureza" = 'Doméstica' and "Aero Icao" in {_IN_HOME}
        group by all""",
    "month_freeze": """
        select o_orderkey, cast(o_orderdate as date) as "Data", 'siros/mensal/1999-05' as key from orders
        where o_orderdate >= date '1999-05-01' and o_orderdate < date '1999-06-01'""",
    "month_slice": "select * from orders where year(o_orderdate) = 1998 and month(o_orderdate) = 12",
}
