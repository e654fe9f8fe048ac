"""Raw files written as SELECTs over the test tables.

The SELECTs use only SQL that Spark and the checking engine read alike, so both sides start from
the same raw text: ``spark_rows`` runs one in Spark, and the expected SQL takes it as a subquery.
"""

from __future__ import annotations

import re
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.functions import text
from skyledger.session import scratch_folder
from skyledger.sinks.tables import bucketed

TABLES = "region nation customer supplier part orders lineitem events documents pages labels".split()


#: Stored lines are in buckets of these: the file month, and what the keys of legs and fares end with
BUCKETS = ["year", "month", "route"]

#: Tables that a session has opened; they go with the session.
_OPENED: WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; kept, because every opening reads the file footers again."""
    path, opened = f"{sf_dir}/{name}.parquet", _OPENED.setdefault(spark, {})
    application = spark.sparkContext.applicationId
    if opened.get("", application) != application:
        opened.clear()
    opened[""] = application
    if path not in opened:
        opened[path] = spark.read.parquet(path)
    return opened[path]


def spark_rows(spark: SparkSession, sf_dir: str, select: str, **stored: DataFrame) -> DataFrame:
    """Run a SELECT in Spark; table names in it are the test tables, or those that ``stored`` has in their place."""
    used = [name for name in TABLES if re.search(rf"\b(?:from|join)\s+{name}\b", select)]
    marked = re.sub(r"\b(from|join)\s+(" + "|".join(used) + r")\b", r"\1 {\2}", select)
    marked = re.sub(r'"([^"]+)"', r"`\1`", marked)
    return spark.sql(marked, **{name: stored[name] if name in stored else table(spark, sf_dir, name) for name in used})


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that legs, combined rows and fares are made of, joined once and stored in buckets of file month and route.

    ``models`` has the part rows of a line, one for each leg that the line becomes; a line without a part is no leg.
    """
    parts = table(spark, sf_dir, "part").groupBy("p_partkey").agg(F.collect_list(F.struct(*PART_SOURCES)).alias("models"))
    # stored by order first, so that the shuffle for the parts is gone before the one for the orders, which leaves the lines in place
    items = table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").where("l_orderkey is not null")
    items = items.select(*[name for name in items.columns if name.startswith("l_")], "models")
    ordered = bucketed(items, ["l_orderkey"], scratch_folder(spark, "items"))
    lines = spark_rows(spark, sf_dir, f"select {MONTH}, {ROUTE}, {', '.join(LINE_SOURCES)}, models {LINES}", lineitem=ordered)
    routed = lines.withColumn("route", text.route_end(F.col("sg_icao_origem"), F.col("sg_icao_destino")))
    return bucketed(routed.select(*BUCKETS, *LINE_SOURCES, "models"), BUCKETS, scratch_folder(spark, "lines"))


def line_rows(lines: DataFrame, select: str) -> DataFrame:
    """The rows of a SELECT over ``LINES``, with their route, from the stored lines."""
    marked = select.replace(LINES, "from {lines}").replace(MONTH, "year, month, route")
    return lines.sparkSession.sql(marked, lines=lines)


def leg_rows(lines: DataFrame) -> DataFrame:
    """The raw legs, and beside their texts the columns of the test tables that these are made of."""
    legs = lines.select("*", F.inline("models")).drop("models")
    return line_rows(legs, f"select {LEG_TEXTS}, {', '.join(LEG_SOURCES)} {LINES}")


def spelled(legs: DataFrame) -> DataFrame:
    """The texts of legs of which only the sources have been kept."""
    others = ", ".join(f"`{name}`" for name in legs.columns if name not in {"year", "month", *LEG_SOURCES, *L.LEG_RAW})
    return legs.sparkSession.sql(f"select {LEG_TEXTS}, {others} from {{legs}}", legs=legs)


def day_first(ts: str) -> str:
    """SQL text of a day as dd/mm/yyyy."""
    return (f"lpad(cast(day({ts}) as string), 2, '0') || '/' || lpad(cast(month({ts}) as string), 2, '0')"
            f" || '/' || cast(year({ts}) as string)")


def clock(ts: str) -> str:
    """SQL text of a time as HH:mm:ss."""
    parts = [f"lpad(cast({unit}({ts}) as string), 2, '0')" for unit in ("hour", "minute", "second")]
    return " || ':' || ".join(parts)


def month_text(ts: str) -> str:
    """SQL text of a month as yyyymm."""
    return f"cast(year({ts}) * 100 + month({ts}) as string)"


def iso(ts: str) -> str:
    return f"cast(cast({ts} as date) as string)"


def comma_price(price: str) -> str:
    """SQL text of a price as 1.234,50."""
    whole = f"cast(cast(floor({price}) as bigint) as string)"
    cents = f"lpad(cast(cast(round(({price} - floor({price})) * 100) as bigint) as string), 2, '0')"
    grouped = (f"case when length({whole}) > 3 then substr({whole}, 1, length({whole}) - 3) || '.' || "
               f"substr({whole}, length({whole}) - 2) else {whole} end")
    return f"({grouped}) || ',' || {cents}"


LINES = """from orders
    join customer on o_custkey = c_custkey
    join lineitem on l_orderkey = o_orderkey
    join supplier on l_suppkey = s_suppkey"""

ROUTE = """
    c_mktsegment as sg_empresa_icao,
    'S' || cast(s_nationkey as string) as sg_icao_origem,
    'C' || cast(c_nationkey as string) as sg_icao_destino"""

MONTH = "cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month"

LEG_TEXTS = f"""
    {MONTH}, {ROUTE},
    nullif(substr(c_mktsegment, 1, 2), 'BU') as sg_empresa_iata,
    cast(l_linenumber as string) as nr_voo,
    case l_returnflag when 'A' then 'REGULAR' when 'N' then 'NÃO REGULAR' end as ds_di,
    case p_type when 'ECONOMY' then 'DOMÉSTICA MISTA' when 'PROMO' then 'INTERNACIONAL CARGUEIRA'
      when 'SMALL' then 'DOMÉSTICA CARGUEIRA' when 'LARGE' then 'INTERNACIONAL MISTA' else p_type end as ds_tipo_linha,
    case when s_nationkey = c_nationkey then 'DOMÉSTICA' else 'INTERNACIONAL' end as ds_natureza_etapa,
    cast(l_linenumber as string) as nr_etapa,
    case when l_linestatus = 'O' then '0' end as nr_escala_destino,
    {iso('o_orderdate')} as dt_referencia,
    cast(year(o_orderdate) as string) as nr_ano_referencia,
    {month_text('l_shipdate')} as nr_ano_mes_partida_real,
    case when l_linenumber <> 7 then {iso('l_shipdate')} end as dt_partida_real,
    {clock('l_shipdate')} as hr_partida_real,
    case when l_tax > 0.01 then {day_first('l_shipdate')} else ' ' end as dt_chegada_real,
    case when l_linestatus = 'F' then {clock('l_shipdate')} end as hr_chegada_real,
    'I' || cast(s_nationkey as string) as sg_iata_origem,
    'AEROPORTO ' || s_name as nm_aerodromo_origem, 'SANTA BÁRBARA D''OESTE/SP' as nm_municipio_origem,
    'U' || cast(s_nationkey as string) as sg_uf_origem, 'SUDESTE' as nm_regiao_origem,
    'PAÍS-' || cast(s_nationkey as string) as nm_pais_origem, 'AMÉRICA DO SUL' as nm_continente_origem,
    'I' || cast(c_nationkey as string) as sg_iata_destino,
    'TERMINAL ' || c_name as nm_aerodromo_destino, 'PASSO FUNDO' as nm_municipio_destino,
    'U' || cast(c_nationkey as string) as sg_uf_destino, 'SUL' as nm_regiao_destino,
    'PAÍS-' || cast(c_nationkey as string) as nm_pais_destino, 'EUROPA' as nm_continente_destino,
    'E' || cast(p_size as string) as sg_equipamento_icao, p_name as ds_modelo,
    nullif(p_brand, 'Brand#7') as ds_matricula,
    cast(p_size - 3 as string) as nr_assentos_ofertados, cast(l_extendedprice as string) as kg_payload,
    ' ' || cast(l_partkey as string) || ' ' as km_distancia,
    cast(l_quantity as string) as nr_passag_pagos,
    case when l_returnflag = 'R' then 'x' else cast(l_linenumber as string) end as nr_passag_gratis,
    cast(l_discount * 1000 as string) as kg_bagagem_livre, '1e1' as kg_bagagem_excesso,
    case when l_tax > 0 then cast(l_extendedprice as string) end as kg_carga_paga, '1,5' as kg_carga_gratis,
    '' as kg_correio,
    cast(l_extendedprice as string) as lt_combustivel, '1' as nr_decolagem,
    cast(l_discount as string) as nr_horas_voadas, cast(p_retailprice as string) as kg_peso,
    case when p_size > 25 then cast(p_size as string) else '-' end as nr_velocidade_media,
    cast(l_partkey as string) as nr_ask, cast(l_suppkey as string) as nr_rpk"""

LEG_LINES = f"""{LINES}
    join part on l_partkey = p_partkey"""

LEGS = f"""
  select{LEG_TEXTS}
  {LEG_LINES}"""

# the columns that the texts of a leg are made of
LEG_SOURCES = (
    "o_orderdate c_mktsegment c_name c_nationkey s_name s_nationkey p_name p_type p_brand p_size p_retailprice l_partkey l_suppkey "
    "l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()
PART_SOURCES = [name for name in LEG_SOURCES if name.startswith("p_")]
LINE_SOURCES = [*[name for name in LEG_SOURCES if name not in PART_SOURCES], "o_orderstatus"]

COMBINED = f"""
  select
    {MONTH}, {ROUTE},
    case when l_tax < 0.08 then cast(l_linenumber as string) end as nr_voo,
    {iso('o_orderdate')} as dt_referencia,
    case when l_linestatus = 'F' then 'D' when l_returnflag = 'N' then 'X' else 'I' end as cd_cotran,
    cast(l_quantity as string) as nr_passag_pagos, '2' as nr_passag_gratis,
    cast(l_discount * 1000 as string) as kg_bagagem_livre, 'x' as kg_bagagem_excesso,
    cast(l_extendedprice as string) as kg_carga_paga, cast(l_partkey as string) as kg_carga_gratis,
    case when l_tax > 0 then cast(l_suppkey as string) end as kg_correio
  {LINES}"""

_FARE = f"""
    {MONTH}, {ROUTE},
    cast(year(o_orderdate) as string) as nr_ano_referencia, cast(month(o_orderdate) as string) as nr_mes_referencia,
    cast(l_quantity as string) as nr_assentos"""

DOMESTIC_FARES = f"""
  select {_FARE},
    case when l_discount < 0.1 then {comma_price('l_extendedprice')} else '-' end as nr_tarifa
  {LINES}
  where l_linestatus = 'F'"""

INTERNATIONAL_FARES = f"""
  select {_FARE},
    case when l_discount > 0 then cast(l_extendedprice as string) end as nr_tarifa,
    case when o_orderstatus = 'P' then '9999' when o_orderstatus = 'F' then 'SBGR' end as sg_icao_retorno,
    case l_returnflag when 'A' then 'F' when 'N' then 'J' else case when l_linenumber < 6 then 'Y' else 'W' end end
      as cd_classe_ida
  {LINES}
  where l_linestatus = 'O'"""

# one rate per month that occurs in the orders
RATES = """
  select distinct cast(year(o_orderdate) as string) || ' - ' || lpad(cast(month(o_orderdate) as string), 2, '0') as rate_key,
    cast(3 + (year(o_orderdate) - 1995) * 0.25 + month(o_orderdate) * 0.0125 as decimal(18,6)) as rate
  from orders"""

OFFSET_TEXT = """case when n_nationkey < 6 then '-03:00' when n_nationkey < 10 then '−05:30' when n_nationkey < 14 then '+02:00'
      when n_nationkey < 18 then '-4' when n_nationkey < 22 then '' end"""

AIRPORTS = f"""
  select 'old' as "ICAO", 'old' as "IATA", 'A' || cast(n_nationkey as string) as "OD ICAO", 'I' || cast(n_nationkey as string) as "OD IATA",
    n_name as "State/Country", r_name as "Region", {OFFSET_TEXT} as "UTC Offset", cast(n_nationkey as bigint) as line
  from nation join region on n_regionkey = r_regionkey
  union all
  select 'old', 'old', 'A' || cast(n_nationkey as string), 'later', 'later', 'later', '+09:00', cast(n_nationkey + 100 as bigint)
  from nation"""

AIRLINES = """
  select distinct event_type as "ICAO", substr(event_type, 1, 2) as "IATA/ICAO", cast(1 as bigint) as line from events"""

AIRCRAFT = """
  select 'E' || cast(p_size as string) as "Name", p_type as "Group", cast(p_retailprice as string) as "MTOWF", p_brand as "GROUPF",
    p_partkey as line
  from part"""

SCHEDULE = f"""
  select
    nullif(event_type, 'error') as "Sigla ICAO Empresa Aérea", event_type as "Nome da Empresa Aérea",
    cast(user_id as string) as "Número Etapa", nullif(cast(user_id as string), '7') as "Número Voo",
    'E' || cast(user_id as string) as "Sigla ICAO Modelo Aeronave",
    cast(value as string) as "Quantidade de Assentos Previstos",
    'A' || cast(user_id % 30 as string) as "Sigla ICAO Aeroporto Origem",
    case when hour(ts) = 13 then 'never' else {day_first('ts')} || ' ' || {clock('ts')} end as "Data Partida Prevista UTC",
    'A' || cast(event_id % 27 as string) as "Sigla ICAO Aeroporto Destino",
    {day_first("(ts + interval '95' minute)")} || ' ' || {clock("(ts + interval '95' minute)")} as "Data Chegada Prevista UTC",
    case event_type when 'click' then 'REGULAR DE PASSAGEIROS DOMÉSTICA' when 'view' then 'Regular de passageiros internacional'
      when 'signup' then 'NÃO REGULAR DE CARGA INTERNACIONAL' when 'purchase' then 'CORREIO DOMÉSTICA'
      when 'error' then case when user_id % 2 = 0 then 'TRANSLADO' end end as "Tipo de Voo"
  from events"""
