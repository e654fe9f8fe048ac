"""Single values: numbers, texts, dates, names and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.bindings import raw
from skyledger.bindings.raw import spark_rows, table
from skyledger.functions import dates, numbers, text
from skyledger.sinks.tables import targets


def fare_text_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices written with a decimal comma and with a decimal point, read back."""
    rows = spark_rows(spark, sf_dir, f"""
        select l_orderkey, l_linenumber, {raw.comma_price('l_extendedprice')} as with_comma,
          cast(floor(l_extendedprice) + case when l_linestatus = 'O' then 0.5 else 0 end as string) as with_point
        from lineitem""")
    return rows.select(
        "l_orderkey", "l_linenumber", numbers.fare(F.col("with_comma"), True).alias("a"),
        numbers.fare(F.col("with_point"), False).alias("b"), numbers.fare(F.concat(F.col("with_point"), F.lit(" R$")), False).alias("c"),
    )


def lenient_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers out of the digits of a JSON text, of decimals and of junk."""
    digits = F.regexp_extract("props", r"(\d+)", 1)
    junk = (
        F.when(F.col("event_type") == "click", F.concat(F.lit(" "), digits, F.lit(".7 ")))
        .when(F.col("event_type") == "view", F.concat(digits, F.lit("e1")))
        .when(F.col("event_type") == "error", F.concat(digits, F.lit(",5")))
        .when(F.col("event_type") == "signup", F.concat(digits, F.lit("d")))
        .otherwise(F.concat(F.lit("-"), digits))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", numbers.whole_or_zero(junk).alias("or_zero"), numbers.whole(junk).alias("or_null"),
        numbers.whole_or_zero(F.col("props")).alias("none"),
    )


def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations whose text is taken for null in a file, and others that look alike."""
    token = (
        F.when(F.col("n_nationkey") < 5, "NA").when(F.col("n_nationkey") < 9, "null").when(F.col("n_nationkey") < 12, "NAN")
        .when(F.col("n_nationkey") < 15, "  ").when(F.col("n_nationkey") < 18, "None").otherwise(F.col("n_name"))
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", numbers.null_tokens(token).alias("clean"))
    customer = table(spark, sf_dir, "customer")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "clean")


def tolerant_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    mixed = (
        F.when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.date_format(day, "d/M/yyyy"), F.lit(" 9:05")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit("garbage")))
        .when(F.col("o_orderstatus") == "F", F.date_format(day, "dd/MM/yyyy"))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 10:20:30")))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit("31/02/2001"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.tolerant_date(mixed).alias("day"))


def offset_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset texts of customers: sign, typographic minus, minutes, none."""
    balance = F.col("c_acctbal")
    hours = F.format_string("%02d", F.pmod(F.floor(F.abs(balance)), F.lit(13)).cast("int"))
    offset = (
        F.when(balance < 0, F.concat(F.lit("−"), hours, F.lit(":30"))).when(F.col("c_nationkey") == 3, F.lit("UTC"))
        .when(balance < 5000, F.concat(F.lit(" -"), hours, F.lit(":00"))).otherwise(F.concat(F.lit("+"), hours))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", dates.offset_hours(offset).alias("hours"))


def proper_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts with apostrophes, slashes and digits put in."""
    name = F.concat(F.upper("p_name"), F.lit(" d'OESTE sp/rj "), F.col("p_brand"), F.lit(" ação-ÚTIL a1b2"))
    return table(spark, sf_dir, "part").select("p_partkey", text.proper_case(name).alias("name"))


def weekday_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.weekday_label(F.col("o_orderdate")).alias("weekday"),
        dates.month_start(F.col("o_orderdate")).alias("month_start"),
    )


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    month, dashed = F.date_format("o_orderdate", "yyyyMM"), F.date_format("o_orderdate", "yyyy-MM")
    name = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(month, F.lit(".CSV")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("raw/"), month, F.lit(" (1).csv")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("INTERNACIONAL_"), dashed, F.lit("(02).CSV")))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("in/basica"), month, F.lit(".txt")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("in/Combinada"), dashed, F.lit(".TXT")))
        .otherwise(F.lit("leia-me.txt"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", name.alias("path"))


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    return _names(spark, sf_dir).select(
        "o_orderkey", text.period_in_name(path).alias("period"), text.fare_kind(path).alias("fare_kind"),
        text.without_copy_suffix(path).alias("clean"),
    )


_THEMES = {"1-URGENT": "TARIFAS AÉREAS DOMÉSTICAS", "2-HIGH": "Tarifas aéreas internacionais", "3-MEDIUM": "tarifa nacional",
           "4-NOT SPECIFIED": "Microdados doméstico", "5-LOW": "Tarífa Internácional"}


def theme_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    label: Column = F.lit(None).cast("string")
    for priority, theme in _THEMES.items():
        label = F.when(F.col("o_orderpriority") == priority, theme).otherwise(label)
    return table(spark, sf_dir, "orders").select("o_orderkey", text.fare_theme(label).alias("theme"))


def sink_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of manifest keys made of documents, by the prefix of the key."""
    prefix = (
        F.when(F.col("lang") == "en", "basica/").when(F.col("lang") == "fr", "tarifas/int/")
        .when(F.col("lang") == "de", "siros/mensal/").otherwise("siros/")
    )
    return targets(table(spark, sf_dir, "documents").select(F.concat(prefix, F.col("doc_id").cast("string")).alias("key")))


QUERIES = {
    "fare_text_parse": fare_text_parse,
    "lenient_int": lenient_int,
    "null_tokens": null_tokens,
    "tolerant_date": tolerant_date,
    "offset_parse": offset_parse,
    "proper_case": proper_case,
    "weekday_label": weekday_label,
    "file_names": file_names,
    "theme_fold": theme_fold,
    "sink_routes": sink_routes,
}

_THEME_CASE = "case o_orderpriority " + " ".join(f"when '{p}' then '{t}'" for p, t in _THEMES.items()) + " end"
_NAME = """case o_orderpriority when '1-URGENT' then strftime(o_orderdate, '%Y%m') || '.CSV'
    when '2-HIGH' then strftime(o_orderdate, '%Y%m') || ' (1).csv'
    when '3-MEDIUM' then 'INTERNACIONAL_' || strftime(o_orderdate, '%Y-%m') || '(02).CSV'
    else case o_orderstatus when 'F' then 'basica' || strftime(o_orderdate, '%Y%m') || '.txt'
      when 'O' then 'Combinada' || strftime(o_orderdate, '%Y-%m') || '.TXT' else 'leia-me.txt' end end"""

SQL = {
    "fare_text_parse": """
        select l_orderkey, l_linenumber, cast(round_even(l_extendedprice, 0) as bigint) as a,
          cast(round_even(floor(l_extendedprice) + case when l_linestatus = 'O' then 0.5 else 0 end, 0) as bigint) as b,
          cast(null as bigint) as c from lineitem""",
    "lenient_int": r"""
        with e as (select event_id, event_type, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as n from events)
        select event_id, case event_type when 'click' then n when 'view' then n * 10 when 'purchase' then -n else 0 end as or_zero,
          case event_type when 'click' then n when 'view' then n * 10 when 'purchase' then -n end as or_null,
          cast(0 as bigint) as none from e""",
    "null_tokens": """
        select c_custkey, case when n_nationkey < 9 then null when n_nationkey < 12 then 'NAN' when n_nationkey < 15 then '  '
          when n_nationkey < 18 then null else n_name end as clean
        from customer join nation on c_nationkey = n_nationkey""",
    "tolerant_date": """
        select o_orderkey, case when o_orderpriority = '3-MEDIUM' or o_orderstatus <> 'F' and o_orderpriority = '1-URGENT' then null
          else cast(o_orderdate as date) end as day from orders""",
    "offset_parse": """
        select c_custkey, cast(case when c_acctbal < 0 then -(floor(abs(c_acctbal)) % 13) when c_nationkey = 3 then -3
          when c_acctbal < 5000 then -(floor(abs(c_acctbal)) % 13) else floor(abs(c_acctbal)) % 13 end as int) as hours
        from customer""",
    "proper_case": """
        select p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')
          || ' D''Oeste Sp/Rj ' || p_brand || ' Ação-Útil A1B2' as name from part""",
    "weekday_label": """
        select o_orderkey, ['segunda', 'terca', 'quarta', 'quinta', 'sexta', 'sabado', 'domingo'][isodow(o_orderdate)] as weekday,
          cast(date_trunc('month', o_orderdate) as date) as month_start from orders""",
    "file_names": f"""
        select o_orderkey, case when {_NAME} <> 'leia-me.txt' then cast(date_trunc('month', o_orderdate) as date) end as period,
          case o_orderpriority when '1-URGENT' then 'dom' when '2-HIGH' then 'dom' when '3-MEDIUM' then 'int' end as fare_kind,
          replace(replace({_NAME}, ' (1)', ''), '(02)', '') as clean from orders""",
    "theme_fold": f"""
        with o as (select o_orderkey, strip_accents(lower({_THEME_CASE})) as t from orders)
        select o_orderkey, case when t like '%tarifa%' then case when t like '%internacion%' then 'int'
          when t like '%domestic%' or t like '%nacion%' then 'dom' end end as theme from o""",
    "sink_routes": """
        with d as (select case lang when 'en' then 'basica/' when 'fr' then 'tarifas/int/' when 'de' then 'siros/mensal/'
            else 'siros/' end as p, doc_id from documents)
        select p || doc_id as key,
          case p when 'basica/' then 'movimentacao_raw' when 'tarifas/int/' then 'ticket_raw' else 'siros_raw' end as raw,
          case p when 'basica/' then 'movimentacao' when 'tarifas/int/' then 'ticket' when 'siros/mensal/' then 'siros_mensal'
            else 'siros' end as processed,
          case when p like 'siros/%' then 'replace' else 'accumulate' end as raw_mode,
          case p when 'siros/' then 'replace' else 'accumulate' end as processed_mode from d""",
}
