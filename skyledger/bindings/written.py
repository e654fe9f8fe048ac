"""What is written, and read back as it lies there: exports, routed tables, orders, refusals, and counts of runs."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.bindings.collection import manifest
from skyledger.bindings.files import _archives
from skyledger.bindings.raw import table
from skyledger.plans import fares, history, markets, state
from skyledger.session import scratch_folder
from skyledger.sinks.tables import BOM, NothingToWrite, Snapshots, export_text, rate_table, read_routed, write_routed
from skyledger.sources import archives
from skyledger.sources.landing import not_older
from skyledger.sources.tables import schedule_file


def archive_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksum of every member and the fingerprint of its archive: names, sizes and checksums of all that is in it."""
    documents = table(spark, sf_dir, "documents")
    return archives.archive_members(_archives(documents, F.col("text"))).select("path", "crc", "fingerprint", "status")


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with texts that need quotes, nulls, and a letter beyond ASCII."""
    text = F.when(F.col("o_orderstatus") == "F", F.concat("o_orderpriority", F.lit(";é,x"))).when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_orderkey", text.alias("note"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.col("o_orderdate").cast("date").alias("day"))


def export_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of an export by month; the header of each file, with the byte order mark that a reader of text takes off, told
    once a month."""
    place = scratch_folder(spark, "export")
    export_text(_exported(spark, sf_dir), place, period=["year", "month"])
    files = spark.read.format("binaryFile").load(place)
    headers = files.select("year", "month", F.split_part(F.decode("content", "UTF-8"), F.lit("\n"), F.lit(1)).alias("line")).distinct()
    lines = spark.read.text(place).where(~F.col("value").startswith("o_orderkey"))
    return headers.unionByName(lines.select("year", "month", F.col("value").alias("line")))


def export_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of an export with commas and without a mark; its header once."""
    place = scratch_folder(spark, "export")
    export_text(_exported(spark, sf_dir), place, separator=",", bom=False)
    lines = spark.read.text(place)
    header = F.col("value").startswith("year,")
    return lines.where(header).distinct().unionByName(lines.where(~header)).select(F.col("value").alias("line"))


def write_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that an empty result may not replace: its rows, and whether the writer refused."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    book = Snapshots(spark, scratch_folder(spark, "refused"))
    book.replace(customer)
    refused = False
    try:
        book.replace(customer.where("c_custkey < 0"))
    except NothingToWrite:
        refused = True
    return book.read().withColumn("refused", F.lit(refused))


def market_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns and types of both summaries of a schedule in which nothing matches, with the number of rows."""
    part = table(spark, sf_dir, "part").select(*[F.lit(None).cast("string").alias(name) for name in L.SCHEDULE_COLUMNS])
    part = part.withColumns({"Data": F.lit(None).cast("date"), "Tipo": F.lit("none"), "Seats": F.lit(0).cast("bigint")})
    found = []
    for name, plan in (("daily", markets.international_daily), ("monthly", markets.domestic_monthly)):
        result = plan(part, datetime(2026, 1, 2, tzinfo=UTC).date())
        rows = result.count()
        found += [(name, column, kind, rows) for column, kind in result.dtypes]
    return spark.createDataFrame(found, "summary string, column string, type string, rows bigint")


def rate_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every rate in the written table: by file and row, which is by key."""
    rates = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy - MM").alias("rate_key")).agg(F.max("o_totalprice").alias("rate"))
    place = scratch_folder(spark, "rates")
    rate_table(rates).write.parquet(place)
    rows = spark.read.parquet(place).select("rate_key", "rate", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    # a handful of files, in the order of their names
    starts, before = [], 0
    for file in sorted(rows.groupBy("file").count().collect()):
        starts += [F.lit(file["file"]), F.lit(before)]
        before += file["count"]
    return rows.select("rate_key", "rate", (F.create_map(*starts)[F.col("file")] + F.col("at") + 1).alias("place"))


def schedule_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schedule file made of the events, with a line of text above its header, read back."""
    place = scratch_folder(spark, "schedule")
    events = table(spark, sf_dir, "events").select(
        F.concat_ws(";", F.col("event_id").cast("string"), F.when(F.col("event_type") == "view", "NA").otherwise(F.col("event_type")), F.date_format("ts", "dd/MM/yyyy HH:mm:ss")).alias("value"),
        F.lit(2).alias("at"))
    top = spark.createDataFrame([("Dados previstos; sem garantia", 0), ("id ;type;when", 1)], "value string, at int")
    # one file, as it is published
    top.unionByName(events).repartition(1).sortWithinPartitions("at").select("value").write.text(place)
    return schedule_file(spark, place)


def inventory_floor_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of orders on offer in two segments, of which one is known for some months on either side of the year floor."""
    orders = table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyyMM")
    offer = orders.select(F.explode(F.array(*map(F.lit, L.SEGMENTS))).alias("segment"), month.alias("ref")).distinct()
    known = orders.where("year(o_orderdate) in (1996, 1999, 2000) and o_orderstatus = 'F' and month(o_orderdate) < 9").select(
        F.concat(F.lit("basica/"), month).alias("key")).distinct()
    entries = known.select("key", *[F.lit(L.NEW if name == "situacao" else None).cast(kind).alias(name) for name, kind in state.FIELDS.items()])
    return state.refs_to_collect(offer, entries, oldest_year=1999)


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of two runs over the shipped lines by month, kept as rows and read back. In the second run lines that were
    returned have no fare, and those of one month are fewer."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), F.when(F.col("l_linestatus") == "F", "DEP").otherwise("ARR").alias("Tipo"),
        F.when(F.col("l_linenumber") < 4, F.col("l_extendedprice")).alias("Tkt Avg"), "l_returnflag", "l_linenumber")
    place = scratch_folder(spark, "history")
    history.note(lines, place, datetime(2026, 1, 1, tzinfo=UTC))
    fewer = lines.where(~((F.col("year") == 1997) & (F.col("month") == 5) & (F.col("l_linenumber") == 5)))
    history.note(fewer.withColumn("Tkt Avg", F.when((F.col("l_returnflag") != "R") | (F.col("month") != 3), F.col("Tkt Avg"))), place, datetime(2026, 1, 2, tzinfo=UTC))
    found = history.compared(history.history(spark, place))
    return found.select(F.dayofmonth("run").alias("run"), "year", "month", "rows", "with_fare", "departures", F.round("share", 9).alias("share"), F.round("share_before", 9).alias("share_before"), "fell")


def routed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of five origins written to the tables of their keys, first the filled and then the open ones, and all tables read back."""
    root = scratch_folder(spark, "routed")
    month, year = F.date_format("o_orderdate", "yyyyMM"), F.date_format("o_orderdate", "yyyy")
    origin = F.substring("o_orderpriority", 1, 1)
    key = (
        F.when(origin == "1", F.concat(F.lit("basica/"), month)).when(origin == "2", F.concat(F.lit("combinada/"), month))
        .when(origin == "3", F.concat(F.lit("tarifas/dom/"), year)).when(origin == "4", F.concat(F.lit(L.FROZEN_PREFIX), F.date_format("o_orderdate", "yyyy-MM")))
        .otherwise(F.concat(F.lit("siros/voos"), F.col("o_orderstatus")))
    )
    rows = table(spark, sf_dir, "orders").select(key.alias("key"), "o_orderkey", "o_orderstatus")
    write_routed(rows.where("o_orderstatus = 'F'"), root)
    write_routed(rows.where("o_orderstatus <> 'F'"), root)
    modes = dict(sorted({(processed, mode) for _, processed, _, mode in L.ROUTES.values()}))
    parts = [read_routed(spark, root, target, mode).withColumn("target", F.lit(target)) for target, mode in modes.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("target", "key").agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("total"))


def pending_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of orders that were built with the content they have, of which some need a rate that is another one now, or none."""
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_totalprice", "o_orderstatus")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    available = orders.groupBy("year", "month").agg(F.sum(price).cast("string").alias("impressao"))
    finished = available.where("year <> 1996")
    key = F.concat_ws(" - ", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("rate_key")
    used = orders.where("o_orderstatus = 'F'").groupBy("year", "month").agg(F.max(price).alias("rate")).select("year", "month", key, "rate")
    now = orders.where("o_orderstatus in ('F', 'P') and month <> 7").groupBy("year", "month").agg(F.max(price).alias("rate")).select(key, "rate")
    return state.pending(available, finished, reopened=fares.changed_rates(used, now)).select("year", "month")


def landing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders as files that come in, filled ones as what has been landed for their month: those that are not older."""
    orders = table(spark, sf_dir, "orders")

    def files(rows: DataFrame, content: str) -> DataFrame:
        order = F.struct((F.col("o_orderpriority") == "1-URGENT").alias("dashed"), F.col("o_orderdate").cast("timestamp").alias("modified"), F.col("o_orderkey").cast("string").alias("content"))
        newest = rows.groupBy(F.lit("legs").alias("folder"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.max(order).alias("f"))
        return newest.select("folder", "year", "month", F.col("f.content").alias(content), "f.modified", "f.dashed")

    found = files(orders.where("o_orderstatus <> 'F' or month(o_orderdate) = 4"), "sha256")
    index = files(orders.where("o_orderstatus = 'F' and year(o_orderdate) < 2000"), "impressao")
    return not_older(found, index).select("year", "month", "sha256", "dashed", "known")


QUERIES = {
    "archive_fingerprint": archive_fingerprint,
    "export_semicolon": export_semicolon,
    "export_comma": export_comma,
    "write_refused": write_refused,
    "market_empty": market_empty,
    "rate_order": rate_order,
    "schedule_file_rows": schedule_file_rows,
    "inventory_floor_known": inventory_floor_known,
    "run_history": run_history,
    "routed_tables": routed_tables,
    "pending_rates": pending_rates,
    "landing_order": landing_order,
}

_LINE = """cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, cast(o_orderkey as varchar) as k,
    case o_orderstatus when 'F' then '"' || o_orderpriority || ';é,x"' when 'O' then o_orderpriority else '' end as note,
    cast(cast(o_totalprice as decimal(18,2)) as varchar) as price, strftime(o_orderdate, '%Y-%m-%d') as day"""
# fixed values: published columns of the two summaries
_DAILY = "data_local date, dia_semana string, mes_ref date, aeroporto_icao string, aeroporto_iata string, od_icao string, od_iata string, od_pais string, " \
    "empresa_icao string, empresa_nome string, voo string, aeronave string, assentos bigint, tipo string, hora_local string, data_extracao date"
_MONTHLY = "mes_ref date, aeroporto_icao string, od_icao string, od_iata string, empresa_icao string, empresa_nome string, partidas_mes bigint, " \
    "assentos_totais_mes bigint, data_extracao date"
_TYPED = ", ".join(
    "('{}', '{}', '{}', 0)".format(summary, *field.split()) for summary, fields in (("daily", _DAILY), ("monthly", _MONTHLY)) for field in fields.split(", "))
SQL = {
    "market_empty": f'select summary, "column", type, cast(rows as bigint) as rows from (values {_TYPED}) v(summary, "column", type, rows)',
    "archive_fingerprint": """
        with t as (select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crcs),
          d as (select doc_id, lang, text, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: cast('0x' || h as bigint)) as bytes from documents),
          c as (select d.*, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) as crc,
            'data/doc' || doc_id || case lang when 'en' then '.TXT' when 'fr' then '.bin' else '.' || lang || '.csv' end as name from d, t),
          p as (select xor(list_reduce(list_prepend(4294967295, [37, 80, 68, 70]), lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) as pdf from t)
        select 'in/' || doc_id || '.zip' as path, case when lang not in ('fr', 'es') then cast(crc as bigint) end as crc,
          case when lang <> 'es' then sha256(name || '|' || octet_length(encode(text)) || '|' || crc || chr(10) || 'leia-me.pdf|4|' || pdf) end as fingerprint,
          case lang when 'fr' then 'no_target' when 'es' then 'bad_zip' else 'ok' end as status
        from c, p""",
    "export_semicolon": f"""
        with o as (select {_LINE} from orders)
        select year, month, k || ';' || note || ';' || price || ';' || day as line from o
        union all select distinct year, month, '{BOM}o_orderkey;note;price;day' from o""",
    "export_comma": f"""
        select year || ',' || month || ',' || k || ',' || note || ',' || price || ',' || day as line from (select {_LINE} from orders)
        union all select 'year,month,o_orderkey,note,price,day'""",
    "write_refused": "select c_custkey, c_mktsegment, true as refused from customer",
    "rate_order": """
        select *, row_number() over (order by rate_key) as place from (
          select strftime(o_orderdate, '%Y - %m') as rate_key, cast(max(o_totalprice) as decimal(18,6)) as rate from orders group by all)""",
    "schedule_file_rows": """
        select cast(event_id as varchar) as id, case when event_type <> 'view' then event_type end as type, strftime(ts, '%d/%m/%Y %H:%M:%S') as when from events""",
    "inventory_floor_known": """
        with offer as (select distinct unnest(['basica', 'combinada']) as segment, strftime(o_orderdate, '%Y%m') as ref from orders),
          known as (select distinct strftime(o_orderdate, '%Y%m') as ref from orders
                    where year(o_orderdate) in (1996, 1999, 2000) and o_orderstatus = 'F' and month(o_orderdate) < 9),
          seen as (select max(ref) as newest from known where ref >= '1999')
        select segment, ref from offer, seen where segment = 'basica' and ref > newest and ref not in (select ref from known)
        union all
        select segment, ref from offer where segment = 'combinada' and ref >= '1999' qualify row_number() over (order by ref desc) <= 12""",
    "run_history": """
        with l as (
          select cast(year(l_shipdate) as int) as year, cast(month(l_shipdate) as int) as month, l_linestatus = 'F' as dep, l_linenumber < 4 as fare,
            l_returnflag, l_linenumber from lineitem),
          r as (
            select 1 as run, year, month, count(*) as rows, count(*) filter (fare) as with_fare, count(*) filter (dep) as departures from l group by all
            union all
            select 2, year, month, count(*), count(*) filter (fare and (l_returnflag <> 'R' or month <> 3)), count(*) filter (dep) from l
            where not (year = 1997 and month = 5 and l_linenumber = 5) group by all),
          s as (select *, with_fare / rows as share, lag(with_fare / rows) over m as share_before, lag(rows) over m as rows_before
                from r window m as (partition by year, month order by run))
        select run, year, month, rows, with_fare, departures, round(share, 9) as share, round(share_before, 9) as share_before,
          coalesce(share_before - share > 0.01 or rows < rows_before, false) as fell from s""",
    "routed_tables": f"""
        with o as (
          select case substr(o_orderpriority, 1, 1) when '1' then 'movimentacao' when '2' then 'movimentacao' when '3' then 'ticket' when '4' then 'siros_mensal' else 'siros' end as target,
            case substr(o_orderpriority, 1, 1) when '1' then 'basica/' || strftime(o_orderdate, '%Y%m') when '2' then 'combinada/' || strftime(o_orderdate, '%Y%m')
              when '3' then 'tarifas/dom/' || year(o_orderdate) when '4' then '{L.FROZEN_PREFIX}' || strftime(o_orderdate, '%Y-%m') else 'siros/voos' || o_orderstatus end as key,
            o_orderkey, o_orderstatus <> 'F' as late from orders)
        select target, key, count(*) as rows, cast(sum(o_orderkey) as bigint) as total from o
        where late or (target <> 'siros' and (target, key) not in (select (target, key) from o where late)) group by all""",
    "pending_rates": """
        with o as (select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, o_totalprice as p, o_orderstatus as s from orders),
          used as (select year, month, max(p) as rate from o where s = 'F' group by all),
          now as (select year, month, max(p) as rate from o where s in ('F', 'P') and month <> 7 group by all)
        select distinct year, month from o where year = 1996
        union
        select year, month from used left join now using (year, month) where used.rate is distinct from now.rate""",
    "landing_order": """
        with o as (select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, cast(o_orderkey as varchar) as c,
            o_orderpriority = '1-URGENT' as dashed, o_orderdate as d, o_orderstatus as s from orders),
          found as (select * from o where s <> 'F' or month = 4 qualify row_number() over (partition by year, month order by dashed desc, d desc, c desc) = 1),
          ind as (select * from o where s = 'F' and year < 2000 qualify row_number() over (partition by year, month order by dashed desc, d desc, c desc) = 1)
        select f.year, f.month, f.c as sha256, f.dashed, coalesce(f.c = i.c, false) as known from found f left join ind i on i.year = f.year and i.month = f.month
        where i.c is null or f.dashed > i.dashed or (f.dashed = i.dashed and f.d >= i.d)""",
}
