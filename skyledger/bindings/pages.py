"""Pages, listings and publication tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.bindings.raw import table
from skyledger.operators.dedup import keep_last
from skyledger.sources import landing, pages
from skyledger.bindings.values import _names


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of the crawled pages, resolved; per page the last one of each target name counts."""
    found = pages.links(table(spark, sf_dir, "pages"), ["page_id"])
    named = found.withColumn("name", F.lower(F.regexp_extract("link", r"([^/]*)$", 1)))
    return keep_last(named, ["page_id", "name"], ["position"])


def inventory_from_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per order, its URL with or without a slash at the end, that links the archive of its month, in either form of name."""
    month = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM")).otherwise(F.date_format("o_orderdate", "yyyyMM"))
    segment = F.when(F.col("o_orderpriority") == "5-LOW", "Combinada").otherwise("basica")
    folder = F.when(F.col("o_orderstatus") == "P", "/files/").when(F.col("o_orderstatus") == "O", "../").otherwise("")
    html = F.concat(
        F.lit("<p>Arquivos</p><a HREF = '"), folder, segment, month, F.lit(".zip?download=1'>x</a><a href=\"basica.zip\">y</a>")
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", html.alias("html"),
        F.concat(F.lit("https://data.example.org/open/air/microdados"), F.when(F.col("o_custkey") % 2 == 0, "/").otherwise("")).alias("url"),
    )
    return pages.inventory(orders, "o_orderkey")


def page_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates shown on a page per order, with tags and line breaks between label and date."""
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    html = F.concat(
        F.lit("<div>Publicado em 01/01/1990</div><b>PUBLICADO</b>\n em: "), day,
        F.when(F.col("o_orderstatus") == "F", F.lit(" às 10h30")).otherwise(F.lit("")),
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("<i>atualizado em</i> - "), day, F.lit("\t07:05"))).otherwise(F.lit("<i>atualizado</i>")),
    )
    return pages.page_dates(table(spark, sf_dir, "orders").select("o_orderkey", html.alias("html")), ["o_orderkey"])


def listing_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory listing per order: its archive, one without a size, and one of the lines."""
    line = F.concat(
        F.date_format("o_orderdate", "M/d/yyyy"), F.lit("  <b>5:19 AM</b>     "), F.col("o_totalprice").cast("bigint").cast("string"),
        F.lit(" <A HREF=\"/x\">o"), F.col("o_orderkey").cast("string"), F.lit(".zip</A><br>"),
    )
    html = F.concat(F.lit("<pre>[up]<br>"), line, F.lit("7/1/2026 1:00 PM &lt;dir&gt; old<br>9/30/2026 11:05pm 12 b.ZIP</pre>"))
    return pages.listing(table(spark, sf_dir, "orders").select("o_orderkey", html.alias("html")), ["o_orderkey"])


def publication_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table row per order under three orders of columns; some rows are titles or footers."""
    when = F.when(F.col("o_orderpriority") == "5-LOW", "Data Hora").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm"))
    name, year = F.concat(F.lit(" f"), F.col("o_orderkey").cast("string"), F.lit(".CSV ")), F.date_format("o_orderdate", "yyyy")
    month, size = F.date_format("o_orderdate", "M"), F.col("o_custkey").cast("string")
    header = (
        F.when(F.col("o_orderstatus") == "F", F.array(*map(F.lit, ["Nome do Arquivo", "Data Hora", "Ano Referência", "Mês Referência", "Tamanho"])))
        .when(F.col("o_orderstatus") == "O", F.array(*map(F.lit, ["Marcar", "TAMANHO (KB)", "Mes Referencia", "Ano referencia", "data hora publicação", "nome do arquivo"])))
        .otherwise(F.array(*map(F.lit, ["Nome do arquivo", "Data Hora"])))
    )
    cells = (
        F.when(F.col("o_orderstatus") == "F", F.array(name, when, year, month, size))
        .when(F.col("o_orderstatus") == "O", F.array(F.lit(""), size, month, year, when, name))
        .otherwise(F.when(F.col("o_orderpriority") == "2-HIGH", F.array(name, when)).otherwise(F.array(name, when, size)))
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", header.alias("header"), cells.alias("cells"))
    return pages.publications(rows, ["o_orderkey"])


def discover_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movement and fare files among the file names made of the orders, one per kind and month."""
    return landing.discover(_names(spark, sf_dir).drop("o_orderkey"))


QUERIES = {
    "page_links": page_links,
    "inventory_from_html": inventory_from_html,
    "page_dates": page_dates,
    "listing_parse": listing_parse,
    "publication_parse": publication_parse,
    "discover_landing": discover_landing,
}

SQL = {
    "page_links": r"""
        with hits as (
          select page_id, url, regexp_extract_all(html, 'href\s*=\s*["'']([^"'']+)["'']', 1, 'i') as refs from pages),
        found as (
          select page_id, url, unnest(refs) as href, generate_subscripts(refs, 1) - 1 as position from hits),
        linked as (
          select page_id, cast(position as int) as position, string_split(href, '?')[1] as h, url,
            regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) as root,
            regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$', '') as folder from found),
        resolved as (
          select page_id, position, case when h like '%://%' then h when h like '/%' then root || h
            else root || case when folder = '' then '/' else folder end || h end as link from linked)
        select page_id, position, link, lower(regexp_extract(link, '([^/]*)$', 1)) as name from resolved
        qualify row_number() over (partition by page_id, lower(regexp_extract(link, '([^/]*)$', 1)) order by position desc) = 1""",
    "inventory_from_html": """
        with o as (select o_orderkey, case o_orderpriority when '5-LOW' then 'combinada' else 'basica' end as segment,
            strftime(o_orderdate, '%Y%m') as ref,
            case o_orderstatus when 'P' then 'https://data.example.org/files/' when 'O' then 'https://data.example.org/open/air/'
              else 'https://data.example.org/open/air/microdados/' end
            || case o_orderpriority when '5-LOW' then 'Combinada' else 'basica' end
            || case o_orderstatus when 'F' then strftime(o_orderdate, '%Y-%m') else strftime(o_orderdate, '%Y%m') end
            || '.zip' as url from orders)
        select segment, ref, arg_max(url, o_orderkey) as url from o group by all""",
    "page_dates": """
        select o_orderkey, strftime(o_orderdate, '%d/%m/%Y') || case o_orderstatus when 'F' then ' 10h30' else '' end as published,
          case o_orderpriority when '5-LOW' then strftime(o_orderdate, '%d/%m/%Y') || ' 07:05' end as updated from orders""",
    "listing_parse": """
        select o_orderkey, 'o' || o_orderkey || '.zip' as name, month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate)
          || ' 5:19 AM' as published_at, cast(trunc(o_totalprice) as bigint) as bytes from orders
        union all
        select o_orderkey, 'b.ZIP', '9/30/2026 11:05pm', 12 from orders""",
    "publication_parse": """
        select o_orderkey, 'f' || o_orderkey || '.CSV' as file, strftime(o_orderdate, '%d/%m/%Y %H:%M') as published_at,
          case o_orderstatus when 'P' then '' else strftime(o_orderdate, '%Y') end as year,
          case o_orderstatus when 'P' then '00' else strftime(o_orderdate, '%m') end as month,
          case o_orderstatus when 'P' then '' else cast(o_custkey as varchar) end as size
        from orders where o_orderpriority <> '5-LOW' and not (o_orderstatus = 'P' and o_orderpriority = '2-HIGH')""",
    "discover_landing": """
        with o as (
          select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
            case o_orderpriority when '1-URGENT' then 'tarifas/dom' when '2-HIGH' then 'tarifas/dom' when '3-MEDIUM' then 'tarifas/int'
              else case o_orderstatus when 'F' then 'basica' when 'O' then 'combinada' end end as kind,
            case o_orderpriority when '1-URGENT' then strftime(o_orderdate, '%Y%m') || '.CSV'
              when '2-HIGH' then 'raw/' || strftime(o_orderdate, '%Y%m') || ' (1).csv'
              when '3-MEDIUM' then 'INTERNACIONAL_' || strftime(o_orderdate, '%Y-%m') || '(02).CSV'
              else case o_orderstatus when 'F' then 'in/basica' || strftime(o_orderdate, '%Y%m') || '.txt'
                else 'in/Combinada' || strftime(o_orderdate, '%Y-%m') || '.TXT' end end as path
          from orders)
        select kind, year, month, min(path) as path from o where kind is not null group by all""",
}
