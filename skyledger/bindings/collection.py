"""Inventory against manifest, manifest changes, open work and status."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.bindings.raw import table
from skyledger.operators.sums import set_digest
from skyledger.plans import collection, runs, state
from skyledger.session import scratch_folder
from skyledger.sinks.tables import Snapshots

NOW = "2026-12-01T06:00:00+00:00"


def _segment() -> Column:
    return F.concat_ws("-", "source", "lang")


def _ref() -> Column:
    return F.lpad(F.col("doc_id").cast("string"), 9, "0")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the archives on offer: source and language are the segment, the id is the ref."""
    return table(spark, sf_dir, "documents").select(
        _segment().alias("segment"), _ref().alias("ref"), F.col("n_chars").alias("bytes"), F.md5("text").alias("impressao")
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as what has been tracked: the good ones are collected, the others failed,
    and a toxic one has changed since."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    changed = F.col("toxic") == 1
    known = documents.join(labels, "doc_id").select(
        F.concat(_segment(), F.lit("/"), _ref()).alias("key"),
        F.when(changed, F.md5(F.concat("text", F.lit("!")))).otherwise(F.md5("text")).alias("impressao"),
        (F.col("n_chars") + F.col("toxic")).cast("bigint").alias("bytes_zip"),
        F.when(F.col("quality") == 1, F.when(changed, L.REPUBLISHED).otherwise(L.NEW)).otherwise(
            F.when(changed, L.FAILED).otherwise(L.UNAVAILABLE)).alias("situacao"),
        F.lit("2026-11-01T06:00:00+00:00").alias("coletado_em"), F.lit("2026-11-02T06:00:00+00:00").alias("verificado_em"),
    )
    return known.select("key", *[
        F.col(name).cast(kind).alias(name) if name in known.columns else F.lit(None).cast(kind).alias(name)
        for name, kind in state.FIELDS.items()
    ])


def inventory_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.refs_to_collect(inventory(spark, sf_dir), manifest(spark, sf_dir), oldest_year=None)


def inventory_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for orders as months on offer, with the year floor; labels do not cover them, so every
    segment is on its first run."""
    months = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("segment"), F.date_format("o_orderdate", "yyyyMM").alias("ref")
    ).distinct()
    return state.refs_to_collect(months, manifest(spark, sf_dir), oldest_year=2000)


def inventory_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.refs_to_collect(inventory(spark, sf_dir), manifest(spark, sf_dir), backfill=True)


def inventory_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.older_gaps(inventory(spark, sf_dir), manifest(spark, sf_dir))


def inventory_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.changed_size(inventory(spark, sf_dir).drop("impressao"), manifest(spark, sf_dir))


def collection_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to fetch of all documents on offer, and why."""
    return state.collection_plan(inventory(spark, sf_dir), manifest(spark, sf_dir), oldest_year=None)


def inventory_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.inventory_totals(inventory(spark, sf_dir))


def manifest_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a fetched archive; the very short ones could not be read."""
    candidates = inventory(spark, sf_dir).select(
        F.concat_ws("/", "segment", "ref").alias("key"), "impressao", F.when(F.col("bytes") < 100, L.UNAVAILABLE).alias("failure")
    )
    return state.classify(candidates, manifest(spark, sf_dir)).select("key", "situacao")


def manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are registered again, with a state and a size that is null for short ones, and each one twice: the
    second time counts."""
    updates = inventory(spark, sf_dir).select(
        F.concat_ws("/", "segment", "ref").alias("key"), F.when(F.col("bytes") > 1000, F.col("bytes")).alias("bytes_zip"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("turn"),
    ).withColumn("situacao", F.when(F.col("turn") == 2, L.UNCHANGED).otherwise(L.NEW))
    done = state.register(manifest(spark, sf_dir), updates, F.lit(NOW), ["turn"])
    return done.select("key", "impressao", "bytes_zip", "situacao", "coletado_em", "verificado_em")


def manifest_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest file per document, with an entry for it and one that knows a month only."""
    key = F.concat(_segment(), F.lit("/"), _ref())
    entry = F.struct(F.md5("text").alias("impressao"), F.col("n_chars").alias("bytes_zip"), F.create_map(F.lit("05"), F.lit("d")).alias("meses"))
    other = F.struct(F.lit(None).cast("string").alias("impressao"), F.lit(None).cast("bigint").alias("bytes_zip"), F.create_map(F.lit("06"), _ref()).alias("meses"))
    files = F.to_json(F.struct(F.create_map(key, entry, F.concat(key, F.lit("b")), other).alias("arquivos")))
    found = state.from_json(table(spark, sf_dir, "documents").select(files.alias("value")))
    return found.select("key", "impressao", "bytes_zip", "url", F.element_at("meses", F.lit("06")).alias("june"))


def newest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest leg month among the orders as tracked months of both segments."""
    key = F.concat_ws("/", F.when(F.col("o_orderstatus") == "F", "basica").otherwise("combinada"), F.date_format("o_orderdate", "yyyyMM"))
    return state.newest_month(table(spark, sf_dir, "orders").select(key.alias("key")))


def manifest_forget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries of toxic documents are forgotten."""
    documents = table(spark, sf_dir, "documents").select("doc_id", _segment().alias("segment"), _ref().alias("ref"))
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").join(documents, "doc_id").select(F.concat_ws("/", "segment", "ref").alias("key"))
    return state.forget(manifest(spark, sf_dir), toxic).select("key", "situacao")


def _months(orders: DataFrame, key) -> DataFrame:
    """Fare years with the latest day of each of their months: at most twelve entries per key."""
    days = orders.groupBy(key.alias("key"), F.date_format("o_orderdate", "MM").alias("m")).agg(
        F.date_format(F.max("o_orderdate"), "dd/MM/yyyy HH:mm").alias("d")
    )
    return days.groupBy("key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("m", "d")))).alias("meses"))


def fare_months_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fare years whose months are new or have another date than when only filled orders were known."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderstatus")
    year_key = F.concat(F.lit("tarifas/dom/"), F.date_format("o_orderdate", "yyyy"))
    before = _months(orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("2001-03-01"))), year_key)
    now = _months(orders, year_key)
    return state.month_changes(now, before).select(
        "key", "situacao", F.array_join(F.array_sort(F.map_keys("new_months")), ",").alias("new_months"),
        F.array_join(F.array_sort(F.map_keys("changed_months")), ",").alias("changed_months"),
        state.last_published(F.col("meses")).cast("date").alias("last_published"),
    )


def _fare_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fare years per market segment that are known up to the last filled order."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    known = orders.where(F.col("o_orderstatus") == "F").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    key = F.concat(F.lit("tarifas/"), F.lower("c_mktsegment"), F.lit("/"), F.date_format("o_orderdate", "yyyy"))
    return _months(known, key).withColumns({
        "situacao": F.when(F.col("key").endswith("2001"), L.FAILED).otherwise(L.UPDATED),
        "verificado_em": F.lit(NOW), "bytes_zip": F.size("meses").cast("bigint"),
    })


def fare_years_to_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year to look at per market segment; years are on offer as far as there are orders."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    offered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("tarifas/"), F.lower("c_mktsegment")).alias("segment"), F.year("o_orderdate").alias("year")
    ).distinct()
    return state.years_to_check(_fare_manifest(spark, sf_dir), offered, oldest_year=1996)


def status_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_fare_month(_fare_manifest(spark, sf_dir))


def status_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_collected(manifest(spark, sf_dir))


def status_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.coverage(manifest(spark, sf_dir), inventory_totals(spark, sf_dir))


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.tracked(manifest(spark, sf_dir))


def status_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = state.problems(manifest(spark, sf_dir)).select("key", "situacao")
    return bad.unionByName(state.republished(manifest(spark, sf_dir)).withColumn("situacao", F.lit(L.REPUBLISHED)))


def schedule_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an announced schedule, some without a date."""
    documents = table(spark, sf_dir, "documents")
    listing = documents.select(
        F.concat(_segment(), F.lit("/"), _ref()).alias("key"), F.when(F.col("lang") != "en", F.col("lang")).alias("published_at"),
        F.col("n_chars").alias("bytes"),
    )
    before = manifest(spark, sf_dir).withColumn("publicado_em", F.lit("fr"))
    return state.schedule_skippable(listing, before).select("key", "skip")


def page_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as pages: the balance is the date shown now, without cents the one before."""
    shown = F.when(F.col("c_nationkey") > 2, F.col("c_acctbal").cast("string")).otherwise("")
    now = table(spark, sf_dir, "customer").select(F.col("c_name").alias("page"), shown.alias("updated"))
    before = table(spark, sf_dir, "customer").where("c_nationkey < 20").select(
        F.col("c_name").alias("page"), F.round("c_acctbal", 1).cast("string").alias("updated")
    )
    return state.page_changed(now, before).select("page", "sweep")


def pending_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with orders and with shipments are the two sides; what is finished has the content of
    the days before 1998."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    day = ["day"]
    legs = orders.select(F.col("o_orderdate").cast("date").alias("day"))
    shipped = lines.select(F.col("l_shipdate").cast("date").alias("day"))
    pairs = state.complete_pairs(legs, shipped, day)
    content = orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("impressao"))
    available = pairs.join(content, "day")
    finished = orders.where((F.col("o_orderdate") < F.lit("1998-01-01")) & (F.col("o_orderpriority") != "9")).groupBy(
        F.col("o_orderdate").cast("date").alias("day")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("impressao"))
    return state.pending(available, finished, keys=["day", "impressao"]).select("day")


def pairs_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return state.incomplete_pairs(
        orders.select(F.col("o_orderdate").cast("date").alias("day")), lines.select(F.col("l_shipdate").cast("date").alias("day")), ["day"]
    )


def months_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    ordered = orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    shipped = lines.select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))
    return state.months_available(ordered, shipped)


def content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of the documents of each source, whatever their order."""
    return set_digest(table(spark, sf_dir, "documents"), ["source"], ["doc_id", "lang", "n_chars", "text"])


def _all_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, the fare years and the schedule in one manifest."""
    events = table(spark, sf_dir, "events")
    flights = events.agg(F.count("*").alias("bytes_zip")).select(
        F.lit(L.SCHEDULE_KEY).alias("key"), (F.col("bytes_zip") - 1).alias("bytes_zip"), F.lit("1/2/2026 3:04 AM").alias("publicado_em"), F.lit(L.NEW).alias("situacao")
    )
    others = [_fare_manifest(spark, sf_dir), flights]
    return reduce(lambda rows, more: rows.unionByName(more, allowMissingColumns=True), others, manifest(spark, sf_dir))


def collection_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection run over documents on offer by language pages, fare years and a schedule; what it plans is fetched, and the
    next run is over the same pages. Both plans, and the states at the end.

    The English and German pages have another date than before, the French one has not, the Spanish one shows none. The
    schedule has grown by a byte.
    """
    root = scratch_folder(spark, "collection")
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    fares = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("tarifas/"), F.lower("c_mktsegment")).alias("segment"), F.year("o_orderdate").alias("year"), F.date_format("o_orderdate", "MM").alias("month"), "o_orderdate")
    published = fares.groupBy("segment", "year", "month").agg(F.date_format(F.max("o_orderdate"), "dd/MM/yyyy HH:mm").alias("published_at"))
    documents = table(spark, sf_dir, "documents")
    offer = inventory(spark, sf_dir).withColumn("page", F.substring_index("segment", "-", -1))
    shown = F.when(F.col("lang") == "es", "").otherwise(F.max("doc_id").cast("string"))
    pages = documents.groupBy("lang").agg(shown.alias("updated")).select(F.col("lang").alias("page"), F.lit(None).cast("string").alias("published"), "updated")
    before = pages.where("page <> 'de'").withColumn("swept", F.when(F.col("page") == "en", "0").otherwise(F.col("updated")))
    listing = table(spark, sf_dir, "events").agg(F.count("*").alias("bytes")).select(F.lit("VOOS.zip").alias("name"), F.lit("1/2/2026 3:04 AM").alias("published_at"), "bytes")
    Snapshots(spark, f"{root}/manifest").replace(_all_tracked(spark, sf_dir))
    Snapshots(spark, f"{root}/pages").replace(before)
    seen = {"pages": pages, "offered": fares.select("segment", "year").distinct(), "publications": published, "listing": listing, "oldest_year": 0}

    runs.collect(spark, root, offer, **seen)
    plans = Snapshots(spark, f"{root}/collection_plan")
    first = plans.read().drop("planned")
    key = F.concat_ws("/", "segment", "ref").alias("key")
    content = offer.select(key, "impressao", F.col("bytes").alias("bytes_zip"))
    got = first.select(key).join(content, "key", "left").join(collection.month_maps(published), "key", "left")
    schedule = F.col("key") == L.SCHEDULE_KEY
    got = got.select(
        "key", F.coalesce("impressao", F.md5("key")).alias("impressao"), F.lit(None).cast("string").alias("failure"), "meses",
        F.when(schedule, F.lit(table(spark, sf_dir, "events").count())).otherwise(F.col("bytes_zip")).alias("bytes_zip"),
        F.when(schedule, "1/2/2026 3:04 AM").alias("publicado_em"),
    )
    runs.collect(spark, root, offer, got, **seen)
    rows = [first.withColumn("step", F.lit("plan")), plans.read().withColumn("step", F.lit("again"))]
    planned = [part.select("step", key, "reason", F.array_join("months", ",").alias("months")) for part in rows]
    states = Snapshots(spark, f"{root}/manifest").read().select(
        F.lit("state").alias("step"), "key", F.col("situacao").alias("reason"), F.array_join(F.array_sort(F.map_keys("meses")), ",").alias("months"))
    return reduce(DataFrame.unionByName, [*planned, states])


def collection_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of documents, fare years and the schedule, written by a run and read back."""
    root = scratch_folder(spark, "status")
    Snapshots(spark, f"{root}/manifest").replace(_all_tracked(spark, sf_dir))
    return runs.report(spark, root, inventory(spark, sf_dir))


def manifest_forget_preset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of orders as tracked legs, with the schedule and fares: one year is forgotten, then what the newest month brings."""
    root = scratch_folder(spark, "forget")
    month, year = F.date_format("o_orderdate", "yyyyMM"), F.date_format("o_orderdate", "yyyy")
    keys = F.array(*[F.concat(F.lit(f"{segment}/"), month) for segment in L.SEGMENTS], *[F.concat(F.lit(f"tarifas/{kind}/"), year) for kind in ("dom", "int")], F.lit(L.SCHEDULE_KEY))
    known = table(spark, sf_dir, "orders").select(F.explode(keys).alias("key")).distinct()
    book = Snapshots(spark, f"{root}/manifest")
    book.replace(known.select("key", *[F.lit(None).cast(kind).alias(name) for name, kind in state.FIELDS.items()]))
    runs.forget(spark, root, date(2001, 1, 1), year=1997)
    runs.forget(spark, root, date(2001, 1, 1))
    return book.read().select("key")


QUERIES = {
    "collection_run": collection_run,
    "collection_status": collection_status,
    "manifest_forget_preset": manifest_forget_preset,
    "inventory_new": inventory_new,
    "inventory_floor": inventory_floor,
    "inventory_backfill": inventory_backfill,
    "inventory_gaps": inventory_gaps,
    "inventory_changed": inventory_changed,
    "collection_plan": collection_plan,
    "inventory_totals": inventory_totals,
    "manifest_classify": manifest_classify,
    "manifest_upsert": manifest_upsert,
    "manifest_from_json": manifest_from_json,
    "newest_month": newest_month,
    "manifest_forget": manifest_forget,
    "fare_months_changed": fare_months_changed,
    "fare_years_to_check": fare_years_to_check,
    "status_fares": status_fares,
    "status_latest": status_latest,
    "status_coverage": status_coverage,
    "status_counts": status_counts,
    "status_problems": status_problems,
    "schedule_skip": schedule_skip,
    "page_gate": page_gate,
    "pending_periods": pending_periods,
    "pairs_incomplete": pairs_incomplete,
    "months_available": months_available,
    "content_fingerprint": content_fingerprint,
}

_INVENTORY = """(select source || '-' || lang as segment, lpad(cast(doc_id as varchar), 9, '0') as ref, n_chars as bytes,
    md5(text) as impressao from documents)"""
_MANIFEST = """(select source || '-' || lang as segment, lpad(cast(doc_id as varchar), 9, '0') as ref,
    source || '-' || lang || '/' || lpad(cast(doc_id as varchar), 9, '0') as key,
    case toxic when 1 then md5(text || '!') else md5(text) end as impressao, n_chars + toxic as bytes_zip, quality, toxic,
    case quality when 1 then case toxic when 1 then 'republicado' else 'novo' end
      else case toxic when 1 then 'erro' else 'indisponivel' end end as situacao
    from documents join labels using (doc_id))"""
_OPEN = f"""
    with inv as {_INVENTORY}, known as (select * from {_MANIFEST} where quality = 1),
      newest as (select segment, max(ref) as newest from known group by all),
      missing as (select inv.*, newest from inv left join newest using (segment)
                  where (inv.segment, inv.ref) not in (select (segment, ref) from known))"""
_FARE_ROWS = """
    with o as (select 'tarifas/' || lower(c_mktsegment) as segment, * from orders join customer on o_custkey = c_custkey),
      m as (select segment, cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m, max(o_orderdate) as d
            from o where o_orderstatus = 'F' group by all)"""

_RUN = f"""{_OPEN},
      docs as (
        select segment, ref, 'new' as reason from missing where ref > newest
        union all
        select segment, ref, 'first run' from (
          select * from missing where newest is null qualify row_number() over (partition by segment order by ref desc) <= 12)
        union all
        select segment, ref, 'size' from {_INVENTORY} join {_MANIFEST} using (segment, ref)
        where quality = 1 and bytes_zip > 0 and bytes <> bytes_zip and split_part(segment, '-', 2) in ('en', 'de')),
      o as (select 'tarifas/' || lower(c_mktsegment) as segment, * from orders join customer on o_custkey = c_custkey),
      shown as (select segment, year(o_orderdate) as y, month(o_orderdate) as m, max(o_orderdate) as d from o group by all),
      had as (select segment, year(o_orderdate) as y, month(o_orderdate) as m, max(o_orderdate) as d from o where o_orderstatus = 'F' group by all),
      last as (select segment, max(y * 100 + m) as ym from had group by all),
      tops as (select segment, max(y) as top from shown group by all),
      wanted as (select segment, case when ym is null then top when ym % 100 = 12 then ym // 100 + 1 else ym // 100 end as y from tops left join last using (segment)),
      due as (select w.segment, w.y, lpad(cast(s.m as varchar), 2, '0') as m, h.d is null or h.d <> s.d as moved
              from wanted w join shown s using (segment, y) left join had h using (segment, y, m)),
      moved as (select segment, y, string_agg(m, ',' order by m) as months from due where moved group by all)"""

SQL = {
    "collection_run": f"""{_RUN},
          plan as (
            select 'plan' as step, segment || '/' || ref as key, reason, null as months from docs
            union all select 'plan', segment || '/' || y, 'months', months from moved
            union all select 'plan', '{L.SCHEDULE_KEY}', 'announced', null),
          doc_states as (
            select m.key, m.situacao, m.impressao from {_MANIFEST} m),
          states as (
            select coalesce(p.key, s.key) as key,
              case when p.key is null then s.situacao when s.key is null then 'novo' when s.impressao = i.impressao then 'inalterado' else 'republicado' end as reason,
              null as months
            from (select segment || '/' || ref as key, segment, ref from docs) p full join doc_states s on s.key = p.key left join inv i on i.segment = p.segment and i.ref = p.ref
            union all
            select segment || '/' || y, case when (segment, y) in (select (segment, y) from due) then 'inalterado' when y = 2001 then 'erro' else 'atualizado' end,
              string_agg(distinct lpad(cast(m as varchar), 2, '0'), ',' order by lpad(cast(m as varchar), 2, '0'))
            from (select segment, y, m from had union select segment, y, cast(m as bigint) from due) group by segment, y
            union all select '{L.SCHEDULE_KEY}', 'inalterado', null)
        select step, key, reason, months from plan
        union all select 'state', key, reason, months from states""",
    "collection_status": f"""{_FARE_ROWS},
          e as (
            select segment, ref, '2026-11-02T06:00:00+00:00' as verificado_em, bytes_zip, situacao, null as fm, null as fd from {_MANIFEST}
            union all
            select segment, cast(y as varchar), '{NOW}', count(*), case when y = 2001 then 'erro' else 'atualizado' end,
              y || lpad(cast(max(m) as varchar), 2, '0'), strftime(arg_max(d, m), '%d/%m/%Y %H:%M') from m group by segment, y
            union all select 'siros', 'voos', null, (select count(*) - 1 from events), 'novo', null, null),
          c as (select *, situacao in ('novo', 'atualizado', 'republicado', 'inalterado') as have from e),
          g as (
            select segment, max(case when have then ref end) as ref, max(fm) as fare_month, arg_max(fd, fm) as fare_published_at, count(*) as tracked,
              count(*) filter (have) as collected, count(*) filter (situacao in ('erro', 'indisponivel')) as problems,
              count(*) filter (situacao = 'republicado') as republished
            from c group by segment),
          t as (select segment, count(*) as total, min(ref) as first, max(ref) as last from {_INVENTORY} group by segment)
        select segment, g.ref, c.verificado_em, c.bytes_zip, c.situacao, fare_month, fare_published_at, coalesce(tracked, 0) as tracked,
          coalesce(collected, 0) as collected, coalesce(problems, 0) as problems, coalesce(republished, 0) as republished, total, first, last
        from g full join t using (segment) left join c on c.segment = g.segment and c.ref = g.ref""",
    "manifest_forget_preset": f"""
        with k as (
          select distinct unnest(['basica/' || strftime(o_orderdate, '%Y%m'), 'combinada/' || strftime(o_orderdate, '%Y%m'),
            'tarifas/dom/' || year(o_orderdate), 'tarifas/int/' || year(o_orderdate), '{L.SCHEDULE_KEY}']) as key from orders),
          y as (select key from k where not regexp_matches(key, '/1997(..)?$') and key <> '{L.SCHEDULE_KEY}'),
          n as (select max(split_part(key, '/', 2)) as ref from y where starts_with(key, 'basica/'))
        select key from y, n where key not in ('basica/' || ref, 'combinada/' || ref, 'tarifas/dom/' || ref[1:4])""",
    "inventory_new": f"""{_OPEN}
        select segment, ref, bytes, impressao from missing where ref > newest
        union all
        select segment, ref, bytes, impressao from (
          select * from missing where newest is null qualify row_number() over (partition by segment order by ref desc) <= 12)""",
    "inventory_floor": """
        select segment, ref from (
          select distinct o_orderpriority as segment, strftime(o_orderdate, '%Y%m') as ref from orders where year(o_orderdate) >= 2000)
        qualify row_number() over (partition by segment order by ref desc) <= 12""",
    "inventory_backfill": f"{_OPEN} select segment, ref, bytes, impressao from missing",
    "inventory_gaps": f"{_OPEN} select segment, count(*) as gaps from missing where ref < newest group by all",
    "inventory_changed": f"""
        select segment, ref, bytes, bytes_zip as bytes_before from {_INVENTORY} join {_MANIFEST} using (segment, ref)
        where quality = 1 and bytes_zip > 0 and bytes <> bytes_zip""",
    "collection_plan": f"""{_OPEN}
        select segment, ref, 'new' as reason from missing where ref > newest
        union all
        select segment, ref, 'first run' from (
          select * from missing where newest is null qualify row_number() over (partition by segment order by ref desc) <= 12)
        union all
        select segment, ref, 'size' from {_INVENTORY} join {_MANIFEST} using (segment, ref)
        where quality = 1 and bytes_zip > 0 and bytes <> bytes_zip""",
    "inventory_totals": f'select segment, count(*) as total, min(ref) as first, max(ref) as last from {_INVENTORY} group by all',
    "manifest_classify": f"""
        select i.segment || '/' || i.ref as key, case when bytes < 100 then 'indisponivel' when m.impressao is null then 'novo'
          when m.impressao = i.impressao then 'inalterado' else 'republicado' end as situacao
        from {_INVENTORY} i left join {_MANIFEST} m using (segment, ref)""",
    "manifest_upsert": f"""
        with i as (select * from {_INVENTORY})
        select coalesce(i.segment || '/' || i.ref, m.key) as key, m.impressao,
          case when i.ref is null then m.bytes_zip when i.bytes > 1000 then i.bytes end as bytes_zip,
          case when i.ref is not null then 'inalterado' else m.situacao end as situacao,
          case when m.key is not null then '2026-11-01T06:00:00+00:00' else '{NOW}' end as coletado_em,
          case when i.ref is not null then '{NOW}' else '2026-11-02T06:00:00+00:00' end as verificado_em
        from i full join {_MANIFEST} m using (segment, ref)""",
    "manifest_from_json": f"""
        select segment || '/' || ref as key, impressao, bytes as bytes_zip, cast(null as varchar) as url, cast(null as varchar) as june from {_INVENTORY}
        union all
        select segment || '/' || ref || 'b', null, null, null, ref from {_INVENTORY}""",
    "newest_month": "select max(strftime(o_orderdate, '%Y%m')) as ref from orders where o_orderstatus = 'F'",
    "manifest_forget": f"select key, situacao from {_MANIFEST} where toxic = 0",
    "fare_months_changed": """
        with n as (select strftime(o_orderdate, '%Y') as y, strftime(o_orderdate, '%m') as m, max(o_orderdate) as d from orders group by all),
          b as (select strftime(o_orderdate, '%Y') as y, strftime(o_orderdate, '%m') as m, max(o_orderdate) as d from orders
                where o_orderstatus = 'F' and o_orderdate < date '2001-03-01' group by all),
          j as (select n.y, n.m, n.d, b.d as before from n left join b on n.y = b.y and n.m = b.m),
          s as (select y, max(d) as last, count(before) as known, count(*) filter (before is null) as fresh,
              count(*) filter (before <> d) as moved,
              coalesce(string_agg(m, ',' order by m) filter (before is null), '') as new_months,
              coalesce(string_agg(m, ',' order by m) filter (before <> d), '') as changed_months from j group by y)
        select 'tarifas/dom/' || y as key, new_months, changed_months, cast(last as date) as last_published,
          case when fresh = 0 and moved = 0 then 'inalterado' when known > 0 then 'atualizado' else 'novo' end as situacao from s""",
    "fare_years_to_check": f"""{_FARE_ROWS},
          last as (select segment, arg_max(y, y * 100 + m) as y, max(y * 100 + m) % 100 as m from m where y >= 1996 group by all),
          offered as (select distinct segment, cast(year(o_orderdate) as int) as year from o where year(o_orderdate) >= 1996),
          tops as (select segment, max(year) as top from offered group by all),
          wanted as (select segment, cast(case when y is null then top when m = 12 then y + 1 else y end as int) as year
                     from tops left join last using (segment))
        select segment, year from wanted where (segment, year) in (select (segment, year) from offered)""",
    "status_fares": f"""{_FARE_ROWS},
          top as (select segment, arg_max(y || lpad(cast(m as varchar), 2, '0'), y * 100 + m) as month,
              arg_max(strftime(d, '%d/%m/%Y %H:%M'), y * 100 + m) as published_at from m group by all),
          entry as (select segment, arg_max(n, y) as bytes_zip from (
              select segment, y, count(*) as n from m where y <> 2001 group by all) group by all)
        select segment, month, published_at, case when bytes_zip is not null then '{NOW}' end as verificado_em, bytes_zip,
          case when bytes_zip is not null then 'atualizado' end as situacao
        from top left join entry using (segment)""",
    "status_latest": f"""
        select segment, max(ref) as ref, '2026-11-02T06:00:00+00:00' as verificado_em, arg_max(bytes_zip, ref) as bytes_zip,
          arg_max(situacao, ref) as situacao from {_MANIFEST} where quality = 1 group by segment""",
    "status_coverage": f"""
        select segment, max(i.ref) as last, count(*) filter (quality = 1) as collected, count(*) as total
        from {_INVENTORY} i left join {_MANIFEST} m using (segment, ref) group by segment""",
    "status_counts": f"""
        select count(*) as tracked, count(*) filter (quality = 0) as problems, count(*) filter (quality = 1 and toxic = 1) as republished
        from {_MANIFEST}""",
    "status_problems": f"select key, situacao from {_MANIFEST} where situacao <> 'novo'",
    "schedule_skip": f"""
        select d.source || '-' || d.lang || '/' || lpad(cast(d.doc_id as varchar), 9, '0') as key,
          coalesce(m.toxic = 0 and d.lang in ('en', 'fr'), false) as skip
        from documents d left join {_MANIFEST} m on m.key = d.source || '-' || d.lang || '/' || lpad(cast(d.doc_id as varchar), 9, '0')""",
    "page_gate": """
        select c_name as page, c_nationkey > 2 and (c_nationkey >= 20 or c_acctbal <> round(c_acctbal, 1)) as sweep from customer""",
    "pending_periods": """
        select distinct cast(o_orderdate as date) as day from orders
        where o_orderdate >= date '1998-01-01' and cast(o_orderdate as date) in (select cast(l_shipdate as date) from lineitem)""",
    "pairs_incomplete": """
        with a as (select distinct cast(o_orderdate as date) as day from orders),
          b as (select distinct cast(l_shipdate as date) as day from lineitem)
        select coalesce(a.day, b.day) as day, case when b.day is null then 'combinada' else 'basica' end as missing
        from a full join b on a.day = b.day where a.day is null or b.day is null""",
    "months_available": """
        select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month from orders
        union
        select cast(year(l_shipdate) as int), cast(month(l_shipdate) as int) from lineitem""",
    "content_fingerprint": """
        with h as (select source, sha256(doc_id || '|' || lang || '|' || n_chars || '|' || text) as h from documents),
          w as (select source, count(*) as members, """ + ", ".join(
              f"sum(cast('0x' || substr(h, {8 * i + 1}, 8) as bigint)) as w{i}" for i in range(8)) + """ from h group by source)
        select source, members, sha256(concat_ws('|', members, """ + ", ".join(f"w{i}" for i in range(8)) + """)) as fingerprint from w""",
}
