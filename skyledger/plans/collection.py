"""One collection run over all publishers: what to fetch and why, and what is seen to be as it was.

Four rules meet here. Movement archives: refs above the newest known one, and known refs of another size, these only while
the page that shows them has another date than when it was last swept. Fares: the year that follows from the months known, by
its table of months. The schedule: its announced date and size. A backfill takes all gaps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.operators.lookup import lookup_join
from skyledger.plans import state

#: State of the pages: ``swept`` is the date of the page when its refs were last found to have the sizes known.
PAGES = "page string, published string, updated string, swept string"
PLAN = "segment string, ref string, reason string, months array<string>"
_FARES = "tarifas/"


def gate(pages: DataFrame, before: DataFrame, forced: bool = False) -> DataFrame:
    """``page, published, updated, sweep``: pages that show another date than at their last sweep."""
    last = before.select("page", F.col("swept").alias("updated"))
    return state.page_changed(pages, last, forced).select("page", "published", "updated", "sweep")


def movements(
    inventory: DataFrame, manifest: DataFrame, opened: DataFrame | None = None, backfill: bool = False,
    first_run: int = L.FIRST_RUN_MONTHS, oldest_year: int | None = L.OLDEST_YEAR,
) -> DataFrame:
    """``segment, ref, reason`` of movement archives to fetch.

    ``opened`` is the result of ``gate``; sizes then count only for refs of an inventory ``page`` that is to be swept. Without
    pages all sizes count.
    """
    floor = None if backfill else oldest_year
    planned = state.collection_plan(inventory, manifest, first_run, floor)
    if backfill:
        gaps = state.missing_refs(inventory, manifest).select("segment", "ref", F.lit("backfill").alias("reason"))
        planned = planned.where("reason = 'size'").unionByName(gaps)
    if opened is None or "page" not in inventory.columns:
        return planned
    swept = lookup_join(inventory.select("segment", "ref", "page"), opened.where("sweep").select("page"), {"page": "page"}, "left_semi")
    refs = swept.select("segment", "ref").distinct().withColumn("_swept", F.lit(True))
    return lookup_join(planned, refs, {"segment": "segment", "ref": "ref"}).where((F.col("reason") != "size") | F.col("_swept")).drop("_swept")


def month_maps(publications: DataFrame) -> DataFrame:
    """``key, meses`` of published fare tables (``segment, year, month, published_at``): the latest time of each month."""
    when = F.coalesce(*[F.try_to_timestamp("published_at", F.lit(form)) for form in ("d/M/yyyy H:m:s", "d/M/yyyy H:m")])
    rows = publications.where(F.col("month").rlike("^(0[1-9]|1[0-2])$")).select(
        F.concat_ws("/", "segment", F.col("year").cast("string")).alias("key"), "month", "published_at", when.alias("_when"))
    latest = rows.groupBy("key", "month").agg(F.max_by("published_at", F.struct("_when", "published_at")).alias("at"))
    # at most twelve entries a key
    return latest.groupBy("key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("month", "at")))).alias("meses"))


def fare_years(
    manifest: DataFrame, offered: DataFrame, publications: DataFrame | None, complete: bool = False, oldest_year: int = L.OLDEST_YEAR
) -> DataFrame:
    """``key, segment, ref, meses, new_months, changed_months, situacao`` of the fare years that are due: one of each kind,
    or with ``complete`` all on offer. A year whose table is empty is ``indisponivel``; without ``publications`` nothing
    is known of the months and ``situacao`` is null."""
    years = offered.where(F.col("year") >= oldest_year).distinct() if complete else state.years_to_check(manifest, offered, oldest_year)
    due = years.select(F.concat_ws("/", "segment", F.col("year").cast("string")).alias("key"), "segment", F.col("year").cast("string").alias("ref"))
    none = F.create_map().cast("map<string,string>")
    if publications is None:
        empty = F.lit(None).cast("map<string,string>")
        return due.select("*", *[empty.alias(name) for name in ("meses", "new_months", "changed_months")], F.lit(None).cast("string").alias("situacao"))
    shown = lookup_join(due, month_maps(publications), {"key": "key"}).withColumn("meses", F.coalesce("meses", none))
    return state.month_changes(shown, manifest).select("key", "segment", "ref", "meses", "new_months", "changed_months", "situacao")


def schedule_listing(listing: DataFrame, key: str = L.SCHEDULE_KEY, archive: str = L.SCHEDULE_ARCHIVE) -> DataFrame:
    """The line of the schedule in a directory listing (``name, published_at, bytes``); without it a line that announces nothing."""
    line = listing.where(F.lower("name") == archive).agg(F.max(F.struct("published_at", "bytes")).alias("line"))
    return line.select(F.lit(key).alias("key"), "line.*")


def plan(moves: DataFrame, years: DataFrame | None = None, announced: DataFrame | None = None) -> DataFrame:
    """``segment, ref, reason, months``: ``new``, ``first run``, ``backfill`` and ``size`` for movements, ``months`` for a fare year with
    new or other months, ``look`` for one whose table has not been read, ``announced`` for the schedule."""
    none = F.lit(None).cast("array<string>").alias("months")
    parts = [moves.select("segment", "ref", "reason", none)]
    if years is not None:
        due = years.where(F.col("situacao").isNull() | F.col("situacao").isin(L.NEW, L.UPDATED))
        months = F.array_sort(F.concat(F.map_keys("new_months"), F.map_keys("changed_months")))
        why = F.when(F.col("situacao").isNull(), "look").otherwise("months")
        parts.append(due.select("segment", "ref", why.alias("reason"), months.alias("months")))
    if announced is not None:
        parts.append(state.with_parts(announced.where(~F.col("skip"))).select("segment", "ref", F.lit("announced").alias("reason"), none))
    return reduce(DataFrame.unionByName, parts)


def seen(years: DataFrame | None, announced: DataFrame | None) -> list[DataFrame]:
    """Manifest updates for what was looked at and needs no fetch: unchanged fare years with their months, empty ones, and a
    schedule that is announced as it was."""
    updates = []
    if years is not None:
        updates.append(years.where(F.col("situacao") == L.UNCHANGED).select("key", "meses", "situacao"))
        updates.append(years.where(F.col("situacao") == L.UNAVAILABLE).select("key", "situacao"))
    if announced is not None:
        updates.append(announced.where("skip").select("key", F.lit(L.UNCHANGED).alias("situacao")))
    return updates


def classified(fetched: DataFrame, manifest: DataFrame) -> DataFrame:
    """State of what was fetched. Movements and schedule go by their fingerprint (another content is ``republicado``, of the
    schedule ``atualizado``), fare years by their months if these are given, and ``failure`` goes before both."""
    by_content = state.classify(fetched, manifest)
    renewed = F.when((F.col("situacao") == L.REPUBLISHED) & F.col("key").startswith("siros/"), L.UPDATED).otherwise(F.col("situacao"))
    by_content = by_content.withColumn("situacao", renewed)
    if "meses" not in fetched.columns:
        return by_content
    fares: Column = F.col("key").startswith(_FARES) & F.col("failure").isNull() & F.col("meses").isNotNull()
    marked = by_content.withColumn("_fares", F.coalesce(fares, F.lit(False)))
    by_months = state.month_changes(marked.where("_fares").drop("situacao"), manifest).drop("new_months", "changed_months")
    return marked.where(~F.col("_fares")).unionByName(by_months).drop("_fares")


def pages_after(opened: DataFrame, before: DataFrame, moves: DataFrame, inventory: DataFrame) -> DataFrame:
    """The pages' state: a page counts as swept once none of its refs has another size than the one known, so a fetch
    that fails leaves the gate open."""
    left = moves.where("reason = 'size'").select("segment", "ref")
    if "page" in inventory.columns:
        still = lookup_join(inventory.select("segment", "ref", "page"), left, {"segment": "segment", "ref": "ref"}, "left_semi").select("page")
    else:  # any ref may be of any page
        still = opened.select("page").limit(0) if left.isEmpty() else opened.select("page")
    known = before.select("page", F.col("published").alias("_published"), F.col("updated").alias("_updated"), "swept")
    now = lookup_join(opened, still.distinct().withColumn("_still", F.lit(True)), {"page": "page"})
    both = now.join(known, "page", "full")
    done = F.coalesce(F.col("sweep") & F.col("_still").isNull(), F.lit(False))
    return both.select(
        "page", F.coalesce("published", "_published").alias("published"), F.coalesce("updated", "_updated").alias("updated"),
        F.when(done, F.col("updated")).otherwise(F.col("swept")).alias("swept"),
    )
