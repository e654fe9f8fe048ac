"""What has been collected, what is new, and what is left to do: table differences.

The manifest has one row per tracked key, ``segment/ref``. Its columns keep the names of the
manifest file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.operators.dedup import keep_last, last_rows
from skyledger.operators.lookup import lookup_join

# fixed values: fields of a manifest entry
FIELDS = {
    "url": "string", "impressao": "string", "sha256": "string", "bytes_zip": "bigint", "publicado_em": "string",
    "situacao": "string", "meses": "map<string,string>", "coletado_em": "string", "verificado_em": "string",
    "detalhe": "string",
}
MANIFEST = ", ".join(["key string"] + [f"{name} {kind}" for name, kind in FIELDS.items()])
_GIVEN = [name for name in FIELDS if name not in ("coletado_em", "verificado_em")]
_ENTRY = ", ".join(f"{name}: {kind}" for name, kind in FIELDS.items())


def from_json(documents: DataFrame, column: str = "value") -> DataFrame:
    """Manifest rows of manifest documents, one document per row."""
    entries = F.from_json(F.col(column), f"struct<arquivos: map<string, struct<{_ENTRY}>>>").getField("arquivos")
    return documents.select(F.explode(entries).alias("key", "entry")).select("key", "entry.*")


def with_parts(manifest: DataFrame) -> DataFrame:
    """The key taken apart: ``tarifas/dom/2026`` -> segment ``tarifas/dom``, ref ``2026``."""
    return manifest.withColumns({
        "segment": F.regexp_extract("key", r"^(.*)/[^/]*$", 1), "ref": F.regexp_extract("key", r"([^/]*)$", 1),
    })


def collected(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("situacao").isin(L.COLLECTED))


# --- changing the manifest ---------------------------------------------------------------


def register(manifest: DataFrame, updates: DataFrame, now: Column, order: Sequence[str] = ()) -> DataFrame:
    """Fields that the updates have replace the old ones, also with a null; the first sighting stays; the
    last check is ``now``.

    Of several updates of a key the last by ``order`` counts, and of those that it leaves equal the one
    with the greatest values.
    """
    given = [name for name in _GIVEN if name in updates.columns]
    comparable = [name for name in given if not FIELDS[name].startswith("map")]
    single = keep_last(updates.select("key", *dict.fromkeys([*given, *order])), ["key"], [*order, *comparable] or ["key"])
    new = single.select("key", F.lit(True).alias("_new"), *[F.col(name).alias(f"_{name}") for name in given])
    both = manifest.join(new, "key", "full")
    return both.select(
        "key",
        *[
            (F.when(F.col("_new"), F.col(f"_{name}")).otherwise(F.col(name)) if name in given else F.col(name)).alias(name)
            for name in FIELDS if name in _GIVEN
        ],
        F.coalesce("coletado_em", now).alias("coletado_em"),
        F.when(F.col("_new"), now).otherwise(F.col("verificado_em")).alias("verificado_em"),
    )


def forget(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    return lookup_join(manifest, keys.select("key").distinct(), {"key": "key"}, "left_anti")


def newest_month(manifest: DataFrame) -> DataFrame:
    """The newest tracked leg month."""
    return manifest.where(F.col("key").startswith("basica/")).agg(F.max(F.substring_index("key", "/", -1)).alias("ref"))


def current_month_keys(manifest: DataFrame, today: Column) -> DataFrame:
    """Keys of the newest tracked month, of the schedule and of the domestic fares of that year."""
    ref = F.col("ref")
    year = F.coalesce(F.left(ref, F.lit(4)), F.date_format(today, "yyyy"))
    keys = F.array(
        F.concat(F.lit("basica/"), ref), F.concat(F.lit("combinada/"), ref),
        F.lit(L.SCHEDULE_KEY), F.concat(F.lit("tarifas/dom/"), year),
    )
    return newest_month(manifest).select(F.explode(keys).alias("key")).where(F.col("key").isNotNull())


def year_keys(months: DataFrame, year: str = "year") -> DataFrame:
    """Every key of each given year: twelve months of both segments, the schedule, both fares."""

    def months_of(segment: str) -> Column:
        month = F.sequence(F.lit(1), F.lit(12))
        return F.transform(month, lambda m: F.format_string(f"{segment}/%d%02d", F.col(year), m))

    keys = F.concat(
        *[months_of(segment) for segment in L.SEGMENTS],
        F.array(F.lit(L.SCHEDULE_KEY)),
        F.array(*[F.concat(F.lit(f"tarifas/{kind}/"), F.col(year).cast("string")) for kind in ("dom", "int")]),
    )
    return months.select(F.explode(keys).alias("key")).distinct()


# --- inventory against manifest ----------------------------------------------------------


def known_refs(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    """Collected refs that the inventory still shows."""
    have = with_parts(collected(manifest)).select("segment", "ref", "bytes_zip")
    shown = inventory.select("segment", "ref").distinct()
    return lookup_join(have, shown, {"segment": "segment", "ref": "ref"}, "left_semi")


def missing_refs(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    have = with_parts(collected(manifest)).select("segment", "ref").distinct()
    return lookup_join(inventory, have, {"segment": "segment", "ref": "ref"}, "left_anti")


def _with_newest(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    newest = known_refs(inventory, manifest).groupBy("segment").agg(F.max("ref").alias("newest"))
    return lookup_join(missing_refs(inventory, manifest), newest, {"segment": "segment"})


def refs_to_collect(
    inventory: DataFrame, manifest: DataFrame, backfill: bool = False,
    first_run: int = L.FIRST_RUN_MONTHS, oldest_year: int | None = L.OLDEST_YEAR,
) -> DataFrame:
    """Refs to fetch: all gaps in a backfill, the last few on the first run of a segment, else the
    refs above the newest known one. The year floor holds for all but a backfill."""
    if backfill:
        return missing_refs(inventory, manifest)
    visible = inventory if oldest_year is None else inventory.where(F.left("ref", F.lit(4)).try_cast("int") >= oldest_year)
    open_refs = _with_newest(visible, manifest)
    later = open_refs.where(F.col("ref") > F.col("newest"))
    first = last_rows(open_refs.where(F.col("newest").isNull()), ["segment"], [F.desc("ref")], first_run)
    return later.unionByName(first).drop("newest")


def older_gaps(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    """Number of uncollected refs below the newest known one, per segment."""
    below = _with_newest(inventory, manifest).where(F.col("ref") < F.col("newest"))
    return below.groupBy("segment").agg(F.count("*").alias("gaps"))


def changed_size(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    """Known refs whose announced size differs from the collected one; unknown sizes do not count."""
    have = with_parts(collected(manifest)).where(F.col("bytes_zip") > 0)
    have = have.select("segment", "ref", F.col("bytes_zip").alias("bytes_before"))
    both = lookup_join(inventory.where(F.col("bytes").isNotNull()), have, {"segment": "segment", "ref": "ref"}, "inner")
    return both.where(F.col("bytes") != F.col("bytes_before"))


def collection_plan(
    inventory: DataFrame, manifest: DataFrame, first_run: int = L.FIRST_RUN_MONTHS, oldest_year: int | None = L.OLDEST_YEAR
) -> DataFrame:
    """What a collection run has to fetch, and why: refs above the newest known one (``new``), the last few of a segment
    on its first run (``first run``), and known refs whose announced size is another one (``size``). The year floor holds
    for all of them."""
    visible = inventory if oldest_year is None else inventory.where(F.left("ref", F.lit(4)).try_cast("int") >= oldest_year)
    started = known_refs(visible, manifest).select("segment").distinct().withColumn("_started", F.lit(True))
    fresh = lookup_join(refs_to_collect(visible, manifest, first_run=first_run, oldest_year=None), started, {"segment": "segment"})
    why = F.when(F.col("_started"), "new").otherwise("first run")
    moved = changed_size(visible, collected(manifest))
    return fresh.select("segment", "ref", why.alias("reason")).unionByName(moved.select("segment", "ref", F.lit("size").alias("reason")))


def inventory_totals(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("segment").agg(
        F.count("*").alias("total"), F.min("ref").alias("first"), F.max("ref").alias("last")
    )


def page_changed(now: DataFrame, before: DataFrame, forced: bool = False) -> DataFrame:
    """Per page whether to sweep: its date is there and is another one than before, or forced."""
    earlier = before.select("page", F.col("updated").alias("updated_before"))
    both = lookup_join(now, earlier, {"page": "page"})
    changed = (F.coalesce(F.col("updated"), F.lit("")) != "") & ~F.col("updated").eqNullSafe(F.col("updated_before"))
    return both.withColumn("sweep", changed | F.lit(forced))


# --- candidates against manifest ---------------------------------------------------------


def classify(candidates: DataFrame, manifest: DataFrame, changed: str = L.REPUBLISHED) -> DataFrame:
    """State of each fetched item by its fingerprint; ``changed`` names the state of another content.

    ``failure`` (``indisponivel`` / ``erro`` or null) goes before the fingerprint.
    """
    before = manifest.select("key", F.col("impressao").alias("_before"))
    both = lookup_join(candidates, before, {"key": "key"})
    state = (
        F.when(F.col("failure").isNotNull(), F.col("failure"))
        .when(F.col("_before").isNull(), L.NEW)
        .when(F.col("_before") == F.col("impressao"), L.UNCHANGED)
        .otherwise(changed)
    )
    return both.withColumn("situacao", state).drop("_before")


def month_changes(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Fare years by their month dates: months that are new or changed, and the state of the year."""
    before = manifest.select("key", F.col("meses").alias("_before"))
    both = lookup_join(candidates, before, {"key": "key"}).withColumn(
        "_before", F.coalesce("_before", F.create_map().cast("map<string,string>"))
    )
    old = F.col("_before")
    fresh = F.map_filter("meses", lambda month, _: ~F.map_contains_key(old, month))
    moved = F.map_filter(
        "meses", lambda month, when: F.map_contains_key(old, month) & ~F.try_element_at(old, month).eqNullSafe(when)
    )
    marked = both.withColumns({"new_months": fresh, "changed_months": moved})
    untouched = (F.size("new_months") == 0) & (F.size("changed_months") == 0)
    state = (
        F.when(F.coalesce(F.size("meses"), F.lit(0)) <= 0, L.UNAVAILABLE)
        .when(untouched, L.UNCHANGED).when(F.size("_before") > 0, L.UPDATED).otherwise(L.NEW)
    )
    return marked.withColumn("situacao", state).drop("_before")


def last_published(months: Column) -> Column:
    """Latest publication time of the months of a year, compared as times."""
    return F.array_max(F.transform(
        F.map_values(months),
        lambda text: F.coalesce(
            F.try_to_timestamp(text, F.lit("d/M/yyyy H:m:s")), F.try_to_timestamp(text, F.lit("d/M/yyyy H:m"))
        ),
    ))


def schedule_skippable(listing: DataFrame, manifest: DataFrame, forced: bool = False) -> DataFrame:
    """Whether the announced schedule is the one already there.

    ``listing`` has key, published_at and bytes; without an announced date the size decides.
    """
    before = manifest.select("key", F.col("publicado_em").alias("_date"), F.col("bytes_zip").alias("_bytes"))
    both = lookup_join(listing, before, {"key": "key"})
    same_size = F.coalesce(F.col("bytes") == F.col("_bytes"), F.lit(False))
    same_date = F.col("published_at").isNull() | F.coalesce(F.col("published_at") == F.col("_date"), F.lit(False))
    return both.withColumn("skip", same_size & same_date & ~F.lit(forced)).drop("_date", "_bytes")


def years_to_check(manifest: DataFrame, offered: DataFrame, oldest_year: int = L.OLDEST_YEAR) -> DataFrame:
    """Fare year to look at per kind: after a December the next year, but only if it is offered;
    without history the newest year on offer. ``offered`` has segment and year."""
    months = with_parts(manifest).where(F.col("segment").startswith("tarifas/")).select(
        "segment", F.col("ref").try_cast("int").alias("y"), F.explode(F.map_keys("meses")).alias("m")
    )
    newest = months.where(F.col("y") >= oldest_year).groupBy("segment").agg(
        F.max(F.struct("y", F.col("m").try_cast("int").alias("m"))).alias("last")
    )
    visible = offered.where(F.col("year") >= oldest_year)
    tops = visible.groupBy("segment").agg(F.max("year").alias("top"))
    wanted = lookup_join(tops, newest, {"segment": "segment"}).select(
        "segment",
        F.when(F.col("last").isNull(), F.col("top")).when(F.col("last.m") == 12, F.col("last.y") + 1)
        .otherwise(F.col("last.y")).alias("year"),
    )
    return lookup_join(wanted, visible.distinct(), {"segment": "segment", "year": "year"}, "left_semi")


# --- work that is left -------------------------------------------------------------------


def complete_pairs(legs: DataFrame, combined: DataFrame, keys: Sequence[str] = ("year", "month")) -> DataFrame:
    """Months that have both sides; each side is made unique first, so what meets is one row per month."""
    sides = [side.select(*keys).distinct() for side in (legs, combined)]
    return lookup_join(sides[0], sides[1], {key: key for key in keys}, "left_semi")


def incomplete_pairs(legs: DataFrame, combined: DataFrame, keys: Sequence[str] = ("year", "month")) -> DataFrame:
    """Months with one side only, and the side that is missing."""
    sides = legs.select(*keys).distinct().withColumn("_side", F.lit(1)).unionByName(
        combined.select(*keys).distinct().withColumn("_side", F.lit(2))
    )
    return sides.groupBy(*keys).agg(F.sum("_side").alias("_sides")).where(F.col("_sides") < 3).select(
        *keys, F.when(F.col("_sides") == 1, L.SEGMENTS[1]).otherwise(L.SEGMENTS[0]).alias("missing")
    )


def months_available(pairs: DataFrame, fares: DataFrame, keys: Sequence[str] = ("year", "month")) -> DataFrame:
    return pairs.select(*keys).union(fares.select(*keys)).distinct()


def pending(
    available: DataFrame, finished: DataFrame, forced: bool = False, keys: Sequence[str] = ("year", "month", "impressao"),
    reopened: DataFrame | None = None,
) -> DataFrame:
    """Months not finished with the present content of their input, and those of ``reopened`` (the keys without the content),
    which depend on something else that has changed."""
    if forced:
        return available
    done = finished.select(*keys).distinct()
    if reopened is not None:
        period = [name for name in keys if name in reopened.columns]
        done = lookup_join(done, reopened.select(*period).distinct(), {name: name for name in period}, "left_anti")
    return lookup_join(available, done, {key: key for key in keys}, "left_anti")


# --- status report -----------------------------------------------------------------------


def latest_collected(manifest: DataFrame) -> DataFrame:
    """The newest collected ref of each segment with its attributes."""
    rows = with_parts(collected(manifest))
    attributes = ["ref", "verificado_em", "bytes_zip", "situacao"]
    best = rows.groupBy("segment").agg(F.max_by(F.struct(*attributes), "ref").alias("best"))
    return best.select("segment", "best.*")


def latest_fare_month(manifest: DataFrame) -> DataFrame:
    """The newest month of each fare kind, its date, and the attributes of the last valid entry."""
    rows = with_parts(manifest).where(F.col("key").startswith("tarifas/") & (F.size("meses") > 0))
    months = rows.select("segment", "ref", F.explode("meses").alias("m", "published_at")).groupBy("segment").agg(
        F.max_by(F.struct(F.concat("ref", "m").alias("month"), "published_at"), F.concat("ref", "m")).alias("top")
    )
    attributes = ["verificado_em", "bytes_zip", "situacao"]
    entries = collected(rows).groupBy("segment").agg(F.max_by(F.struct(*attributes), "key").alias("entry"))
    return lookup_join(months, entries, {"segment": "segment"}).select("segment", "top.*", "entry.*")


def coverage(manifest: DataFrame, totals: DataFrame) -> DataFrame:
    """Collected refs of all the refs on the page, per segment."""
    have = with_parts(collected(manifest)).groupBy("segment").agg(F.count("*").alias("have"))
    return lookup_join(totals, have, {"segment": "segment"}).select(
        "segment", "last", F.coalesce("have", F.lit(0)).alias("collected"), "total"
    )


def problems(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("situacao").isin(L.PROBLEMS)).select("key", "situacao", "detalhe")


def republished(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("situacao") == L.REPUBLISHED).select("key")


def tracked(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count("*").alias("tracked"),
        F.count_if(F.col("situacao").isin(L.PROBLEMS)).alias("problems"),
        F.count_if(F.col("situacao") == L.REPUBLISHED).alias("republished"),
    )


def status(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row for each segment of the manifest or the inventory: its newest collected ref with its attributes, the newest
    fare month and its date, how much of what is on offer is collected, and how many entries have problems or are republished.

    One grouped pass over each of the two.
    """
    have = F.col("situacao").isin(L.COLLECTED)
    attributes = F.struct("ref", "verificado_em", "bytes_zip", "situacao")
    month = F.array_max(F.map_keys("meses"))
    fare = F.struct(F.concat("ref", month).alias("month"), F.try_element_at("meses", month).alias("published_at"))
    entries = with_parts(manifest).groupBy("segment").agg(
        F.max_by(attributes, F.when(have, F.col("ref"))).alias("latest"), F.max_by(fare, F.concat("ref", month)).alias("fare"),
        F.count("*").alias("tracked"), F.count_if(have).alias("collected"),
        F.count_if(F.col("situacao").isin(L.PROBLEMS)).alias("problems"), F.count_if(F.col("situacao") == L.REPUBLISHED).alias("republished"),
    )
    counts = [F.coalesce(name, F.lit(0)).alias(name) for name in ("tracked", "collected", "problems", "republished")]
    latest = [F.when(F.col("collected") > 0, F.col(f"latest.{name}")).alias(name) for name in ("ref", "verificado_em", "bytes_zip", "situacao")]
    return entries.join(inventory_totals(inventory), "segment", "full").select(
        "segment", *latest, F.col("fare.month").alias("fare_month"), F.col("fare.published_at").alias("fare_published_at"), *counts, "total", "first", "last"
    )


def to_look_at(manifest: DataFrame) -> DataFrame:
    """``key, situacao, detalhe`` of the entries with problems and of those that were republished."""
    again = manifest.where(F.col("situacao") == L.REPUBLISHED).select("key", "situacao", "detalhe")
    return problems(manifest).unionByName(again)
