"""Whole runs: new files to landed rows, landed rows to marts, all open months in one job.

Layout below the root folder: ``landed/{legs,combined,fares_dom,fares_int,schedule}``, ``index`` and ``schedule_index`` (what
has been landed, with its content hash and the time of its publication), ``files`` and ``schedule_files`` (what has been opened), ``staging`` (what a run has just parsed), ``dims/{airports,aircraft,airlines,rates}``,
``rates``, ``combined_sums``, ``fares``, ``mart``, ``finished``, ``schedule``, ``frozen``, ``running_year``, ``manifest``, ``pages``,
``collection_plan``, ``status``, ``to_look_at`` and ``run_issues``.
"""

from __future__ import annotations

from calendar import monthrange
from datetime import UTC, date, datetime
from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.operators.dedup import keep_last, upsert
from skyledger.operators.sums import set_digest
from skyledger.plans import collection, dimensions, fares, history, legs, markets, mart, schedule, state, years
from skyledger.sinks.tables import Snapshots, exists, export_text, observed_write, rate_table, write_periods
from skyledger.sources import archives
from skyledger.sources.landing import dashed, discover, not_older, unseen
from skyledger.sources.tables import rate_payload, with_period

PERIOD = ["year", "month"]
ISSUES = "path string, member string, problem string, lines bigint"
INDEX = "folder string, year int, month int, impressao string, modified timestamp, dashed boolean"
FILES = "path string, modified timestamp, bytes bigint"
_FARE_REQUIRED = [name for name in L.FARE_RAW if name not in ("sg_icao_retorno", "cd_classe_ida")]
# kind of file -> (landing folder, columns, encoding, lines above the header, columns a file cannot do without)
LANDING = {
    "basica": ("legs", L.LEG_RAW, "cp1252", 0, L.LEG_KEY),
    "combinada": ("combined", L.COMBINED_RAW, "cp1252", 0, [*L.LEG_KEY, "cd_cotran"]),
    "tarifas/dom": ("fares_dom", L.FARE_RAW, "cp1252", 0, _FARE_REQUIRED),
    "tarifas/int": ("fares_int", L.FARE_RAW, "cp1252", 0, _FARE_REQUIRED),
}
SCHEDULE_FILE = "voos.csv"
#: Tables that are replaced as a whole.
REPLACED = [
    "index", "schedule_index", "files", "schedule_files", "rates", "finished", "rate_use", "landed/schedule", "schedule", "manifest", "pages",
    "collection_plan", "status", "to_look_at", "running_year", "international_daily", "domestic_monthly",
]


def _table(spark: SparkSession, path: str, schema: str) -> tuple[Snapshots, DataFrame]:
    """A replaceable table and its rows, none if it has not been written yet."""
    book = Snapshots(spark, path)
    return book, book.read() if book.present() else spark.createDataFrame([], schema)


def _staged(df: DataFrame, root: str, name: str) -> DataFrame:
    """Written below ``staging`` and read again: parsed once, and safe from lost executors."""
    spark, path = df.sparkSession, f"{root}/staging/{name}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _note(issues: DataFrame, root: str) -> None:
    issues.select("path", "member", "problem", "lines").write.mode("append").parquet(f"{root}/run_issues")


def _unseen(spark: SparkSession, root: str, inbox: DataFrame, book: str) -> tuple[Snapshots, DataFrame, list]:
    """The book of files seen, its rows, and the files of the inbox that are not in it, by path, time and size alone."""
    files, seen = _table(spark, f"{root}/{book}", FILES)
    return files, seen, unseen(archives.listed(inbox), seen).collect()


def _see(files: Snapshots, seen: DataFrame, new: list) -> None:
    """Note files as seen; a path that comes again with other content has its new time."""
    files.replace(upsert(seen, files.spark.createDataFrame(new, FILES), ["path"]), allow_empty=True)


def land(spark: SparkSession, root: str, inbox: DataFrame) -> int:
    """Write the rows of new files as text columns, one folder per kind and month, and note their content; the
    number of files landed.

    ``inbox`` is what ``archives.files`` lists. Files whose path, time and size are known from an earlier run are not
    opened. Each new archive is opened once to list and hash its members, and a member whose content is new for its month once
    more to read it as text, which is parsed from there.
    Of two files for one month the one with the dashed name counts, then the newest publication, whichever inbox they
    come in: an older publication that comes later lands nothing. A month that comes again replaces its folder. A file that
    cannot be read whole, has no rows or lacks a column lands nothing and leaves what was there; each problem is
    one row of ``run_issues``, once for each content, and the others land.
    """
    files, seen, new_files = _unseen(spark, root, inbox, "files")
    if not new_files:
        return 0
    opened = archives.reread(spark, [row["path"] for row in new_files])
    members = _staged(archives.archive_members(opened), root, "members")
    unreadable = members.where(F.col("status") != "ok")
    _note(unreadable.select("path", "member", F.col("status").alias("problem"), F.lit(1).cast("bigint").alias("lines")), root)
    found = discover(members.where(F.col("status") == "ok"), "member")
    folder_of = F.create_map(*[F.lit(part) for kind, (folder, *_) in LANDING.items() for part in (kind, folder)])
    found = found.withColumns({"folder": folder_of[F.col("kind")], "modified": F.col("modificationTime"), "dashed": dashed(F.col("member"))})
    book, index = _table(spark, f"{root}/index", INDEX)
    # at most one file per kind and calendar month
    candidates = not_older(found, index).collect()
    noted = [row for row in candidates if row["known"]]
    landed = []
    for kind, (folder, columns, encoding, skip, required) in LANDING.items():
        mine = [row for row in candidates if row["kind"] == kind and not row["known"]]
        if not mine:
            continue
        wanted: dict[str, list[str]] = {}
        for row in mine:
            wanted.setdefault(row["path"], []).append(row["member"])
        chosen = F.broadcast(spark.createDataFrame(list(wanted.items()), "path string, members array<string>"))
        source = archives.reread(spark, list(wanted)).join(chosen, "path")
        rows = archives.file_rows(source, columns, encoding, skip, required, f"{root}/staging/{folder}-text")
        parsed = _staged(rows, root, folder)
        _note(archives.run_issues(parsed), root)
        whole = parsed.where(F.col("problem").isNotNull() & F.col("line").isNull())
        failed = {(row["path"], row["member"]) for row in whole.select("path", "member").distinct().collect()}
        good = [row for row in mine if (row["path"], row["member"]) not in failed and (row["path"], None) not in failed]
        keep = F.struct("path", "member").isin([F.struct(F.lit(row["path"]), F.lit(row["member"])) for row in good])
        if good:
            rows = with_period(archives.good_rows(parsed).where(keep), "member")
            write_periods(rows.drop("path", "member"), f"{root}/landed/{folder}")
        landed += good
    entries = [tuple(row[name] for name in ("folder", *PERIOD, "sha256", "modified", "dashed")) for row in noted + landed]
    if entries:
        book.replace(upsert(index, spark.createDataFrame(entries, INDEX), ["folder", *PERIOD]), allow_empty=True)
    _see(files, seen, new_files)
    return len(landed)


def land_schedule(spark: SparkSession, root: str, inbox: DataFrame) -> bool:
    """Replace the landed schedule by the newest publication; without a newer readable one of other content the old one stays.

    Files that were seen before are not opened.
    """
    files, seen, new_files = _unseen(spark, root, inbox, "schedule_files")
    if not new_files:
        return False
    members = archives.archive_members(archives.reread(spark, [row["path"] for row in new_files])).where(F.lower("member") == SCHEDULE_FILE)
    order = [F.desc("modificationTime"), F.desc("path")]
    newest = members.orderBy(*order).select("path", "member", "modificationTime", "sha256").head()
    book, before = _table(spark, f"{root}/schedule_index", INDEX)
    last = before.head()
    fresh = newest is not None and (last is None or (newest["modificationTime"] >= last["modified"] and newest["sha256"] != last["impressao"]))
    done = False
    if fresh:
        source = archives.reread(spark, [newest["path"]]).withColumn("members", F.array(F.lit(newest["member"])))
        columns = list(L.SCHEDULE_RAW.values())
        rows = archives.file_rows(source, columns, "utf-8-sig", 1, columns[:1], f"{root}/staging/schedule-text")
        parsed = _staged(rows, root, "schedule")
        _note(archives.run_issues(parsed), root)
        if parsed.where(F.col("problem").isNotNull() & F.col("line").isNull()).isEmpty():
            Snapshots(spark, f"{root}/landed/schedule").replace(archives.good_rows(parsed).drop("path", "member"))
            entry = ("schedule", None, None, newest["sha256"], newest["modificationTime"], False)
            book.replace(spark.createDataFrame([entry], INDEX))
            done = True
    _see(files, seen, new_files)
    return done


def collect(
    spark: SparkSession, root: str, inventory: DataFrame, fetched: DataFrame | None = None, pages: DataFrame | None = None,
    offered: DataFrame | None = None, publications: DataFrame | None = None, listing: DataFrame | None = None,
    forced: bool = False, backfill: bool = False, complete: bool = False, oldest_year: int = L.OLDEST_YEAR,
) -> DataFrame:
    """Note what has been fetched, then plan what to fetch next of all publishers: ``segment, ref, reason``.

    ``inventory`` has the refs on offer with their size and, if there are several, their ``page``; ``pages`` the dates that pages
    show (``page, published, updated``); ``offered`` the fare years on offer (``segment, year``) and ``publications`` the months of
    the fare tables that were opened (``segment, year, month, published_at``); ``listing`` the directory of the schedule (``name,
    published_at, bytes``). What is not given is not looked at. ``fetched`` has key, ``impressao``, ``failure`` and any other
    manifest field of what came in since the last run. ``forced`` sweeps all pages and plans the schedule whatever is announced,
    ``complete`` looks at every fare year, ``backfill`` at all gaps of the movements.

    The plan with the months of fare years is the newest version of ``collection_plan``. Running again without anything
    new plans the same and changes no state; with everything fetched it plans nothing.
    """
    book, manifest = _table(spark, f"{root}/manifest", state.MANIFEST)
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    if fetched is not None:
        told = collection.classified(fetched, manifest)
        # what could not be fetched keeps what was known of its content
        failed = told.where(F.col("failure").isNotNull()).select("key", "situacao", *[name for name in ("detalhe",) if name in told.columns])
        came = told.where(F.col("failure").isNull()).drop("failure")
        book.replace(state.register(state.register(manifest, came, now), failed, now))
        manifest = book.read()
    page_book, before = _table(spark, f"{root}/pages", collection.PAGES)
    opened = None if pages is None else collection.gate(pages, before, forced)
    moves = collection.movements(inventory, manifest, opened, backfill, oldest_year=oldest_year)
    years = None if offered is None else collection.fare_years(manifest, offered, publications, complete, oldest_year)
    announced = None
    if listing is not None:
        announced = state.schedule_skippable(collection.schedule_listing(listing), manifest, forced)

    planned = Snapshots(spark, f"{root}/collection_plan")
    planned.replace(collection.plan(moves, years, announced).withColumn("planned", F.current_timestamp()), allow_empty=True)
    updates = collection.seen(years, announced)
    if updates:
        # a fare year or the schedule: a handful of rows
        known = reduce(lambda rows, update: state.register(rows, update, now), updates, manifest)
        book.replace(known, allow_empty=True)
    if opened is not None:
        page_book.replace(collection.pages_after(opened, before, moves, inventory), allow_empty=True)
    return planned.read().select("segment", "ref", "reason")


def report(spark: SparkSession, root: str, inventory: DataFrame) -> DataFrame:
    """Write the status of all segments as the newest version of ``status``, and what to look at as that of ``to_look_at``; the
    first of them, read back."""
    _, manifest = _table(spark, f"{root}/manifest", state.MANIFEST)
    Snapshots(spark, f"{root}/to_look_at").replace(state.to_look_at(manifest), allow_empty=True)
    book = Snapshots(spark, f"{root}/status")
    book.replace(state.status(manifest, inventory), allow_empty=True)
    return book.read()


def forget(spark: SparkSession, root: str, today: date, keys: DataFrame | None = None, year: int | None = None) -> int:
    """Take entries out of the manifest, so that the next run collects them anew; how many there were.

    ``keys`` names them; else those of a ``year``; else those of the newest month, the schedule and the domestic fares of its year.
    """
    book, manifest = _table(spark, f"{root}/manifest", state.MANIFEST)
    if keys is None and year is not None:
        keys = state.year_keys(spark.range(1).select(F.lit(year).alias("year")))
    elif keys is None:
        keys = state.current_month_keys(manifest, F.lit(today))
    left = state.forget(manifest, keys)
    before = manifest.count()
    book.replace(left, allow_empty=True)
    return before - book.read().count()


def available_months(index: DataFrame, dims: str = "") -> DataFrame:
    """Months that have both movement files or fares, with one fingerprint over all their files; ``paired`` tells
    whether the movements are there. ``dims`` is the fingerprint of the dimensions, which are input of paired months."""
    entries = F.array_sort(F.collect_list(F.concat_ws("=", "folder", "impressao")))  # at most four per month
    months = index.groupBy(*PERIOD).agg(
        F.sha2(F.array_join(entries, "|"), 256).alias("impressao"),
        (F.count_if(F.col("folder").isin("legs", "combined")) == 2).alias("paired"),
        (F.count_if(F.col("folder").startswith("fares")) > 0).alias("_fares"),
    )
    known = months.where(F.col("paired") | F.col("_fares")).drop("_fares")
    return known.withColumn("impressao", F.when(F.col("paired"), F.concat_ws(":", "impressao", F.lit(dims))).otherwise(F.col("impressao")))


def dimension_fingerprint(spark: SparkSession, root: str) -> str:
    """One fingerprint over the rows of the dimensions that the legs are joined with."""
    found = []
    for name in ("aircraft", "airports"):
        rows = spark.read.parquet(f"{root}/dims/{name}")
        row = set_digest(rows.withColumn("_all", F.lit(1)), ["_all"], sorted(rows.columns)).head()
        found.append(row["fingerprint"] if row else "")
    return sha256("|".join(found).encode()).hexdigest()[:16]


def fill_in(
    spark: SparkSession, root: str, year: int | None = None, oldest_year: int = L.OLDEST_YEAR, forced: bool = False
) -> dict[str, int]:
    """Build every open month in one job and note it as finished: its fare table, and its part of the mart if both
    movement files are there.

    With ``year`` that year alone, whatever its age; else all years from ``oldest_year`` on. A month
    is open when its files, the dimensions or a rate of its fares are not those it was last built from. The counts of each
    month go to ``history``. What is joined to the legs is stored
    first, cabotage sums and fares, one folder per month.

    A month whose international fares lack a rate does not stop the others: it is built without these
    fares, is noted in ``run_issues`` and stays open. ``failed`` counts such months.
    """
    wanted = (F.col("year") == year) if year else (F.col("year") >= oldest_year)
    _, index = _table(spark, f"{root}/index", INDEX)
    finished, done = _table(spark, f"{root}/finished", "year int, month int, impressao string")
    # one row per calendar month, which then prunes the landed folders
    used_book, used = _table(spark, f"{root}/rate_use", "year int, month int, rate_key string, rate decimal(18,6)")
    rates = _rates(spark, root)
    available = available_months(index.where(wanted), dimension_fingerprint(spark, root))
    open_months = state.pending(available, done, forced, reopened=fares.changed_rates(used, rates)).collect()
    counts = {"rows": 0, "with_fare": 0, "departures": 0}
    if not open_months:
        return {**counts, "failed": 0}

    def stored(path: str, months) -> DataFrame | None:
        return spark.read.parquet(f"{root}/{path}").where(_months(months)) if exists(spark, f"{root}/{path}") else None

    domestic, international = stored("landed/fares_dom", open_months), stored("landed/fares_int", open_months)
    failed = []
    needed = used.limit(0)
    if international is not None:
        abroad = fares.fare_rows(international, comma=False)
        failed = fares.missing_rates(abroad, rates, PERIOD).collect()
        needed = fares.used_rates(abroad, rates)
    if failed:
        issues = [("fares_int", f"{r['year']}-{r['month']:02d}", f"no rate for {r['rate_key']}", r["rows"]) for r in failed]
        _note(spark.createDataFrame(issues, ISSUES), root)
        international = international.where(~_months(failed))
    routes = fare_routes(domestic, international, rates)
    if routes is not None:
        routes = _staged(routes, root, "fares")  # summed once, for the table and for the months that have any
        write_periods(routes, f"{root}/fares")
    used_book.replace(used.where(~_months(open_months)).unionByName(needed), allow_empty=True)
    paired = [row for row in open_months if row["paired"]]
    if paired:
        write_periods(legs.combined_sums(stored("landed/combined", paired)), f"{root}/combined_sums")
        dims = {name: spark.read.parquet(f"{root}/dims/{name}") for name in ("airports", "aircraft")}
        leg_table = legs.leg_table(
            stored("landed/legs", paired), stored("combined_sums", paired), dimensions.aircraft(dims["aircraft"]), dimensions.airports(dims["airports"])
        )
        # a month without fares in this run may still have a folder of an earlier one
        with_fares = set() if routes is None else {tuple(row) for row in routes.select(*PERIOD).distinct().collect()}
        priced = [row for row in paired if (row["year"], row["month"]) in with_fares]
        current = stored("fares", priced) if priced else None
        counts = observed_write(mart.mart(leg_table, current), f"{root}/mart")
        history.note(stored("mart", paired), f"{root}/history", datetime.now(UTC))
    late = {(row["year"], row["month"]) for row in failed}
    built = [(row["year"], row["month"], row["impressao"]) for row in open_months if (row["year"], row["month"]) not in late]
    finished.replace(upsert(done, spark.createDataFrame(built, done.schema), PERIOD), allow_empty=True)
    return {**counts, "failed": len(late)}


def _months(rows) -> Column:
    """Whether a row is of one of these months: a filter on the folders."""
    return (F.col("year") * 100 + F.col("month")).isin([row["year"] * 100 + row["month"] for row in rows])


def fare_routes(domestic: DataFrame | None, international: DataFrame | None, rates: DataFrame) -> DataFrame | None:
    """Routes of both kinds of fare files; None without any."""
    home = abroad = None
    if domestic is not None:
        home = fares.domestic_routes(fares.fare_rows(domestic, comma=True))
    if international is not None:
        abroad = fares.international_routes(fares.fare_rows(international, comma=False), rates)
    return None if home is None and abroad is None else fares.all_routes(home, abroad)


def _rates(spark: SparkSession, root: str) -> DataFrame:
    book = Snapshots(spark, f"{root}/rates")
    return book.read() if book.present() else dimensions.rates(spark.read.parquet(f"{root}/dims/rates"))


def refresh_rates(spark: SparkSession, root: str, new: DataFrame) -> None:
    """Put new rates (``rate_key``, ``rate``) over the known ones; months the new source lacks stay."""
    Snapshots(spark, f"{root}/rates").replace(rate_table(upsert(rate_table(_rates(spark, root)), rate_table(new), ["rate_key"])))


def land_rates(spark: SparkSession, root: str, answers: DataFrame, column: str = "value") -> None:
    """Put the rates of landed answers of the rate service over the known ones."""
    refresh_rates(spark, root, rate_payload(answers, column))


def fallen(spark: SparkSession, root: str, tolerance: float = history.TOLERANCE) -> DataFrame:
    """Months that lost rows or matches in their newest run."""
    runs_of = history.compared(history.history(spark, f"{root}/history"), tolerance)
    return keep_last(runs_of, PERIOD, ["run"]).where("fell")


def export(spark: SparkSession, root: str, place: str, year: int | None = None) -> None:
    """Text files for other programs: the mart by month (``;`` with a byte order mark), the market summaries (``,``)."""
    table = spark.read.parquet(f"{root}/mart")
    export_text(table if year is None else table.where(F.col("year") == year), f"{place}/mart", period=PERIOD)
    for name in ("international_daily", "domestic_monthly"):
        book = Snapshots(spark, f"{root}/{name}")
        if book.present():
            export_text(book.read(), f"{place}/{name}", separator=",", bom=False)


def refresh_schedule(spark: SparkSession, root: str, today: date) -> None:
    """Rebuild the schedule, and freeze the running month unless that was done before."""
    raw = Snapshots(spark, f"{root}/landed/schedule").read()
    dims = {name: spark.read.parquet(f"{root}/dims/{name}") for name in ("airports", "airlines", "aircraft")}
    flown = schedule.departures(
        raw, dimensions.airports(dims["airports"]), dimensions.airlines(dims["airlines"]), dimensions.aircraft(dims["aircraft"])
    )
    current = Snapshots(spark, f"{root}/schedule")
    current.replace(schedule.schedule(flown), by=["Tipo"])  # the summaries read one view only

    book, manifest = _table(spark, f"{root}/manifest", state.MANIFEST)
    rows = markets.unfrozen_month(current.read(), manifest, today.replace(day=1))
    if rows.isEmpty():
        return
    # the month has no manifest entry, so a folder of it can only be left from a run that broke off
    write_periods(rows, f"{root}/frozen", ["key"])
    note = rows.limit(1).select("key", F.lit(L.FROZEN).alias("situacao"))
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    book.replace(state.register(manifest, note, now))


def market_tables(spark: SparkSession, root: str, extracted: date) -> None:
    """The two market summaries of the current schedule, replaced by every run."""
    current = Snapshots(spark, f"{root}/schedule").read()
    daily = Snapshots(spark, f"{root}/international_daily")
    daily.replace(markets.international_daily(current, extracted), allow_empty=True)
    monthly = Snapshots(spark, f"{root}/domestic_monthly")
    monthly.replace(markets.domestic_monthly(current, extracted), allow_empty=True)


def refresh_running_year(spark: SparkSession, root: str, year: int) -> dict[str, int] | None:
    """Replace the scheduled flights of the running year; its closed months stay as they are in the mart.

    Without a schedule or without months of that year the old flights stay.
    """
    current = Snapshots(spark, f"{root}/schedule")
    if not current.present() or not exists(spark, f"{root}/mart"):
        return None
    history = spark.read.parquet(f"{root}/mart")
    closed = years.year_table(history, year).agg(F.max("month").alias("month")).head()["month"]  # of the folder names
    if closed is None:
        return None
    cutoff = F.lit(date(year, closed, monthrange(year, closed)[1]))
    after, added = Observation("after"), Observation("added")
    future = years.future_flights(history, current.read(), year, counts=(after, added), cutoff=cutoff)
    # written without the check for emptiness, which would run the plan twice
    Snapshots(spark, f"{root}/running_year").replace(future, allow_empty=True)
    return {"after_cutoff": after.get["rows"], "added": added.get["rows"]}


def running_year(spark: SparkSession, root: str, year: int) -> DataFrame:
    """The closed months of the mart and the scheduled flights: a view, history is stored once."""
    future = Snapshots(spark, f"{root}/running_year").read()
    return years.running_year(spark.read.parquet(f"{root}/mart"), future, year, future=future)


def daily(spark: SparkSession, root: str, inbox: DataFrame, today: date, year: int | None = None, forced: bool = False) -> dict[str, object]:
    """All steps in turn: land what is new, build every open month, renew schedule, summaries and the running year, retire old
    versions. What each step returned, and under ``failed`` the names of those that raised, which is noted in ``run_issues`` and
    stops no other.

    With ``year`` the months of that year alone, and the running year stays as it is.
    """
    steps = {
        "land": lambda: land(spark, root, inbox), "land_schedule": lambda: land_schedule(spark, root, inbox),
        "fill_in": lambda: fill_in(spark, root, year=year, forced=forced),
    }
    if Snapshots(spark, f"{root}/landed/schedule").present() or not year:
        steps |= {"refresh_schedule": lambda: refresh_schedule(spark, root, today), "market_tables": lambda: market_tables(spark, root, today)}
    if not year:
        steps["running_year"] = lambda: refresh_running_year(spark, root, today.year)
    steps["retire"] = lambda: {name: Snapshots(spark, f"{root}/{name}").retire() for name in REPLACED}
    done: dict[str, object] = {}
    failed: list[str] = []
    for name, step in steps.items():
        try:
            done[name] = step()
        except Exception as error:  # a step must not stop the others, whatever it meets
            failed.append(name)
            _note(spark.createDataFrame([(name, None, str(error).splitlines()[0][:300], 1)], ISSUES), root)
    return done | {"failed": failed}
