"""Web pages and listings that have been landed as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.functions.text import absolute_link, folded, without_tags
from skyledger.operators.dedup import keep_last


def _targets(pages: DataFrame, keep: list[str], html: str) -> DataFrame:
    """What each quoted ``href`` of the pages names, as it stands there, with its place on the page."""
    # what is behind each "href =" begins with the quoted target; position counts them in page order
    parts = F.split(F.col(html), r"(?i)href\s*=\s*")
    behind = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    found = pages.select(*keep, F.posexplode(behind).alias("position", "part"))
    mark, rest = F.left("part", F.lit(1)), F.substr("part", F.lit(2))
    return found.where(mark.isin("'", '"') & (F.instr(rest, mark) > 1)).select(
        *keep, "position", F.split_part(rest, mark, F.lit(1)).alias("href")
    )


def links(pages: DataFrame, keep: list[str], html: str = "html", url: str = "url") -> DataFrame:
    """Every link of each page in page order (``position``), resolved and without its query."""
    hits = _targets(pages.withColumn("_page", F.col(url)), [*keep, "_page"], html)
    return hits.select(*keep, "position", absolute_link(F.col("href"), F.col("_page")).alias("link"))


def inventory(pages: DataFrame, page_id: str, html: str = "html", url: str = "url") -> DataFrame:
    """Segment, month and link of every archive on the pages; the last link of a month counts.

    Relative links start below the page: its URL is taken for a folder, with or without a slash at its end. A page without the
    name of an archive is not taken apart; segment and month are read from the link as it stands, and only the links that
    count are resolved, which does not change their last part.
    """
    named = pages.where(F.col(html).rlike(L.ARCHIVE_NAME.removesuffix("$"))).withColumn("_page", F.col(url))
    hits = _targets(named, [page_id, "_page"], html).withColumn("href", F.split_part("href", F.lit("?"), F.lit(1)))
    hits = hits.where(F.col("href").rlike(L.ARCHIVE_NAME))
    # the name is the segment, six digits with or without a dash, and four characters
    digits = F.replace(F.left("href", F.length("href") - 4), F.lit("-"), F.lit(""))
    segment = F.when(F.lower(F.left(digits, F.length(digits) - 6)).endswith(L.SEGMENTS[1]), L.SEGMENTS[1]).otherwise(L.SEGMENTS[0])
    found = hits.select(segment.alias("segment"), F.right(digits, F.lit(6)).alias("ref"), "href", "_page", page_id, "position")
    last = keep_last(found, ["segment", "ref"], [page_id, "position", "href", "_page"])
    below = F.when(F.col("_page").endswith("/"), F.col("_page")).otherwise(F.concat("_page", F.lit("/")))
    return last.select("segment", "ref", absolute_link(F.col("href"), below).alias("url"))


def _words(html: Column) -> Column:
    """The words that a page shows."""
    return F.split(F.trim(F.regexp_replace(without_tags(html), r"\s+", " ")), " ")


def page_dates(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Publication and update dates shown on a page, the last one of each label; null if not shown.

    A label is a word, followed by ``em`` and a day, and behind it perhaps a time; colons and dashes between them do
    not count.
    """
    shown = F.regexp_replace(without_tags(F.col(html)), r"[:\-](?=\s|$)|(?<=\s)[:\-]", " ")
    words = pages.select(*keep, _words(shown).alias("words"))

    def dated(at: Column) -> Column:
        day, link, hour = (F.get(F.col("words"), at + k) for k in (2, 3, 4))
        time = F.when(F.lower(link).isin("as", "às"), hour).otherwise(link)
        clock = F.try_to_timestamp(F.translate(F.lower(time), "h", ":"), F.lit("H:mm"))
        return F.concat_ws(" ", day, F.when(clock.isNotNull(), time))

    def last(label: str) -> Column:
        def hit(word: Column, at: Column) -> Column:
            day = F.try_to_timestamp(F.get(F.col("words"), at + 2), F.lit("d/M/yyyy"))
            is_one = (F.lower(word) == label) & (F.lower(F.get(F.col("words"), at + 1)) == "em") & day.isNotNull()
            return F.when(is_one, at)

        places = F.filter(F.transform("words", hit), lambda at: at.isNotNull())
        place = F.try_element_at(places, F.lit(-1))
        return F.when(place.isNotNull(), dated(place))

    return words.select(*keep, last("publicado").alias("published"), last("atualizado").alias("updated"))


def listing(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Name, time and size of each archive in a directory listing.

    In front of the name of an archive stand its size, a time with ``AM`` or ``PM`` (one word or two) and a day; what does
    not read as such is no item.
    """
    words = pages.select(*keep, _words(F.col(html)).alias("words"))

    def item(name: Column, at: Column) -> Column:
        size, near, far, farther = (F.get(F.col("words"), at - k) for k in (1, 2, 3, 4))
        split_time = F.upper(near).isin("AM", "PM")
        time = F.when(split_time, F.concat_ws(" ", far, near)).otherwise(near)
        day = F.when(split_time, farther).otherwise(far)
        clock = F.regexp_replace(F.upper(time), r"\s*([AP]M)$", " $1")
        moment = F.try_to_timestamp(F.concat_ws(" ", day, clock), F.lit("M/d/yyyy h:mm a"))
        found = F.struct(
            name.alias("name"), F.concat_ws(" ", day, time).alias("published_at"), size.try_cast("bigint").alias("bytes")
        )
        return F.when(F.lower(name).endswith(".zip") & moment.isNotNull() & size.try_cast("bigint").isNotNull(), found)

    items = F.filter(F.transform("words", item), lambda found: found.isNotNull())
    return words.select(*keep, F.explode(items).alias("item")).select(*keep, "item.*")


def publications(rows: DataFrame, keep: list[str], header: str = "header", cells: str = "cells") -> DataFrame:
    """File, time, year, month and size of each table row, found by the titles of the columns.

    Rows with fewer than three cells or without a time are titles or footers and go.
    """

    def cell(part: str) -> Column:
        spots = F.transform(F.col("titles"), lambda title, i: F.when(F.contains(title, F.lit(part)), i + 1))
        spot = F.array_min(spots)
        return F.coalesce(F.trim(F.when(spot.isNotNull(), F.try_element_at(F.col("cells"), spot))), F.lit(""))

    titled = rows.where(F.size(cells) >= 3).select(
        *keep, F.transform(header, folded).alias("titles"), F.col(cells).alias("cells")
    )
    dated = titled.withColumn("published_at", cell(L.PUBLICATION_HEADERS["published_at"])).where(
        F.coalesce(*[F.try_to_timestamp("published_at", F.lit(form)) for form in ("d/M/yyyy H:m:s", "d/M/yyyy H:m")]).isNotNull()
    )
    others = [cell(title).alias(name) for name, title in L.PUBLICATION_HEADERS.items() if name != "published_at"]
    found = dated.select(*keep, "published_at", *others)
    month = F.when(F.length("month") < 2, F.lpad("month", 2, "0")).otherwise(F.col("month"))
    return found.withColumn("month", month)
