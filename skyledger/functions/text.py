"""Keys, labels, names and page text."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger import layout as L


def joined(separator: str, *parts: Column) -> Column:
    """Parts with a separator between them; null as soon as one part is null."""
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit(separator), part]
    return F.concat(*pieces)


def leg_key(*parts: Column) -> Column:
    return joined("-", *parts)


def fare_key(*parts: Column) -> Column:
    return joined(" - ", *parts)


def route_end(origin: Column, destination: Column) -> Column:
    """The last two pieces between hyphens of a route, without blanks.

    Of a leg key or fare key that ends with the route they are the same, so legs, sums and fares with equal keys have equal ends.
    """
    return F.replace(F.substring_index(joined("-", origin, destination), "-", -2), F.lit(" "), F.lit(""))


def month_number(text: Column) -> Column:
    """``1`` and ``01`` are the same month; bad text becomes null."""
    return text.try_cast("double").try_cast("int")


def two_digits(month: Column) -> Column:
    """``1`` -> ``01``; longer numbers stay whole."""
    return F.when(month.between(0, 9), F.concat(F.lit("0"), month.cast("string"))).otherwise(month.cast("string"))


def flight_label(airline: Column, flight: Column, null_as_blank: bool = False) -> Column:
    if null_as_blank:
        return F.concat(F.coalesce(airline, F.lit("")), F.coalesce(flight, F.lit("")))
    return F.concat(airline, flight)


def proper_case(text: Column) -> Column:
    """A capital after every non-letter, the other letters small (``D'Oeste``, ``Sp/Rj``).

    ``initcap`` puts one after blanks. Each other non-letter before a letter gets a mark and a blank behind it for the
    time of the call.
    """
    marked = F.regexp_replace(text, r"(\x01|[^\p{L} ](?=\p{L}))", "$1\x01 ")
    return F.when(text.rlike(r"[^\p{L} ]\p{L}"), F.replace(F.initcap(marked), F.lit("\x01 "), F.lit(""))).otherwise(F.initcap(text))


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def without_tags(html: Column) -> Column:
    """Tags out, white space collapsed."""
    return F.regexp_replace(F.regexp_replace(html, r"<[^>]+>", " "), r"\s+", " ")


def _plain_letters() -> tuple[str, str, str]:
    """Accented Latin letters, their plain letters, and the combining marks, by Unicode decomposition."""
    pairs = [(chr(code), unicodedata.normalize("NFKD", chr(code))) for code in range(0xC0, 0x180)]
    accented = [(letter, parts[0]) for letter, parts in pairs if len(parts) > 1 and unicodedata.combining(parts[1])]
    marks = "".join(chr(code) for code in range(0x300, 0x370))
    return "".join(a for a, _ in accented), "".join(b for _, b in accented), marks


_ACCENTED, _PLAIN, _MARKS = _plain_letters()


def folded(text: Column) -> Column:
    """Small letters without accents, without white space at the ends."""
    return F.trim(F.lower(F.translate(text, _ACCENTED + _MARKS, _PLAIN)))


def fare_theme(label: Column) -> Column:
    """``int`` / ``dom`` for the label of a fare theme, null for any other label."""

    def has(part: str) -> Column:
        return F.contains(folded(label), F.lit(part))

    return F.when(has("tarifa"), F.when(has("internacion"), "int").when(has("domestic") | has("nacion"), "dom"))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def period_in_name(name: Column) -> Column:
    """First day of the month named in a file name, ``2026-01`` before ``202601``; null without one."""
    text = base_name(name)
    dashed = F.regexp_extract(text, r"(\d{4}-\d{2})", 1)
    plain = F.regexp_extract(text, r"(\d{4}\d{2})", 1)
    found = F.when(dashed != "", dashed).when(plain != "", F.concat(F.left(plain, F.lit(4)), F.lit("-"), F.right(plain, F.lit(2))))
    return F.concat(found, F.lit("-01")).try_cast("date")


def fare_kind(name: Column) -> Column:
    """``int`` / ``dom`` for the name of a fare file, null for any other file."""
    text = F.upper(base_name(name))
    return F.when(
        text.endswith(".CSV"),
        F.when(text.startswith("INTERNACIONAL"), "int").when(text.rlike(r"^\d{6}"), "dom"),
    )


def without_copy_suffix(name: Column) -> Column:
    """``202605 (1).CSV`` -> ``202605.CSV``."""
    text = base_name(name)
    stem = F.regexp_replace(text, r"(?<=.)\.[^.]*$", "")
    suffix = F.substr(text, F.length(stem) + 1)
    return F.concat(F.trim(F.regexp_replace(stem, r"\s*\(\d+\)\s*$", "")), suffix)


def absolute_link(href: Column, page: Column) -> Column:
    """A link without its query, resolved against the page it stands on."""
    link = F.element_at(F.split(href, r"\?"), 1)
    scheme = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    root = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    page_path = F.regexp_extract(page, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_replace(page_path, r"[^/]*$", "")
    path = F.when(link.startswith("/"), link).otherwise(
        F.concat(F.when(folder == "", "/").otherwise(folder), link)
    )
    steps = F.split(path, "/")
    walked = F.aggregate(
        steps,
        F.lit(None).cast("array<string>"),
        lambda done, step: F.when(step == ".", F.coalesce(done, F.array(F.lit(""))))
        .when(step == "..", F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done))
        .otherwise(F.concat(F.coalesce(done, F.array().cast("array<string>")), F.array(step))),
    )
    resolved = F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(
        F.array_join(walked, "/"), F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")
    )).otherwise(path)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link == "", page)
        .otherwise(F.concat(root, resolved))
    )


def route_of(key: Column, field: str) -> Column:
    """Target of a manifest key by its longest matching prefix; an unknown origin is an error."""
    place = {"raw": 0, "processed": 1, "raw_mode": 2, "processed_mode": 3}[field]
    longest_first = sorted(L.ROUTES.items(), key=lambda route: -len(route[0]))
    known = reduce(
        lambda cases, route: cases.when(key.startswith(route[0]), F.lit(route[1][place])), longest_first, F
    )
    return known.otherwise(F.raise_error(F.concat(F.lit("no route for "), F.coalesce(key, F.lit("null")))).cast("string"))
