"""Future flights: raw schedule rows -> departures and arrivals in local time, 31 columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import layout as L
from skyledger.functions import dates, flights, text
from skyledger.functions.numbers import whole
from skyledger.operators.lookup import lookup_join
from skyledger.operators.shape import align, mirror, quoted


def departures(
    raw: DataFrame,
    airports: DataFrame,
    airlines: DataFrame,
    aircraft: DataFrame,
    arrival_offset: str = "origin",
    state_offsets: DataFrame | None = None,
) -> DataFrame:
    """The departure view.

    Times are shifted by the UTC offset of the origin. ``arrival_offset`` may be ``destination`` to
    shift the arrival by the offset of the destination instead. An unknown airport counts as
    UTC-3, unless ``state_offsets`` (``state``, ``state_offset``) and a ``state`` column of the
    raw rows say otherwise.
    """
    source = {role: quoted(name) for role, name in L.SCHEDULE_RAW.items()}
    state = [F.col("state")] if state_offsets is not None else []
    flown = raw.select(
        source["airline"].alias("Airline Icao"),
        source["flight"].alias("Voo"),
        source["aircraft"].alias("Aircraft"),
        whole(source["seats"]).alias("Seats"),
        whole(source["leg_number"]).alias("Etapa"),
        source["origin"].alias("Aero Icao"),
        source["destination"].alias("OD Icao"),
        dates.stamp(source["departs"]).alias("departs"),
        dates.stamp(source["arrives"]).alias("arrives"),
        *[part.alias(name) for name, part in flights.flight_type_parts(source["flight_type"]).items()],
        *state,
    )
    known = lookup_join(flown, airlines.withColumnRenamed("IATA/ICAO", "Airline"), {"Airline Icao": "ICAO"}, null_safe=True)
    for column, prefix, code, offset in (
        ("Aero Icao", "", "Aero", "origin_offset"), ("OD Icao", "OD ", "OD", "destination_offset")
    ):
        place = airports.select(
            "ICAO", F.col("IATA").alias(code), F.col("offset").alias(offset),
            *[quoted(name).alias(prefix + name) for name in ("State/Country", "Region")],
        )
        known = lookup_join(known, place, {column: "ICAO"}, null_safe=True)
    known = lookup_join(known, aircraft, {"Aircraft": "Aircraft"}, null_safe=True)
    fallback = F.lit(L.DEFAULT_OFFSET)
    if state_offsets is not None:
        known = lookup_join(known, state_offsets, {"state": "state"})
        fallback = F.coalesce(F.col("state_offset"), fallback)

    origin = F.coalesce(F.col("origin_offset"), fallback)
    arrival = origin if arrival_offset == "origin" else F.coalesce(F.col("destination_offset"), fallback)
    local = {"": dates.shifted(F.col("departs"), origin), "OD ": dates.shifted(F.col("arrives"), arrival)}
    timed = known.withColumns({
        **{f"{prefix}Data": moment.cast("date") for prefix, moment in local.items()},
        **{f"{prefix}Hora": dates.clock(moment) for prefix, moment in local.items()},
        "Fln Icao": text.flight_label(quoted("Airline Icao"), F.col("Voo"), null_as_blank=True),
        "Fln": text.flight_label(F.col("Airline"), F.col("Voo"), null_as_blank=True),
        "Pax Total": flights.expected_passengers(F.col("Seats")),
        "Decolagens": F.lit(1),
        "Tipo": F.lit(L.DEPARTURE),
        "Base": F.lit(L.BASE_SCHEDULE),
    })
    return align(timed, L.SCHEDULE_COLUMNS)


def schedule(departure_rows: DataFrame, view: str | None = None) -> DataFrame:
    """Departures and arrivals; dates are not checked here."""
    both = mirror(departure_rows, L.SCHEDULE_PAIRS, {}, "Tipo", (L.DEPARTURE, L.ARRIVAL), view)
    return align(both, L.SCHEDULE_COLUMNS)
