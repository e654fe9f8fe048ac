"""Joins of a large table with a table that has at most one row per key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.shape import quoted


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: Mapping[str, str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Join ``facts`` with ``lookup``, which has at most one row per key.

    ``on`` maps a column of ``facts`` to its partner in ``lookup``; the partners are dropped, so
    ``lookup`` adds only its other columns. ``how`` is ``left``, ``inner``, ``left_semi`` or
    ``left_anti``. ``null_safe`` lets null match null.

    Spark broadcasts a ``lookup`` that is small by its own estimate and shuffles both sides beyond it.
    Where ``lookup`` is a stored table, AQE splits the rows of a heavy key; runs therefore store what
    they have summed before they join it.
    """
    partners = {theirs: f"_on{i}" for i, theirs in enumerate(on.values())}
    right = lookup.withColumnsRenamed(partners)
    pairs = [(quoted(mine), F.col(partners[theirs])) for mine, theirs in on.items()]
    matches = [mine.eqNullSafe(theirs) if null_safe else mine == theirs for mine, theirs in pairs]
    condition = matches[0]
    for match in matches[1:]:
        condition = condition & match
    return facts.join(right, condition, how).drop(*partners.values())
