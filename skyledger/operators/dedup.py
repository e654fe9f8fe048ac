"""One row per key, chosen by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.shape import quoted


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    """An aggregate, not a window: each task sends at most one row per key to the shuffle, so a
    key that holds a large share of the rows costs no more than any other."""
    rest = [name for name in df.columns if name not in keys]
    rank = F.struct(*[quoted(name) for name in order])
    chosen = df.groupBy(*[quoted(name) for name in keys]).agg(
        pick(F.struct(*[quoted(name) for name in rest]), rank).alias("chosen")
    )
    return chosen.select(*[
        quoted(name) if name in keys else F.col("chosen").getField(name).alias(name) for name in df.columns
    ])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes first in ``order``; null is a key like any other."""
    return _one_per_key(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes last in ``order``."""
    return _one_per_key(df, keys, order, F.max_by)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """All keys of both tables; where both have a key the new row wins.

    Of several new rows of a key the last by ``order`` (columns of ``new`` that the result does not keep unless
    ``old`` has them) counts, and of those that it leaves equal the one with the greatest values.
    """
    rest = [name for name, kind in old.dtypes if name not in keys and not kind.startswith("map")]
    places = {f"_order{i}": F.col(name) for i, name in enumerate(order)}
    latest = new.select(*old.columns, F.lit(1).alias("_turn"), *[place.alias(name) for name, place in places.items()])
    both = old.withColumn("_turn", F.lit(0)).unionByName(latest, allowMissingColumns=True)
    return keep_last(both, keys, ["_turn", *places, *rest]).select(*[quoted(name) for name in old.columns])


def last_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The ``n`` rows of each group that come first in ``order``.

    Spark turns the rank filter into a group limit ahead of the shuffle, so a task sends at most
    ``n`` rows per group.
    """
    from pyspark.sql import Window

    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")
