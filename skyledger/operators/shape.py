"""Column sets: aligning, renaming, and mirroring departures to arrivals.

The wide projections are written as SQL text, which is one call for all columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def trimmed_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def align(df: DataFrame, columns: Iterable[str], types: StructType | None = None) -> DataFrame:
    """Exactly ``columns`` in that order: absent ones are null, surplus ones go.

    ``types`` gives the type of each column; without it an absent column is text.
    """
    kinds = {field.name: field.dataType.simpleString() for field in types} if types else {}
    present = set(df.columns)

    def one(name: str) -> str:
        value = f"`{name}`" if name in present else "null"
        if name in kinds or name not in present:
            value = f"cast({value} as {kinds.get(name, 'string')})"
        return f"{value} as `{name}`"

    return df.selectExpr(*[one(name) for name in columns])


def mirror(
    df: DataFrame,
    pairs: Mapping[str, str],
    renames: Mapping[str, str],
    tag: str,
    labels: tuple[str, str],
    view: str | None = None,
) -> DataFrame:
    """Every row twice: as it is, and with each pair of columns exchanged.

    ``renames`` moves a column to another name on the mirrored row, so each of the two names is
    empty on one of the rows. ``tag`` names the column that holds the label of the view.

    Without ``view`` both rows come from one pass over the input: each row is doubled as it is, and one
    projection takes every column from its side, which suits a result that is written whole. With ``view``
    only that side is built, as a plain projection, so filters and pruned columns reach the scan.
    """
    partner = {**pairs, **{b: a for a, b in pairs.items()}}
    moved = {new: old for old, new in renames.items()}
    types = {field.name: field.dataType.simpleString() for field in df.schema}
    names = [name for name in types if name != tag] + [new for new in moved if new not in types]

    def value(source: str | None, name: str) -> str:
        return f"`{source}`" if source in types else f"cast(null as {types[moved.get(name, name)]})"

    def straight(name: str) -> str:
        return value(name, name)

    def turned(name: str) -> str:
        return value(partner.get(name, moved.get(name, None if name in renames else name)), name)

    sides = dict(zip(labels, (straight, turned)))
    if view is not None:
        return df.selectExpr(f"'{view}' as `{tag}`", *[f"{sides[view](name)} as `{name}`" for name in names])

    def either(name: str) -> str:
        here, there = straight(name), turned(name)
        return here if here == there else f"if(`{tag}` = '{labels[0]}', {here}, {there})"

    both = df.drop(tag).selectExpr("*", f"explode(array('{labels[0]}', '{labels[1]}')) as `{tag}`")
    return both.selectExpr(f"`{tag}`", *[f"{either(name)} as `{name}`" for name in names])
