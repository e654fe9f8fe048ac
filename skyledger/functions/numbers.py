"""Text to number at file boundaries, and the rounding rules of the published figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.layout import NULL_TOKENS

_DECIMAL_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def null_tokens(text: Column) -> Column:
    """Null where the text is one of the tokens that mean "no value"."""
    return F.when(~text.isin(NULL_TOKENS), text)


def number(text: Column) -> Column:
    """Double of a decimal text; null for anything else (``1,5``, ``12d``, ``inf``, blank)."""
    return F.when(text.rlike(_DECIMAL_TEXT), text.try_cast("double"))


def whole(text: Column) -> Column:
    """Whole number or null; a fraction is cut off."""
    return number(text).try_cast("bigint")


def whole_or_zero(text: Column) -> Column:
    """Whole number, 0 for bad or missing text; a fraction is cut off."""
    return F.coalesce(whole(text), F.lit(0).cast("bigint"))


def decimal_comma(text: Column) -> Column:
    """``1.234,50`` -> ``1234.50``."""
    return F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def decimal_point(text: Column) -> Column:
    """``5,84`` or ``5.84`` -> ``5.84``."""
    return F.replace(text, F.lit(","), F.lit("."))


def fare(text: Column, comma: bool) -> Column:
    """Fare text to a whole number, halves to the even neighbour; bad text becomes null."""
    plain = F.trim(text)
    return F.rint(number(decimal_comma(plain) if comma else plain)).try_cast("bigint")


def round_half_even(x: Column, places: int) -> Column:
    """Scale, round the scaled double half to even, scale back."""
    scale = float(10**places)
    return F.rint(x * scale) / F.lit(scale)


def rounded_share(part: Column, total: Column, places: int) -> Column:
    """``part / total`` rounded by the exact value of the double quotient; null if ``total`` <= 0.

    Off a rounding tie the scaled double rounds right. Whole numbers meet a tie only when an odd
    multiple of ``total`` says so; then the double may be above, below or exactly on the tie, which
    the sign of the division error tells. To see that error the double is split in two halves
    (Veltkamp), so that each product with ``total`` is exact.
    """
    scale = 10**places
    size, divisor = F.abs(part.cast("bigint")), F.when(total > 0, total.cast("bigint"))
    quotient = size.cast("double") / divisor.cast("double")
    doubled = size * (2 * scale)
    tie = (doubled % divisor == 0) & ((doubled / divisor).cast("bigint") % 2 == 1)
    spread = quotient * 134217729.0
    high = spread - (spread - quotient)
    error = (size.cast("double") - high * divisor.cast("double")) - (quotient - high) * divisor.cast("double")
    below = F.floor(doubled / divisor / 2)
    on_tie = below + F.when(error < 0, 1).when(error > 0, 0).otherwise(below % 2)
    rounded = F.when(tie, on_tie.cast("double")).otherwise(F.rint(quotient * float(scale)))
    return F.signum(part.cast("double")) * (rounded / F.lit(float(scale)))
