"""Number columns: lenient parsing and half-even rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sprintmart.functions.text import trim_ws

# The spellings of true a cast accepts. Testing them is several times faster than a
# lenient cast.
TRUE_TEXT = ("t", "true", "y", "yes", "1")

_NUMERIC = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def safe_int(column: Column) -> Column:
    """The integer a string spells, NULL for anything else (``'8.0'`` included)."""
    return column.try_cast("bigint")


def to_number(column: Column) -> Column:
    """The double a string spells, NULL for anything else.

    The pattern keeps out spellings the cast alone accepts (``1d``, ``Infinity``, ``NaN``).
    """
    text = trim_ws(column.cast("string"))
    return F.when(text.rlike(_NUMERIC), text.try_cast("double"))


def round_half_even(column: Column, scale: int = 0) -> Column:
    """Round the double to ``scale`` digits; exact halves go to the even neighbour."""
    if scale == 0:
        return F.rint(column)
    factor = float(10**scale)
    return F.rint(column * F.lit(factor)) / F.lit(factor)


def to_whole(column: Column) -> Column:
    """A number rounded half-even to a whole one; NULL stays NULL."""
    return F.rint(column).cast("bigint")


def whole_or_zero(column: Column) -> Column:
    """Parse, take 0 for what is missing or malformed, round half-even to a whole number."""
    return to_whole(F.coalesce(to_number(column), F.lit(0.0)))


def to_identifier(column: Column) -> Column:
    """A numeric id: exact for integer spellings, accepted as ``12.0`` too, NULL otherwise."""
    text = trim_ws(column)
    value = to_number(text)
    return F.coalesce(
        text.try_cast("bigint"), F.when(value == F.floor(value), value.try_cast("bigint"))
    )


def to_bool(column: Column) -> Column:
    """True for a spelling of true; everything else, NULL included, is false."""
    text = F.lower(trim_ws(column.cast("string")))
    return F.coalesce(text.isin(*TRUE_TEXT), F.lit(False))


def monthly_amount(amount: Column, frequency: Column, yearly: str = "Yearly") -> Column:
    """Bring an amount paid once a year to one month."""
    return F.when(frequency == yearly, amount / F.lit(12.0)).otherwise(amount)
