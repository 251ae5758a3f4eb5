"""Text columns: trimming, capitalisation, value maps and pattern tests."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Characters after which a capitalised word starts, besides whitespace.
WORD_DELIMITERS = r"""[](){}/|\<>!?@"^#$&~_,.:;*%+-"""

# Spellings of a missing value left behind by string conversion.
NULL_TOKENS = ("None", "nan")


def trim_ws(column: Column) -> Column:
    """Strip Unicode whitespace from both ends; one linear pass, no regular expression."""
    return F.btrim(column, F.lit(WHITESPACE))


def initcap_delims(column: Column) -> Column:
    """Lower-case, then capitalise after whitespace and after any of ``WORD_DELIMITERS``.

    The built-in ``initcap`` starts words only after spaces, so ``in-progress`` needs this.
    """
    escaped = "".join("\\" + ch for ch in WORD_DELIMITERS)
    words = F.split(F.lower(column), rf"(?<=[\s{escaped}])")
    capital = F.transform(
        words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2**31 - 1))
    )
    return F.array_join(capital, "")


def null_tokens_to_null(column: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    return F.when(~column.isin(*tokens), column)


def value_map(column: Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values and leave every other one as it is."""
    out = column
    for old, new in mapping.items():
        out = F.when(column == old, F.lit(new)).otherwise(out)
    return out


def lacks_text(column: Column, text: str) -> Column:
    """True unless the column contains ``text`` in any letter case; NULL counts as lacking it."""
    return ~F.coalesce(F.contains(F.lower(column), F.lit(text.lower())), F.lit(False))


def any_column_match(df: DataFrame, pattern: str, regex: bool = False) -> Column:
    """True when the text of at least one column contains ``pattern``.

    Columns are tested one by one, so the test stops at the first hit and no row-wide string is
    built. Nested columns are searched in their JSON form.
    """

    def hit(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
        text = F.to_json(column) if nested else column.cast("string")
        found = text.rlike(pattern) if regex else F.contains(text, F.lit(pattern))
        return F.coalesce(found, F.lit(False))

    return reduce(lambda a, b: a | b, [hit(f) for f in df.schema.fields], F.lit(False))
