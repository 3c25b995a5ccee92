"""Money and safe-number column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_CENTS = 9e16

# All texts that a cast takes, and few others. Any other text costs ``try_cast`` an exception, far more work than a number,
# so it is told by its form. Blanks and control characters around a number belong to it; decimals may have digits of any script.
_BLANK = "[\\x00-\\x20\\x7F]*"
WHOLE_TEXT = f"^{_BLANK}[+-]?[0-9]+{_BLANK}$"
DECIMAL_TEXT = f"^{_BLANK}[+-]?(\\p{{Nd}}+\\.?\\p{{Nd}}*|\\.\\p{{Nd}}+)([eE][+-]?\\p{{Nd}}+)?{_BLANK}$"
DOUBLE_TEXT = f"(?i)^{_BLANK}[+-]?(inf|infinity|nan|[0-9.][0-9.e+-]*|0x[0-9a-f.]+p[+-]?[0-9]+)[df]?{_BLANK}$"


def round2(value: Column) -> Column:
    """Two decimals, ties to even after scaling: scale, ``rint``, unscale.

    Spark's own ``round`` rounds the decimal text half up and differs on ties.
    """
    return F.rint(value * 100) / 100


def cents(value: Column) -> Column:
    """Whole cents as a decimal. Amounts that fit a long take the cheap conversion."""
    scaled = F.rint(value * 100)
    whole = "decimal(38,0)"
    return F.when(F.abs(value) < LONG_CENTS, scaled.cast("long").cast(whole)).otherwise(scaled.cast(whole))


def money_sum(value: Column) -> Column:
    """Sum of a two-decimal double column, independent of the order of the rows.

    The values are added as whole cents, so any partitioning gives the same
    total; a sum of doubles would not. The buffer is a decimal because a long
    would overflow near 9.2e16 currency units.
    """
    return (F.sum(cents(value)) / 100).cast("double")


def safe_number(column: str, data_type: T.DataType) -> Column:
    """The column as a double, null where it is no number.

    Whole numbers, the common case, take the cheap integer parse. Spark's cast
    to double accepts the Java literal suffixes of ``5d`` and ``5f``; those are
    text here, like any other word.
    """
    value = F.col(column)
    if not isinstance(data_type, T.StringType):
        return value.cast("double")
    suffixed = F.lower(F.right(F.rtrim(value), F.lit(1))).isin("d", "f")
    whole = F.when(value.rlike(WHOLE_TEXT), value.try_cast("long"))
    return F.coalesce(whole.cast("double"), F.when(~suffixed & value.rlike(DOUBLE_TEXT), value.try_cast("double")))


def whole_number(column: str) -> Column:
    """A text column as a long, also where it is written like ``7.0``; null where it is no whole number.

    Fractions are read as decimals: a double would change the last digits of a large key.
    """
    text = F.col(column)
    number = text.try_cast("decimal(38,18)")
    return F.coalesce(
        F.when(text.rlike(WHOLE_TEXT), text.try_cast("long")),
        F.when(text.rlike(DECIMAL_TEXT), F.when(F.floor(number) == number, number.try_cast("long"))))
