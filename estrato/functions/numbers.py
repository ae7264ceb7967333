"""Exact money and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estrato.functions.text import _col, clean_text

# Stored money type and the type every reconciled sum is carried in.
MONEY_TYPE = "decimal(17,2)"
SUM_TYPE = "decimal(38,2)"
MULTIPLICITY_TYPE = "decimal(38,0)"


def parse_decimal_br(value: Column | str, precision: int = 17, scale: int = 2) -> Column:
    """Decimal with comma or dot. Thousands separators make it malformed, and malformed reads as NULL."""
    return F.replace(clean_text(value), F.lit(","), F.lit(".")).try_cast(f"decimal({precision},{scale})")


def money_from_text(value: Column | str) -> Column:
    """Raw money text at the width used for sums, read as the typed columns are."""
    return parse_decimal_br(value, 38, 2)


def money_as_written(value: Column | str) -> Column:
    """What raw money text says to a reader, independent of the typed columns' parser.

    A text with a comma has dots between thousands and cents after the comma; any other text is a
    plain number. Used on the raw side of reconciliations, so that an amount which the parser drops
    shows as a difference.
    """
    text = F.regexp_replace(_col(value), r"[^0-9,.+-]", "")
    plain = F.when(text.contains(","), F.translate(F.translate(text, ".", ""), ",", ".")).otherwise(text)
    return F.when(plain.rlike(r"^[+-]?\d+(\.\d*)?$"), plain).try_cast(SUM_TYPE)


def exact_sum(value: Column | str, zero_when_empty: bool = True) -> Column:
    """Sum at decimal(38,2); an all-NULL or empty input gives 0.00 unless told otherwise."""
    total = F.sum(_col(value).cast(SUM_TYPE)).cast(SUM_TYPE)
    return F.coalesce(total, F.lit(0).cast(SUM_TYPE)) if zero_when_empty else total


def share(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, NULL when the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Rounded percentage, NULL on a zero denominator."""
    return F.round(share(numerator, denominator) * 100.0, digits)
