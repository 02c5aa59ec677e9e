"""Number parsing and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip

# Texts are edited with character translation, which is one cheap pass, and each
# value expression appears once: conditions only choose a sign or a divisor.
_SEPARATORS = ",， \u3000"
_WIDE_DIGITS, _DIGITS = "０１２３４５６７８９", "0123456789"
_TRIANGLES = "△▲"
_PERCENTS = "%％"
_PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _plain_double(text: Column) -> Column:
    return F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double"))


def statement_number(value: Column) -> Column:
    """Number as printed in a financial statement.

    A leading triangle or enclosing parentheses mark a negative number, and a
    lone dash or triangle means no value.  Any other decoration is dropped, so
    a percent sign does not rescale.
    """
    text = F.translate(strip(value), _SEPARATORS, "")
    digits = F.regexp_replace(text, r"[^0-9eE+\-.]", "")
    triangle = text.startswith(_TRIANGLES[0]) | text.startswith(_TRIANGLES[1])
    negative = triangle | (text.startswith("(") & text.endswith(")"))
    return digits.try_cast("double") * F.when(negative, -1.0).otherwise(1.0)


def ratio_number(value: Column) -> Column:
    """Number of an ownership form; a trailing percent sign divides by 100."""
    text = F.translate(strip(value), _WIDE_DIGITS + _SEPARATORS, _DIGITS)
    percent = text.endswith(_PERCENTS[0]) | text.endswith(_PERCENTS[1])
    return _plain_double(F.rtrim(text, F.lit(_PERCENTS))) / F.when(percent, 100.0).otherwise(1.0)


def looks_numeric(value: Column) -> Column:
    """Whether a raw fact value reads as a number once decoration is removed."""
    shown = _WIDE_DIGITS + _TRIANGLES + _SEPARATORS + _PERCENTS
    text = F.translate(strip(value), shown, _DIGITS + "-" * len(_TRIANGLES))
    return F.coalesce(text.rlike(_PLAIN_NUMBER), F.lit(False))


def finite(value: Column) -> Column:
    """The value as a double; anything unparsable, NaN or infinite becomes null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def number(value: Column) -> Column:
    """The value as a double; unparsable and NaN become null, infinities stay."""
    parsed = value.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)


def without_nan(value: Column) -> Column:
    """The value, NaN as null."""
    return F.when(~F.isnan(value), value)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio of two finite numbers, null when a side is missing or the divisor is zero."""
    return F.try_divide(finite(numerator), finite(denominator))
