"""Text cleaning and code normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters stripped from text ends: Unicode white space, the ideographic space
# included, and the four ASCII information separators.  Trimming by a character
# set runs on the raw bytes and is far cheaper than a regular expression.
EDGE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Either a whole five-character code with check digit, or only a trailing ``.0``.
_CHECK_DIGIT_OR_DECIMAL = r"(?s)\A(?!.{3}\.0\z)(.{4})0(?:\.0)?\z|\.0\z"


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def strip(value: Column) -> Column:
    return F.btrim(value.cast("string"), F.lit(EDGE_SPACE))


def clean(value: Column) -> Column:
    """Strip white space on both ends; blank becomes null."""
    return blank_to_null(strip(value))


def clean_code(value: Column) -> Column:
    """``clean`` and drop one trailing ``.0`` left by a numeric round trip."""
    return blank_to_null(F.regexp_replace(strip(value), r"\.0\z", ""))


def security_code(value: Column) -> Column:
    """Four-character ticker of a four- or five-character code, otherwise null.

    After four characters only a check digit ``0`` and the ``.0`` of a number may follow, and texts that are shorter than
    four once that ``.0`` is gone are refused.  Compared by length and ending, which costs less than a regular expression.
    """
    text = strip(value)
    length = F.length(text)
    bare = ((length == 4) | ((length == 5) & text.endswith("0"))) & ~text.endswith(".0")
    decimal = ((length == 6) & text.endswith(".0")) | ((length == 7) & text.endswith("0.0"))
    return F.when(bare | decimal, F.upper(F.substring(text, 1, 4)))


def disclosure_ticker(value: Column) -> Column:
    """Ticker of a disclosure row: cut ``XXXX0`` to four characters, keep anything else."""
    return blank_to_null(F.regexp_replace(strip(value), _CHECK_DIGIT_OR_DECIMAL, "$1"))


def local_name(element_id: Column) -> Column:
    """The part of a qualified element name after its last colon."""
    return F.substring_index(F.coalesce(element_id.cast("string"), F.lit("")), ":", -1)


def first_ten(*candidates: Column) -> Column:
    """Date part of the first non-blank text, or ``unknown``."""
    cleaned = [F.substring(clean(c), 1, 10) for c in candidates]
    return F.coalesce(*cleaned, F.lit("unknown"))


def is_current_year(value: Column) -> Column:
    from tidemark.vocabulary import CURRENT_YEAR_LABELS

    return F.coalesce(F.lower(clean(value)).isin(*CURRENT_YEAR_LABELS), F.lit(False))


def is_consolidated(value: Column) -> Column:
    """True for the exact Japanese label, or text with ``consolidated`` but not ``nonconsolidated``."""
    text = F.lower(clean(value))
    english = text.contains("consolidated") & ~text.contains("nonconsolidated")
    return F.coalesce(english | (text == "連結"), F.lit(False))


def content_hash(value: Column) -> Column:
    return F.sha2(value, 256)


def parsed_once(df: DataFrame, name: str, payload: str, schema: str) -> DataFrame:
    """Add a JSON text as a typed column that is parsed once, however many filters and columns read it.

    The one-element array keeps Spark from moving the parser into each of them.
    """
    return df.withColumn(name, F.explode(F.array(F.from_json(payload, schema))))
