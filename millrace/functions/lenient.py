"""Text to typed values; what cannot be read becomes NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: layout of the source's date column, with an offset appended before parsing.
_SOURCE_DATE = "M/d/yyyy h:m:s a Z"
# Fixed value: spellings of true.
_TRUE_WORDS = ("true", "1", "yes")
_WHITE_SPACE = " \t\n\r\f\v"


def lenient_int(text: Column, kind: str = "int") -> Column:
    """Whole number; leading zeros are fine, a decimal point is not."""
    return text.try_cast(kind)


def lenient_double(text: Column) -> Column:
    """Floating-point number, ``nan`` and ``inf`` included.

    The JVM also reads Java literals such as ``1.5d`` and ``0x1p3``; those are no numbers in a data
    file.
    """
    return F.when(~text.rlike(r"[xX]|[0-9.][dDfF]\s*$"), text.try_cast("double"))


def lenient_bool(text: Column) -> Column:
    """True for the known spellings, white space around them aside; false for everything else, never NULL."""
    return F.coalesce(F.lower(F.btrim(text, F.lit(_WHITE_SPACE))).isin(*_TRUE_WORDS), F.lit(False))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def source_date_millis(text: Column) -> Column:
    """Epoch milliseconds of a 12-hour date, read as UTC whatever the session zone is."""
    # A blank is no date; as NULL it skips the parser, whose failures are expensive.
    stamped = F.concat(blank_to_null(text), F.lit(" +0000"))
    return F.unix_millis(F.try_to_timestamp(stamped, F.lit(_SOURCE_DATE)))
