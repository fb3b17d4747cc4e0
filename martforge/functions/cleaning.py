"""Parsing and cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEDGER_DATE_PATTERN = "M/d/yyyy"

# Characters the Latin-1 extract carries in product names and
# what they become (curly quotes 0x93/0x94 -> '"', no-break space -> ' ').
ODD_CHARACTERS = "\u0093\u0094\u00a0"
ODD_REPLACEMENTS = '"" '


def parse_text_date(c: Column | str, pattern: str = LEDGER_DATE_PATTERN) -> Column:
    """Text -> date by pattern; anything unparsable (or trailing text) is NULL.

    Blank fields (frequent in extracts) skip the parser, which would only
    fail on them, at the same NULL result.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(col) > 0, F.try_to_date(col, pattern))


def clean_text(c: Column | str) -> Column:
    """Every ',' -> ' -', curly quotes -> '"', no-break space -> ' '."""
    col = F.col(c) if isinstance(c, str) else c
    # plain replaces work on the bytes; ``translate`` takes every text apart into characters
    for odd, plain in ((",", " -"), *zip(ODD_CHARACTERS, ODD_REPLACEMENTS)):
        col = F.replace(col, F.lit(odd), F.lit(plain))
    return col


def iso_to_date(c: Column | str) -> Column:
    """ISO date or date-time text (with offset) -> calendar date of the text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.substring(col, 1, 10).try_cast("date")


def to_number(c: Column | str, type_name: str) -> Column:
    """Tolerant numeric cast: bad text -> NULL instead of an ANSI error."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(type_name)


def to_timestamp_tolerant(c: Column | str, data_type=None) -> Column:
    """Coerce a date/timestamp/text column to timestamp; bad text -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    name = getattr(data_type, "typeName", lambda: "string")()
    if name in ("date", "timestamp", "timestamp_ntz"):
        return col.cast("timestamp")
    return F.coalesce(F.try_to_timestamp(col), F.try_to_timestamp(col, F.lit(LEDGER_DATE_PATTERN)))
