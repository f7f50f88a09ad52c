"""Column expressions for the text conventions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that mean "no accession", compared in upper case.
NO_ACCESSION = ("", "NA", "N/A", "NONE", "NULL", "-")

#: White space that counts as outer white space of a value.
SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0               　"


def strip(col: Column | str) -> Column:
    """``col`` without outer white space of any kind."""
    return F.btrim(F.col(col) if isinstance(col, str) else col, F.lit(SPACES))


def spelled(col: Column | str) -> Column:
    """``col`` stripped and in upper case: one spelling for accessions."""
    return F.upper(strip(col))


def accession(col: Column | str) -> Column:
    """The one spelling of an accession, or null where the text stands for no accession."""
    value = spelled(col)
    return F.when(~value.isin(*NO_ACCESSION), value)


def field_key(col: Column | str) -> Column:
    """A metadata field's name for comparison: lower case, other characters as one underscore, none outside."""
    lowered = F.lower(F.col(col) if isinstance(col, str) else col)
    return F.btrim(F.regexp_replace(lowered, "[^a-z0-9]+", "_"), F.lit("_"))
