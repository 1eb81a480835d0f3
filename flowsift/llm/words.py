"""Word patterns of the contracts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word definitions of the contracts.
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def spaced_count(text: Column) -> Column:
    """Number of white-space separated words; 0 for a NULL text."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED)), F.lit(0)).cast("bigint")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character unchanged; empty for NULL."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's text leaves the remainder; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder
