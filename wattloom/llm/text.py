"""Columns of words, all inside the JVM."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words between blanks, tabs and line ends.
BLANK_WORDS = r"[^\x20\x09-\x0D]+"
#: Words of ASCII letters, digits and everything beyond ASCII.
ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column, pattern: str = BLANK_WORDS) -> Column:
    """The words of a text in order; an empty array for null."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))
