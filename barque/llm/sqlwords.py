"""Words of whole texts by DataFrame functions alone."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands between words: all ASCII but letters and digits; or white space alone.
NO_LETTER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WHITE = r"[\x20\x09-\x0D]+"


def lower_az(text: Column) -> Column:
    """A-Z in lower case, every other character as it is. Texts of ASCII alone take the quicker function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def split_words(text: Column, between: str) -> Column:
    """The words of a text, an empty array for an empty one."""
    return F.array_remove(F.split(text, between), "")
