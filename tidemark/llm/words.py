"""Words of a text, the same in Python and in Spark expressions."""

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD_PATTERN)
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text: str | None) -> list[str]:
    """Runs of characters other than ASCII white space; none for a null."""
    return WORDS.findall(text) if text else []


def lower_ascii(text: str | None) -> str:
    """The text with A-Z in lower case and all else as it is."""
    return text.translate(LOWER) if text else ""


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
