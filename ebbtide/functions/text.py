"""Text columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the edges of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       "
    "         　"
)


def strip(text: Column) -> Column:
    """Drop white space of any kind at both ends; ``trim`` alone knows only the blank."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def blank_words_to_null(text: Column, words: Iterable[str]) -> Column:
    return F.when(~text.isin(*words), text)
