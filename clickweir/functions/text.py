"""Text conventions shared by extraction, coercion and export."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that read as 1 in an integer column.
TRUE_WORDS = ("t", "true", "on")


def null_text(text: Column) -> Column:
    """NULL for the empty string and for the four-letter text ``null``."""
    return F.when(~text.isin("", "null"), text)


def is_true_word(text: Column) -> Column:
    """True for a word that counts as 1 in an integer column."""
    return text.isin(*TRUE_WORDS)
