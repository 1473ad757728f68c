"""Text helpers: the word tokenizer and case mapping, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: words are separated by runs of non-word characters.  ``\W`` is
# the ASCII class [^a-zA-Z0-9_], so accented letters split words.
WORD_SEPARATOR = r"\W+"


def word_array(text: Column) -> Column:
    """Lower-cased text split on non-word runs (may contain empty strings)."""
    return F.split(F.lower(text), WORD_SEPARATOR)


def upper(text: Column) -> Column:
    return F.upper(text)
