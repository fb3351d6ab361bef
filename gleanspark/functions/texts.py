"""Text predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: control characters, but not tab, newline, form feed and carriage return.
CONTROL = r"[\x00-\x08\x0B\x0E-\x1F\x7F]"


def is_valid(text: Column) -> Column:
    """Whether a text is there, not empty, and at most a tenth control characters; never null."""
    few = F.regexp_count(text, F.lit(CONTROL)) * 10 <= F.char_length(text)
    return F.coalesce((F.char_length(text) > 0) & few, F.lit(False))
