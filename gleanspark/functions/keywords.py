"""First keyword hit: an ordered list of patterns, tried on the host and then on the path."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns that Python's and Java's engines read alike: literals, sets, groups, plain repeats, anchors, alternatives.
_ALIKE = re.compile(r"(?:[\w \-/%:@,~=&!#<>\"'.|^]|\$(?=$|\))|\\[.\-/+*?()\[\]|^$\\]|\[\^?[A-Za-z0-9_./%\-]+\]|\((?:\?:)?|\)|(?<=[^|(])[*+?](?![*+?])|(?<=[^|(])\{\d+(?:,\d*)?\}(?![*+?]))*", re.ASCII)


def reads_alike(pattern: str) -> bool:
    """Whether a pattern may run in the JVM; others run in Python."""
    if not _ALIKE.fullmatch(pattern):
        return False
    try:
        re.compile(pattern)
    except re.error:
        return False
    return True


def first_hit_of(netloc: str | None, path: str | None, keywords: Sequence[str]) -> str:
    """The text that the first keyword matches, host before path; an empty match ends the search as a miss."""
    for part in (netloc or "", path or ""):
        for keyword in keywords:
            found = re.search(keyword, part)
            if found is not None:
                return found[0]
    return ""


def first_hit(netloc: Column, path: Column, keywords: Sequence[str]) -> Column:
    """`first_hit_of` as a column; nulls count as empty."""
    host, rest = F.coalesce(netloc, F.lit("")), F.coalesce(path, F.lit(""))
    if all(map(reads_alike, keywords)):
        tries = [(part, k) for part in (host, rest) for k in keywords]
        whole = lambda part, k: F.regexp_extract(part, f"({k})", 0)
        return reduce(lambda after, x: F.when(x[0].rlike(x[1]), whole(*x)).otherwise(after), reversed(tries), F.lit(""))

    @F.pandas_udf("string")
    def hits(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([first_hit_of(x, y, keywords) for x, y in zip(a, b, strict=True)], dtype=object)

    return hits(host, rest)
