"""Url expressions, all inside the JVM but for joining general references."""

from __future__ import annotations

from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# A url that contains one of these, case-sensitively and anywhere, is not supported.
UNSUPPORTED = (
    ".ics .mng .pct .bmp .gif .jpg .jpeg .png .pst .psp .tif .tiff .drw .dxf .eps .woff2 .svg .mp3 .wma .ogg .wav .ra .aac .mid .aiff "
    ".3gp .asf .asx .avi .mp4 .woff .mpg .qt .rm .swf .wmv .m4a .css .pdf .doc .docx .exe .bin .rss .zip .rar .msu .flv .dmg .xls .xlsx .ico"
).split()
# These are unsupported only as downloads. (The rest are so anyway.)
UNSUPPORTED_DOWNLOADS = [f"{x}?download=true" for x in (".ai", ".ps", ".au", ".mov")]
# Schemes whose last path segment can have ;parameters.
PARAMETER_SCHEMES = " ftp hdl prospero http imap https shttp rtsp rtsps rtspu sip sips mms sftp tel".split(" ")

_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"


def unsupported_literals() -> list[str]:
    """The shortest list that rejects the same urls: what contains another literal adds nothing."""
    every = [*UNSUPPORTED, *UNSUPPORTED_DOWNLOADS]
    return [x for x in every if not any(y != x and y in x for y in every)]


def with_scheme(url: Column) -> Column:
    """The url with https:// ahead, unless it has http:// or https:// (in lower case)."""
    return F.when(url.startswith("https://") | url.startswith("http://"), url).otherwise(F.concat(F.lit("https://"), url))


def _clean(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def _valid(netloc: Column) -> Column:
    """Whether brackets are balanced; parsers refuse the rest."""
    return F.contains(netloc, F.lit("[")) == F.contains(netloc, F.lit("]"))


def netloc(url: Column) -> Column:
    """Host with user and port as written; empty if there is none, null for a url that cannot be parsed."""
    part = F.regexp_extract(_clean(url), _SPLIT, 2)
    return F.when(_valid(part), part)


def path(url: Column) -> Column:
    """Path without query, fragment and the last segment's ;parameters."""
    clean = _clean(url)
    part, scheme = F.regexp_extract(clean, _SPLIT, 3), F.lower(F.regexp_extract(clean, _SPLIT, 1))
    bare = F.when(scheme.isin(PARAMETER_SCHEMES), F.regexp_replace(part, r";[^/]*$", "")).otherwise(part)
    return F.when(_valid(F.regexp_extract(clean, _SPLIT, 2)), bare)


def trim_slashes(url: Column) -> Column:
    return F.rtrim(url, F.lit("/"))


def is_unsupported(url: Column) -> Column:
    found = F.lit(False)
    for literal in unsupported_literals():
        found = found | url.contains(literal)
    return found


def join_one(base: str | None, reference: str | None) -> str | None:
    """The reference resolved against the page's url; null if either cannot be parsed."""
    if base is None or reference is None:
        return None
    try:
        joined = urljoin(base, reference)
        urlparse(joined)
        return joined
    except ValueError:
        return None


#: A page's url that roots are taken from as they stand, and references that join to it without further reading: absolute ones
#: and such as start at the root, without dots at the start of a segment or characters that parsers take out.
_PLAIN_BASE = r"^(https?://[A-Za-z0-9.\-]+(?::[0-9]+)?)(?:[/?#][^\s\[\]]*)?$"
_PLAIN_ABSOLUTE = r"^https?://[A-Za-z0-9.\-]+(?::[0-9]+)?(?:/[A-Za-z0-9_~%+,=&\-]+(?:\.[A-Za-z0-9_~%+,=&\-]+)*)*/?(?:\?[A-Za-z0-9_.~%+,=&/\-]+)?(?:#[A-Za-z0-9_.~%+,=&/\-]+)?$"
_PLAIN_ROOTED = r"^(?:/[A-Za-z0-9_~%+,=&\-]+(?:\.[A-Za-z0-9_~%+,=&\-]+)*)+/?(?:\?[A-Za-z0-9_.~%+,=&/\-]+)?(?:#[A-Za-z0-9_.~%+,=&/\-]+)?$"


def absolute(base: Column, reference: Column) -> Column:
    """A reference as an absolute url without trailing slashes; fragments stay.

    Plain absolute references and plain ones from the root are joined in columns; only others go through Python.
    """

    @F.pandas_udf("string")
    def joined(bases: pd.Series, references: pd.Series) -> pd.Series:
        return pd.Series([join_one(b, r) for b, r in zip(bases, references, strict=True)], dtype=object)

    plain_base, whole = base.rlike(_PLAIN_BASE), reference.rlike(_PLAIN_ABSOLUTE) & base.rlike(_PLAIN_BASE)
    rooted = plain_base & reference.rlike(_PLAIN_ROOTED)
    # What is joined in columns goes to Python as null.
    rest = F.when(~F.coalesce(whole | rooted, F.lit(False)), reference)
    made = F.when(whole, reference).when(rooted, F.concat(F.regexp_extract(base, _PLAIN_BASE, 1), reference)).otherwise(joined(F.when(rest.isNotNull(), base), rest))
    return trim_slashes(made)


def may_hop(start_domain: Column, parent_domain: Column, domain: Column) -> Column:
    """Whether a link stays, returns to the start domain, or leaves it for the first time."""
    return (domain == start_domain) | (domain == parent_domain) | (parent_domain == start_domain)


def link_depth(targeted: Column, parent_depth: Column) -> Column:
    """Steps from the last targeted url."""
    return F.when(targeted, F.lit(0)).otherwise(parent_depth + 1)


def is_queued(depth: Column, deadend: Column, from_sitemap: Column, max_depth: int) -> Column:
    return F.coalesce(depth <= max_depth, F.lit(False)) & ~deadend & ~from_sitemap
