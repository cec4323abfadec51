"""URL expressions: normal form, domain and origin, as native column chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Last path segment with empty parameters; ``#`` is gone by then.
_EMPTY_PARAMS = r"^((?:[a-z][a-z0-9+.-]*:)?//[^/?]*/(?:[^?]*/)?[^/?;]*);(\?|$)"
_AUTHORITY = r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)"


def normalize_url(url: Column) -> Column:
    """Trimmed, lower-cased as a whole, without fragment, empty query and empty params; null stays null."""
    u = F.lower(F.regexp_replace(url, r"^\s+|\s+$", ""))
    u = F.regexp_replace(u, r"(?s)#.*$", "")
    u = F.regexp_replace(u, r"^([^?]*)\?$", "$1")
    return F.regexp_replace(u, _EMPTY_PARAMS, "$1$2")


def domain(url: Column) -> Column:
    """Authority without one leading ``www.``; port and user info stay, no scheme gives an empty string."""
    return F.regexp_replace(F.regexp_extract(F.lower(url), _AUTHORITY, 1), r"^www\.", "")


def origin(url: Column) -> Column:
    """``scheme://authority``; null where either is missing."""
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://[^/?#]+", 1)
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)
    return F.when(rest != "", F.concat(F.lower(scheme), F.lit("://"), rest))
