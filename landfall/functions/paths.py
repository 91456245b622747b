"""Path functions: percent decoding (F8), base name (F9), leading slash (F11),
store and key of a location (S7)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions._col import col

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def url_unquote(c) -> Column:
    """F8: percent decoding; ``+`` stays ``+``. Malformed escapes leave the text as is."""
    c = col(c)
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def url_unquote_plus(c) -> Column:
    """F8, form of event keys: ``+`` is a blank."""
    c = col(c)
    return F.coalesce(F.try_url_decode(c), c)


def base_name(c) -> Column:
    """the part after the last ``/``."""
    return F.regexp_extract(col(c), r"[^/]*$", 0)


def strip_leading_slash(c) -> Column:
    """drop every leading ``/``."""
    return F.regexp_replace(col(c), r"^/+", "")


def location_store(c) -> Column:
    """The store (host) of ``scheme://store/key``; empty when there is none."""
    return F.regexp_extract(col(c), _SCHEME + r"([^/?#]*)", 1)


def location_key(c) -> Column:
    """The key of ``scheme://store/key``, without query or fragment,
    leading slashes dropped, percent-decoded once."""
    path = F.regexp_extract(col(c), _SCHEME + r"[^/?#]*([^?#]*)", 1)
    return url_unquote(strip_leading_slash(path))
