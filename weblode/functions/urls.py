"""URL rules: page identity, link resolution, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns.
_VALID_REF = r"\A(?:http|/|[a-zA-Z0-9]).*\z"
_SCHEME_OR_QUERY = r"http://|https://|\?.*"
_HTML_EXT = r"\.html"
# From the first path segment with a dot on.
_FROM_DOTTED_SEGMENT = r"(?s)(?:\A|/)([^/]*\.[^/]*(?:/.*)?)\z"


def strip_html_ext(url: Column) -> Column:
    """Remove every ``.html``, also inside the URL."""
    return F.regexp_replace(url, _HTML_EXT, "")


def url_from_path(path: Column) -> Column:
    """URL of a crawled file; empty if no path segment has a dot."""
    return strip_html_ext(F.regexp_extract(path, _FROM_DOTTED_SEGMENT, 1))


def strip_scheme_and_query(url: Column) -> Column:
    """Fragments, trailing slashes and letter case stay."""
    return F.regexp_replace(url, _SCHEME_OR_QUERY, "")


def self_url(url: Column) -> Column:
    """Identity of a page known by its full address instead of a file path."""
    return strip_html_ext(strip_scheme_and_query(url))


def domain_of(url: Column) -> Column:
    return F.substring_index(url, "/", 1)


def is_valid_ref(href: Column) -> Column:
    """Starts with ``http``, a slash, a letter or a digit; has no line break."""
    return href.rlike(_VALID_REF)


def is_absolute(href: Column) -> Column:
    return href.startswith("http")


def normalize_link(domain: Column, href: Column) -> Column:
    """Resolve against the domain root, then drop scheme and query."""
    absolute = (
        F.when(is_absolute(href), href)
        .when(href.startswith("/"), F.concat(domain, href))
        .otherwise(F.concat(domain, F.lit("/"), href))
    )
    return strip_scheme_and_query(absolute)


def website_id(url: Column) -> Column:
    """First 128 bits of SHA-256 in hex: the same on every run and node, no
    coordination, and a collision among 10^11 URLs has odds below 10^-16."""
    return F.substring(F.sha2(url, 256), 1, 32)


def bucket_of(key: Column, buckets: int) -> Column:
    """Storage bucket of a lookup key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
