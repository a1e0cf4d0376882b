"""URL columns: split, query pairs, canonical form. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The generic URI grammar of RFC 3986, appendix B, with a strict scheme.
_URI = (
    r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"
    r"(?:\?([^#]*))?(?:#([\s\S]*))?\z"
)
_IPV6 = r"(?=(?:[^:]*:){2,8}[^:]*\z)(?!.*::.*::)(?!.*:::)[0-9A-Fa-f:]+(?:\d{1,3}(?:\.\d{1,3}){3})?(?:%.+)?"
_BRACKETS = rf"^[^\[\]]*\[(?:v[0-9A-Fa-f]+\..+|{_IPV6})\z"


def url_pieces(url: Column) -> Column:
    """ARRAY of the five raw pieces in one regex pass; NULL for a NULL url.

    Line breaks are dropped from the URL first, so they can separate the pieces.
    """
    clean = F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")
    return F.split(F.regexp_replace(clean, _URI, "$1\n$2\n$3\n$4\n$5"), "\n")


def split_pieces(pieces: Column) -> Column:
    """Struct of scheme (lower case), netloc, path, params, query, fragment.

    Missing parts are empty strings.
    """
    return F.struct(
        F.lower(pieces[0]).alias("scheme"),
        pieces[1].alias("netloc"),
        F.regexp_replace(pieces[2], r";[^/]*\z", "").alias("path"),
        F.regexp_extract(pieces[2], r";([^/]*)\z", 1).alias("params"),
        pieces[3].alias("query"),
        pieces[4].alias("fragment"),
    )


def split_url(url: Column) -> Column:
    """``split_pieces`` of a URL; all fields are NULL for a NULL url."""
    return split_pieces(url_pieces(url))


def netloc_is_valid(netloc: Column) -> Column:
    """False where square brackets do not enclose an IP literal."""
    has_open, has_close = netloc.contains("["), netloc.contains("]")
    host = F.substring_index(netloc, "]", 1)
    return ~(has_open | has_close) | (has_open & has_close & host.rlike(_BRACKETS))


def _decode(text: Column) -> Column:
    # A stray "%" is kept as it is; only "%" and two hex digits are decoded.
    return F.url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def query_pairs(query: Column) -> Column:
    """ARRAY<STRUCT<k, v>> of the decoded pairs in order; blank values are dropped."""
    filled = F.filter(F.split(query, "&"), lambda p: p.rlike(r"^[^=]*=[\s\S]"))
    return F.transform(
        filled,
        lambda p: F.struct(
            _decode(F.regexp_extract(p, "^([^=]*)=", 1)).alias("k"),
            _decode(F.regexp_extract(p, r"^[^=]*=([\s\S]*)\z", 1)).alias("v"),
        ),
    )


def is_search(pairs: Column) -> Column:
    return F.exists(pairs, lambda p: p["k"].isin("q", "s"))


def tracking_keys(pairs: Column) -> Column:
    """The distinct campaign keys that the canonical form leaves out."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.filter(keys, lambda k: k.startswith("utm_"))


def canonical_query(pairs: Column) -> Column:
    """First value of every key but ``utm_*``, sorted by key, values left decoded."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    kept = F.array_sort(F.filter(keys, lambda k: ~k.startswith("utm_")))
    return F.array_join(
        F.transform(
            kept, lambda k: F.concat(k, F.lit("="), F.filter(pairs, lambda p: p["k"] == k)[0]["v"])
        ),
        "&",
    )


def canonical_path(path: Column) -> Column:
    index = F.lit("/index.html")
    return (
        F.when(path.isin("", "/"), F.lit("/"))
        .when(path == index, F.lit("/"))
        .when(path.endswith(index), F.substring(path, F.lit(1), F.length(path) - 11))
        .when(path.endswith(F.lit("/")), F.substring(path, F.lit(1), F.length(path) - 1))
        .otherwise(path)
    )


def join_canonical(parts: Column, pairs: Column) -> Column:
    """The canonical URL from ``split_url`` and ``query_pairs`` columns."""
    netloc = F.regexp_replace(F.lower(parts["netloc"]), r"^www\.", "")
    path = parts["path"]
    has_authority = (netloc != "") | (path == "") | path.startswith("/")
    page = F.concat(
        F.when(parts["scheme"] != "", F.concat(parts["scheme"], F.lit(":"))).otherwise(F.lit("")),
        F.when(has_authority, F.concat(F.lit("//"), netloc)).otherwise(F.lit("")),
        canonical_path(path),
    )
    return F.array_join(F.filter(F.array(page, canonical_query(pairs)), lambda p: p != ""), "?")


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host without ``www.``, tidy path, sorted query.

    NULL where the authority is not a valid one.
    """
    parts = split_url(url)
    return F.when(
        netloc_is_valid(parts["netloc"]), join_canonical(parts, query_pairs(parts["query"]))
    )
