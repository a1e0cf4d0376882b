"""URL screening, first-seen dedup, rule lists and limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import urls as U
from pageloom.operators.columns import with_computed
from pageloom.session import shared_table

# Hosts of link shorteners, compared with the whole authority.
SHORTENERS = ("bit.ly", "t.co", "goo.gl", "lnkd.in", "tinyurl.com")
# Substrings of a lower-cased path that mark a page without content.
PATH_KEYWORDS = ("login", "signup", "admin", "cart", "checkout")
# Extensions of HTML pages, for the optional strict test.
PAGE_EXTENSIONS = (".html", ".htm", ".php", ".asp", ".aspx", ".jsp")
# Media files a crawl leaves out.
MEDIA_BLOCK_RULES = tuple(
    rf".*\.{ext}($|\?)"
    for ext in (
        "mp4", "webm", "mov", "m4v", "avi", "mkv", "mp3", "ogg", "wav", "flac",
        "jpe?g", "png", "gif", "webp", "avif", "svg",
    )
)
# Embeds and challenge pages a crawl leaves out as well.
EMBED_BLOCK_RULES = (
    r".*challenges\.cloudflare\.com.*",
    r".*cdn-cgi.*",
    r".*player\.vimeo\.com.*",
    r".*youtube\.com/embed.*",
)


def screen_urls(df: DataFrame, url: str = "url", strict_pages: bool = False) -> DataFrame:
    """Add ``canonical_url`` and ``reject_reason`` (NULL = passed); no shuffle.

    The checks run in a fixed order and the first one that fails names the reason.
    ``strict_pages`` also asks for a page extension or none, which is off by default:
    any extension passes.
    """
    parts, pairs = F.col("_parts"), F.col("_pairs")
    path = F.lower(parts["path"])
    reason = (
        F.when(F.col(url).isNull(), "scheme")
        .when(~U.netloc_is_valid(parts["netloc"]), "invalid_url")
        .when(~parts["scheme"].isin("http", "https"), "scheme")
        .when(parts["netloc"].isin(*SHORTENERS), "shortener")
        .when(path.rlike("|".join(PATH_KEYWORDS)), "path_keyword")
        .when(U.is_search(pairs), "search")
    )
    if strict_pages:
        extension = F.regexp_extract(path, r"(\.[^./]*)\z", 1)
        reason = reason.when(~extension.isin("", *PAGE_EXTENSIONS), "extension")
    pieces = df.withColumn("_pieces", U.url_pieces(F.col(url)))
    split = with_computed(
        pieces,
        _parts=U.split_pieces(F.col("_pieces")),
        _pairs=U.query_pairs(F.col("_pieces")[3]),
    )
    return split.select(*df.columns, "_parts", "_pairs", reason.alias("reject_reason")).select(
        *df.columns,
        "reject_reason",
        F.when(
            F.col("reject_reason").isNull() | (F.col("reject_reason") != "invalid_url"),
            U.join_canonical(parts, pairs),
        ).alias("canonical_url"),
    )


def _winners(passed: DataFrame, seq: str) -> DataFrame:
    """The smallest ``seq`` of every canonical URL.

    A hash aggregate over one string and one long with map-side combine, so a URL that
    holds a large share of the rows is reduced before the shuffle.
    """
    return passed.groupBy("canonical_url").agg(F.min(seq).alias(seq)).select(seq)


def url_decision(df: DataFrame, url: str = "url", seq: str = "seq", strict_pages: bool = False) -> DataFrame:
    """Every row with ``canonical_url``, ``reject_reason`` and ``accepted``.

    A URL that passes the row-local checks is a ``duplicate`` unless it is the first of
    its canonical form by ``seq`` (a unique BIGINT). Only passing rows take part.
    Select the narrow columns first: this joins the rows back by ``seq``.
    """
    screened = screen_urls(df, url, strict_pages)
    firsts = _winners(screened.where("reject_reason is null"), seq).withColumn("_first", F.lit(True))
    reason = F.when(
        F.col("reject_reason").isNull() & F.col("_first").isNull(), F.lit("duplicate")
    ).otherwise(F.col("reject_reason"))
    return (
        screened.join(firsts, seq, "left")
        .withColumn("reject_reason", reason)
        .withColumn("accepted", F.col("reject_reason").isNull())
        .drop("_first")
    )


def first_seen(
    df: DataFrame,
    url: str = "url",
    seq: str = "seq",
    history: DataFrame | None = None,
    write_repeats: bool = False,
) -> DataFrame:
    """The accepted rows of ``df`` with their ``canonical_url``, all columns kept.

    The repeats are found on ``(seq, canonical_url)`` alone and then taken out of the
    wide rows by ``seq``. With ``write_repeats`` they go through a table in the shared
    folder first, so that the planner knows their size: below the broadcast threshold the
    wide rows are not shuffled at all, above it they are joined by the evenly spread
    ``seq``. ``history`` holds canonical URLs of earlier runs; those are repeats too. It meets
    one row per URL, after the rows of a frequent one are reduced.
    """
    passed = screen_urls(df, url).where("reject_reason is null").drop("reject_reason")
    narrow = passed.select(seq, "canonical_url")
    if write_repeats:
        narrow = shared_table(narrow)
    fresh = narrow.groupBy("canonical_url").agg(F.min(seq).alias(seq))
    if history is not None:
        fresh = fresh.join(history.select("canonical_url"), "canonical_url", "left_anti")
    repeats = narrow.select(seq).join(fresh.select(seq), seq, "left_anti")
    if write_repeats:
        repeats = shared_table(repeats)
    return passed.join(repeats, seq, "left_anti")


def _any_of(url: Column, patterns: Sequence[str]) -> Column:
    return url.rlike("|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)


def block_rules(df: DataFrame, patterns: Sequence[str] = MEDIA_BLOCK_RULES, url: str = "url") -> DataFrame:
    """Drop rows whose URL matches any pattern; one alternation, one regex pass."""
    return df.where(~F.coalesce(_any_of(F.col(url), patterns), F.lit(False)))


def scope_include(df: DataFrame, patterns: Sequence[str], url: str = "url") -> DataFrame:
    """Keep rows whose URL matches any pattern."""
    return df.where(_any_of(F.col(url), patterns))


def page_limit(df: DataFrame, limit: int, seq: str = "seq") -> DataFrame:
    """The first ``limit`` pages by ``seq``; a top-k, so only k rows per task are merged."""
    return df.orderBy(seq).limit(limit)


def reject_counts(decisions: DataFrame) -> DataFrame:
    """Row count per outcome; accepted rows count as ``accepted``."""
    return decisions.groupBy(
        F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")
    ).agg(F.count("*").alias("urls"))


def tracking_summary(df: DataFrame, url: str = "url") -> DataFrame:
    """Per canonical host and ``utm_*`` key, how many URLs lost that key."""
    parts = F.col("_parts")
    return (
        df.select(U.split_url(F.col(url)).alias("_parts"))
        .select(
            F.regexp_replace(F.lower(parts["netloc"]), r"^www\.", "").alias("host"),
            F.explode(U.tracking_keys(U.query_pairs(parts["query"]))).alias("dropped_key"),
        )
        .groupBy("host", "dropped_key")
        .agg(F.count("*").alias("urls"))
    )
