"""Hashed keys, date keys and URL parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hiremart.functions.text import _c

# Fixed value: what a missing field contributes to a hashed key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"

_LEAD = 17  # bytes before a packed key that is no digest of 16

# The two path shapes of a posting page.
JOB_PATHS = (r"^/viec-lam/.+?/\d+\.html$", r"^/brand/.+?/tuyen-dung/.+-j\d+\.html$")


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the text of the fields joined by dashes; never missing."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def packed_key(key: Column | str) -> Column:
    """A text key in bytes for the way through a shuffle; different keys stay different, null stays null.

    A digest in lower-case hex, which no codec shrinks much on the way, becomes its 16 bytes; other text
    follows 17 zero bytes, so that it is never as long as a digest. The order of keys is not kept.
    """
    key = _c(key)
    return F.when(key.rlike(r"\A[0-9a-f]{32}\z"), F.unhex(key)).otherwise(
        F.concat(F.lit(bytes(_LEAD)), key.cast("binary")))


def unpacked_key(key: Column | str) -> Column:
    """The text of a packed key."""
    key = _c(key)
    return F.when(F.octet_length(key) == _LEAD - 1, F.lower(F.hex(key))).otherwise(
        F.substr(key, F.lit(_LEAD + 1)).cast("string"))


def scd_id(key: Column | str, updated_at: Column | str) -> Column:
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in (key, updated_at)]
    return F.md5(F.concat_ws("|", *parts))


def date_id(day: Column | str) -> Column:
    """yyyymmdd as an integer."""
    return F.date_format(_c(day), "yyyyMMdd").cast("int")


def url_path(url: Column | str) -> Column:
    """Path part of an absolute or relative link; ``''`` for a bare host."""
    return F.regexp_extract(_c(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def absolute_url(href: Column | str, base_url: str) -> Column:
    """Resolve a link found on a page of ``base_url``, a host without a path of its own.

    ``?query`` and ``#fragment`` alone stay on the base; ``.`` and ``..`` parts of a path are resolved
    and never leave the host; an empty link is the base itself.
    """
    href, base = _c(href), base_url.rstrip("/")
    scheme = base.split("://", 1)[0]
    rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    parts = F.split(F.regexp_replace(path, r"^/+", ""), "/")
    # Each ".." drops the part kept before it.
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda out, p: F.when(
        p == "..", F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0)))).when(
        p == ".", out).otherwise(F.concat(out, F.array(p))))
    last = F.element_at(parts, -1)
    folder = F.when(last.isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    dotted = F.concat(F.lit(f"{base}/"), F.array_join(kept, "/"), folder, rest)
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(f"{scheme}:"), href))
        .when(path == "", F.concat(F.lit(base_url), rest))
        .when(path.rlike(r"(^|/)[.][.]?(/|$)"), dotted)
        .when(href.startswith("/"), F.concat(F.lit(base), href))
        .otherwise(F.concat(F.lit(f"{base}/"), href))
    )


def is_job_url(href: Column | str) -> Column:
    path = url_path(href)
    path = F.when(path != "", path).otherwise(_c(href))
    hit = path.rlike(JOB_PATHS[0]) | path.rlike(JOB_PATHS[1])
    return F.coalesce(hit, F.lit(False))
