"""Text clean-up expressions; everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The word boundary of title casing is any non-alphanumeric character, not only whitespace.
_RUNS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, use) -> Column:
    """Evaluate ``value`` once per row and hand it to ``use`` as often as needed.

    ``nullif`` and the like name their argument twice; inside a lambda Spark does not share it.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def filled(text: Column) -> Column:
    """``text``, missing if it is empty; evaluated once."""
    return let(text, lambda t: F.when(t != "", t))


def blank_to_null(col: Column | str) -> Column:
    """Trim spaces; an empty rest is missing."""
    return F.nullif(F.trim(_c(col)), F.lit(""))


def squash(col: Column | str) -> Column:
    """Collapse every run of (Unicode) whitespace to one space and strip the ends."""
    return F.trim(F.regexp_replace(_c(col), r"(?U)\s+", " "))


def first_filled(*cols: Column | str) -> Column:
    """First value that is neither missing nor blank, returned untrimmed."""
    return F.coalesce(*[let(_c(c), lambda text: F.when(squash(text) != "", text)) for c in cols])


def contains_any(col: Column | str, needles) -> Column:
    hit = F.lit(False)
    for needle in needles:
        hit = hit | _c(col).contains(needle)
    return hit


def initcap_words(col: Column | str) -> Column:
    """Capitalise after every non-alphanumeric character (``co-op`` gives ``Co-Op``)."""
    runs = F.regexp_extract_all(_c(col), F.lit(_RUNS))
    cased = F.transform(
        runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.substr(r, F.lit(2)))))
    return F.array_join(cased, "")


def clean_title(col: Column | str) -> Column:
    """Collapse whitespace and drop the promotion badges."""
    bare = F.replace(F.replace(squash(col), F.lit("HOT"), F.lit("")), F.lit("✨"), F.lit(""))
    return filled(F.trim(bare))


def extract_deadline(col: Column | str) -> Column:
    """First d/m/yyyy inside the text, else the text itself; blank is missing."""
    return let(_c(col), lambda text: F.when(text != "", F.coalesce(filled(
        F.regexp_extract(text, r"(\d{1,2}/\d{1,2}/\d{4})", 1)), text)))


def drop_prefix(text: Column, prefix: Column, joint: str) -> Column:
    """Remove ``prefix`` (any case) and a following ``joint`` pattern from the start of ``text``."""
    rest = F.substr(text, F.length(prefix) + 1)
    return F.when(
        F.startswith(F.lower(text), F.lower(prefix)), F.trim(F.regexp_replace(rest, joint, ""))
    ).otherwise(text)


def tag_items(tags: Column | str, regex_mode: str) -> Column:
    """Distinct normalised items of a ``;``-separated text, as an array."""
    items = F.transform(F.split(F.coalesce(_c(tags), F.lit("")), ";"), lambda i: F.trim(i))
    items = F.filter(items, lambda i: i != "")
    return F.array_distinct(F.transform(items, lambda i: F.lower(_collapse(i, regex_mode))))


def location_items(addresses: Column | str, fallback: Column | str, regex_mode: str) -> Column:
    """Distinct normalised places of one posting; ``fallback`` counts only when addresses are blank."""
    has_address = F.coalesce(F.trim(_c(addresses)), F.lit("")) != ""
    items = F.when(has_address, F.split(_c(addresses), ";")).otherwise(
        F.array(F.coalesce(_c(fallback), F.lit(""))))
    items = F.filter(F.transform(items, lambda i: F.trim(i)), lambda i: i != "")
    names = F.transform(items, lambda i: _collapse(F.lower(_strip_bullet(i, regex_mode)), regex_mode))
    return F.array_distinct(F.filter(names, lambda n: n != ""))


def _collapse(col: Column, regex_mode: str) -> Column:
    # As written the pattern asks for a literal backslash followed by letters s.
    return F.regexp_replace(col, r"\s+" if regex_mode == "intended" else r"\\s+", " ")


def _strip_bullet(col: Column, regex_mode: str) -> Column:
    # As written the class holds dash, bullet, backslash and the letter s.
    return F.regexp_replace(col, r"^[-•\s]+" if regex_mode == "intended" else r"^[-•\\s]+", "")


def parse_deadline(col: Column | str, regex_mode: str) -> Column:
    """d/m/yyyy to a date; free text and impossible dates are missing."""
    if regex_mode == "as_written":
        # The doubled backslashes ask for literal text no deadline contains.
        return F.lit(None).cast("date")
    parsed = F.try_to_date(_c(col), "d/M/yyyy")
    return F.when(_c(col).rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), parsed)
