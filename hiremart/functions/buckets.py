"""Report buckets: first matching substring wins, over lower-cased text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hiremart import config as C
from hiremart.functions.text import _c, contains_any


def _first_match(text: Column, rules, default) -> Column:
    out = None
    for value, needles in rules:
        out = (F if out is None else out).when(contains_any(text, needles), F.lit(value))
    return out.otherwise(F.lit(default))


def city(location: Column | str) -> Column:
    return _first_match(F.lower(_c(location)), C.CITY_LABELS, C.CITY_OTHER)


def size_label(size: Column | str) -> Column:
    rules = [(label, needles) for label, _, needles in C.SIZE_BUCKETS]
    return _first_match(F.lower(_c(size)), rules, C.SIZE_OTHER[0])


def size_index(size: Column | str) -> Column:
    rules = [(index, needles) for _, index, needles in C.SIZE_BUCKETS]
    return _first_match(F.lower(_c(size)), rules, C.SIZE_OTHER[1])


def experience_index(experience: Column | str) -> Column:
    rules = [(index, (needle,)) for index, needle in C.EXPERIENCE_ORDER]
    return _first_match(F.lower(_c(experience)), rules, C.EXPERIENCE_OTHER)
