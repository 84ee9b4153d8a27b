"""Expected against actual values: each matcher gives a score; passing is decided by kind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fuzzy import ratio
from .values import as_list, to_bool, to_date, to_number

FUZZY_PASS, SET_PASS, CONTAINS = 0.72, 0.70, 0.9


def plain(text: Column) -> Column:
    """Lower-cased letters, digits and underscores; everything else is one space between them."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_ \t\n\r\f\x0B]", " ")
    return F.trim(F.regexp_replace(spaced, r"[ \t\n\r\f\x0B]+", " "))


def _score(ok: Column) -> Column:
    return F.coalesce(ok, F.lit(False)).cast("double")


def bool_score(expected: Column, actual: Column) -> Column:
    return _score(to_bool(expected) == to_bool(actual))


def number_score(expected: Column, actual: Column) -> Column:
    return _score(F.abs(to_number(expected) - to_number(actual)) <= 1e-9)


def date_score(expected: Column, actual: Column) -> Column:
    """Dates in one form; what can't be read as a date is compared in plain form."""
    return _score((to_date(expected) != "") & (plain(to_date(expected)) == plain(to_date(actual))))


def string_score(expected: Column, actual: Column) -> Column:
    return _score(plain(expected) == plain(actual))


def fuzzy_score(expected: Column, actual: Column) -> Column:
    """Similarity of the plain texts; at least 0.9 where one holds the other."""
    e, a = plain(expected), plain(actual)
    holds = (F.length(e) > 0) & (F.length(a) > 0) & (F.contains(e, a) | F.contains(a, e))
    return F.when((e == "") & (a == ""), 1.0).when((e == "") | (a == ""), 0.0).otherwise(F.greatest(ratio(e, a), F.when(holds, CONTAINS).otherwise(0.0)))


def set_f1(expected: Column, actual: Column) -> Column:
    """F1 over distinct items; two items match if they are equal or one holds the other."""
    items = lambda c: F.array_distinct(F.filter(F.transform(as_list(c), plain), lambda x: F.length(x) > 0))
    e, a = items(expected), items(actual)
    hits = lambda xs, ys: F.size(F.filter(xs, lambda x: F.exists(ys, lambda y: F.contains(x, y) | F.contains(y, x))))
    recall, precision = hits(e, a) / F.size(e), hits(a, e) / F.size(a)
    both = F.when(recall + precision > 0, 2 * recall * precision / (recall + precision)).otherwise(0.0)
    return F.when((F.size(e) == 0) & (F.size(a) == 0), 1.0).when((F.size(e) == 0) | (F.size(a) == 0), 0.0).otherwise(both)


def passed(strategy: Column, score: Column) -> Column:
    return F.when(strategy == "fuzzy", score >= FUZZY_PASS).when(strategy.isin("set_f1", "judge"), score >= SET_PASS).otherwise(score >= 1.0)
