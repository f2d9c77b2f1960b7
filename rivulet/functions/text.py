"""Text matching and parsing columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def like(value: ColumnOrName, pattern: str, negate: bool = False) -> Column:
    """Pattern match that ignores case."""
    match = _col(value).ilike(pattern)
    return ~match if negate else match


def any_like(value: ColumnOrName, patterns: Iterable[str]) -> Column:
    """True where at least one pattern matches."""
    return reduce(or_, [like(value, p) for p in patterns])


def classify_like(value: ColumnOrName, labels: Sequence[tuple[str, str]]) -> Column:
    """Label of the first (pattern, label) that matches, NULL if none does."""
    (pattern, label), *rest = labels
    chain = F.when(like(value, pattern), label)
    for pattern, label in rest:
        chain = chain.when(like(value, pattern), label)
    return chain


def trailing_digits(value: ColumnOrName) -> Column:
    """Digits the trimmed text ends with, '' if it does not end with one."""
    return F.regexp_extract(F.trim(_col(value)), "([0-9]+)$", 1)


def try_int(value: ColumnOrName) -> Column:
    """Integer value, NULL where the text is none or does not fit."""
    return _col(value).try_cast("int")


def account_number(value: ColumnOrName) -> Column:
    """Text account number as a join key, NULL where it is not a number."""
    return F.trim(_col(value)).try_cast("long")
