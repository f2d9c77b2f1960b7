"""Small numeric and conditional columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b, NULL where b is 0."""
    return _col(a) / F.nullif(_col(b), F.lit(0))


def ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b as a double, NULL where b is 0. Exact sums go in; one division rounds once, where a
    quotient of wide decimals would keep only six digits."""
    return _col(a).cast("double") / F.nullif(_col(b).cast("double"), F.lit(0.0))


def divide(a: ColumnOrName, b: ColumnOrName, alternate: float | int | None = None) -> Column:
    """a / b, and `alternate` where b is 0 or NULL."""
    return F.coalesce(F.try_divide(_col(a), _col(b)), F.lit(alternate))


def percent(part: ColumnOrName, whole: ColumnOrName) -> Column:
    return safe_div(F.lit(100) * _col(part), whole)


def clamp0(value: ColumnOrName) -> Column:
    """Negative and missing amounts become 0."""
    return F.greatest(F.coalesce(_col(value), F.lit(0)), F.lit(0))


def sum_if(condition: Column, value: ColumnOrName) -> Column:
    """Sum of `value` where the condition holds, 0 where it never does."""
    return F.coalesce(F.sum(F.when(condition, _col(value))), F.lit(0))


def any_flag(condition: Column) -> Column:
    """1 if any row of the group meets the condition, else 0."""
    return F.max(F.when(condition, 1).otherwise(0))


def signed(amount: ColumnOrName, side: ColumnOrName) -> Column:
    """Debit (`D`) amounts as they are, any other side negated."""
    return _col(amount) * F.when(_col(side) == "D", 1).otherwise(-1)


def valid_at(start: ColumnOrName, end: ColumnOrName, cut: Column) -> Column:
    """Open strictly before the cut and not ended at or before it."""
    return (_col(start) < cut) & (_col(end).isNull() | (_col(end) > cut))


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def quote(name: str) -> str:
    """A generated column name as an identifier."""
    return "`" + name.replace("`", "``") + "`"


def try_decimal(value: Column, precision: int, scale: int) -> Column:
    """Rounded to the decimal type, NULL where it does not fit."""
    return value.try_cast(f"decimal({precision},{scale})")
