"""Month arithmetic on the driver (report windows) and date columns in the plan."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def shift_months(day: dt.date, n: int) -> dt.date:
    """Same day `n` months on, or the last day of that month where it is shorter."""
    index = day.year * 12 + day.month - 1 + n
    year, month = divmod(index, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return dt.date(year, month + 1, min(day.day, last))


def first_of_month(day: dt.date, offset: int = 0) -> dt.date:
    return shift_months(day.replace(day=1), offset)


def month_window(as_of: dt.date, offset: int = 0) -> tuple[dt.date, dt.date]:
    """First day of the month `offset` months from `as_of`, and first day of the next one."""
    return first_of_month(as_of, offset), first_of_month(as_of, offset + 1)


def closed_months(as_of: dt.date, months: int) -> list[dt.date]:
    """First days of the last `months` complete months before `as_of`, oldest first."""
    return [first_of_month(as_of, -n) for n in range(months, 0, -1)]


def day_after(day: dt.date, n: int = 1) -> dt.date:
    return day + dt.timedelta(days=n)


def sunday_first_weekday(day: dt.date) -> int:
    """1 = Sunday .. 7 = Saturday, as `dayofweek` counts."""
    return day.isoweekday() % 7 + 1


def month_start(day: ColumnOrName) -> Column:
    return F.trunc(day, "month")


def month_end(day: ColumnOrName, offset: int = 0) -> Column:
    return F.last_day(F.add_months(F.to_date(day), offset))


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.datediff(end, start)


def month_name(day: ColumnOrName) -> Column:
    """Full English month name; Spark formats in English whatever the machine's locale."""
    return F.date_format(day, "MMMM")


def weekday(day: ColumnOrName) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(day)


def fmt_dmy(day: ColumnOrName) -> Column:
    return F.date_format(day, "dd/MM/yyyy")


def fmt_ym(day: ColumnOrName) -> Column:
    return F.date_format(day, "yyyy-MM")


def fmt_my(day: ColumnOrName) -> Column:
    return F.date_format(day, "MM-yy")


def week_of_month(day: ColumnOrName) -> Column:
    """1 for days 1-7, 2 for days 8-14, and so on."""
    return F.ceil(F.dayofmonth(day) / 7).cast("int")


def legacy_text_date(day: ColumnOrName) -> Column:
    """dd/MM/yyyy, and the text '0' for no date."""
    return F.coalesce(fmt_dmy(day), F.lit("0"))


def legacy_day_number(day: ColumnOrName) -> Column:
    """Days since 1900-01-01, and 0 for no date."""
    return F.coalesce(F.datediff(F.to_date(day), F.lit("1900-01-01").cast("date")), F.lit(0))
