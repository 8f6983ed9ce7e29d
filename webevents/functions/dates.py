"""O9 and date helpers: event dates are 'YYYYMMDD' strings, weeks start on Monday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_day(c: str | Column = "event_date") -> Column:
    """PARSE_DATE('%Y%m%d', c). Malformed text raises (ANSI), as in the source.

    Of a column given by name, eight digits are taken apart as a number, which costs a fraction of the formatter;
    a day that the calendar lacks raises there too. Whatever else there is goes to the formatter."""
    if isinstance(c, str):  # one expression is built faster than its parts
        text = c if "`" in c else ".".join(f"`{part}`" for part in c.split("."))
        n = f"try_cast({text} AS INT)"
        return F.expr(  # a number in this range of eight characters has no sign and no space
            # no BETWEEN: it becomes a projection of its own, below which nested columns are read whole
            f"IF(length({text}) = 8 AND {n} >= 10000101 AND {n} <= 99991231, "
            f"make_date(CAST({n} DIV 10000 AS INT), CAST({n} DIV 100 % 100 AS INT), {n} % 100), to_date({text}, 'yyyyMMdd'))"
        )
    return F.to_date(c, "yyyyMMdd")


def week_of(d: str | Column) -> Column:
    """DATE_TRUNC(d, WEEK(MONDAY)) as a DATE."""
    return F.trunc(_c(d), "week")


def weeks_between(later: str | Column, earlier: str | Column) -> Column:
    """DATE_DIFF(later, earlier, WEEK): the number of Sunday-started week boundaries
    crossed. Computed on the Sunday on or before each date, so it is exact for any
    dates and equals days / 7 for two Mondays."""
    def sunday(d: Column) -> Column:
        return F.date_sub(d, F.dayofweek(d) - 1)

    return (F.datediff(sunday(_c(later)), sunday(_c(earlier))) / 7).cast("long")


def days_between(later: str | Column, earlier: str | Column) -> Column:
    """DATE_DIFF(later, earlier, DAY)."""
    return F.datediff(_c(later), _c(earlier))
