"""Rates and money.

Three division guards appear in the source and are kept distinct:
``pct`` is a bare ``/`` (raises on a zero denominator under ANSI, like the source),
``pct_nullif`` is ``/ NULLIF(d, 0)`` and ``safe_pct`` / ``safe_ratio`` are
``SAFE_DIVIDE`` (NULL on zero). Integer counts divide as doubles.

Money is a FLOAT64 in the source and its total is one: no value is cut, and NaN, Infinity
and very large values behave as doubles do. ``money_sum`` doesn't depend on the order of
summation: values are split at fixed exponents into integers, whose sums are exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct(n: str | Column, d: str | Column, digits: int) -> Column:
    """ROUND(n / d * 100, digits) -- bare division."""
    return F.round(_c(n) / _c(d) * 100, digits)


def pct_nullif(n: str | Column, d: str | Column, digits: int) -> Column:
    """ROUND(n / NULLIF(d, 0) * 100, digits)."""
    return F.round(_c(n) / F.nullif(_c(d), F.lit(0)) * 100, digits)


def safe_pct(n: str | Column, d: str | Column, digits: int) -> Column:
    """ROUND(SAFE_DIVIDE(n, d) * 100, digits)."""
    return F.round(F.try_divide(_c(n), _c(d)) * 100, digits)


def safe_ratio(n: str | Column, d: str | Column, digits: int) -> Column:
    """ROUND(SAFE_DIVIDE(n, d), digits)."""
    return F.round(F.try_divide(_c(n), _c(d)), digits)


#: Exponents at which a value is cut into digits of 24 bits, the highest first.
DIGITS = (36, 12, -12, -36, -60, -84)


def money_sum(c: str) -> Column:
    """SUM of a money column (NULL when all inputs are NULL), the same bits for any order and partitioning.

    A value below 2**62 is rounded to multiples of 2**e for each e of ``DIGITS``, by adding and subtracting a number
    whose last bit stands for 2**e; the differences of neighbouring roundings are whole numbers of at most 26 bits,
    so their sums are exact as longs for 2**36 rows and more. The total joins the sums, the smallest first. What lies
    outside (NaN, Infinity, values from 2**62 on, bits below 2**-85) is added as doubles are.
    """
    if isinstance(c, Column):
        raise TypeError("money_sum takes a column's name; select an expression under a name first")
    x = f"CAST({_quoted(c)} AS DOUBLE)"
    inside = f"abs({x}) < {float(2**62)!r}D"  # false for NaN and Infinity

    def rounded(e: int) -> str:
        last_bit = 1.5 * 2.0 ** (52 + e)
        # from 2**(51 + e) on the value is a multiple of 2**(e - 1) as it is
        return f"IF(abs({x}) < {2.0 ** (51 + e)!r}D, {x} + {last_bit!r}D - {last_bit!r}D, {x})"

    tail = f"CASE WHEN NOT ({inside}) THEN {x} WHEN abs({x}) < {2.0**-32!r}D THEN {x} - {rounded(DIGITS[-1])} END"
    total = f"coalesce(sum({tail}), 0D)"
    for e, above in reversed(list(zip(DIGITS, (None, *DIGITS)))):
        unit = 2.0 ** (e - 1)
        part = rounded(e) if above is None else f"({rounded(e)} - {rounded(above)})"
        digit = f"WHEN {inside} THEN CAST({part} / {unit!r}D AS BIGINT)"
        if above is None:  # not NULL for any value, so the total is NULL without one only
            total += f" + sum(CASE {digit} WHEN {x} IS NOT NULL THEN 0L END) * {unit!r}D"
        else:
            total += f" + coalesce(sum(CASE {digit} END) * {unit!r}D, 0D)"
    return F.expr(total)  # one expression: built part by part it would cost more time than a small query


def _quoted(name: str) -> str:
    return name if "`" in name else ".".join(f"`{part}`" for part in name.split("."))


def money(c: str | Column, digits: int = 2) -> Column:
    """A money value rounded to cents."""
    return F.round(_c(c), digits)


def rounded_money_sum(c: str, digits: int = 2) -> Column:
    """ROUND(SUM(c), digits) for money."""
    return money(money_sum(c), digits)
