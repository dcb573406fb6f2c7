"""Numeric helpers: money out as double, exact rounding of ratios.

Money is summed as DECIMAL (exact, order independent) and turned into DOUBLE
only at the end. Rounded averages of whole numbers (day gaps, day counts) are
rounded exactly, half away from zero, with integer arithmetic — rounding a
double such as 1.005 is not reliable across engines.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_out(c: str | Column) -> Column:
    return _col(c).cast("double")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as DOUBLE; NULL when den is 0 or NULL."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def half_up_ratio(num: str | Column, den: str | Column, digits: int) -> Column:
    """round(num / den, digits) for integers num and den > 0, exactly.

    sign(num) * floor((2 * 10^d * |num| + den) / (2 * den)) / 10^d; NULL when
    den is NULL or not positive.
    """
    n = _col(num).cast("bigint")
    d = _col(den).cast("bigint")
    scale = 10 ** digits
    units = F.abs(n) * F.lit(2 * scale) + d
    two_d = d * F.lit(2)
    # (units - units mod 2d) is a multiple of 2d: the division below is exact
    q = F.try_divide(units - F.pmod(units, two_d), two_d).cast("bigint")
    signed = F.when(n < 0, -q).otherwise(q)
    return F.when(d > 0, signed.cast("double") / F.lit(float(scale)))


def money_sum(c: str | Column) -> Column:
    """Exact sum of a DOUBLE money column (values carry at most 4 decimals)."""
    return F.sum(_col(c).cast("decimal(38,4)")).cast("double")


def round_money(c: str | Column, digits: int = 2) -> Column:
    """Round a DOUBLE money value (at most 4 decimals) half-up, exactly."""
    return F.round(_col(c).cast("decimal(38,4)"), digits).cast("double")


def mean_of(c: str | Column) -> Column:
    """Mean of the non-NULL values (pandas ``mean``) as sum / count in DOUBLE."""
    return safe_ratio(F.sum(_col(c)), F.count(_col(c)))
