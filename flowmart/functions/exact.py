"""Exact rounding of ratios of whole numbers.

Dividing first and rounding afterwards can move a value off a tie; whole-number
arithmetic cannot, and does not depend on the order rows were added in.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_WIDE = "decimal(38,0)"


def round_ratio(num: Column, den: Column, places: int) -> Column:
    """`num / den` for num >= 0, half away from zero at `places`, as double.

    Null when `den` is zero or null.
    """
    scale = 10**places
    top = (num.cast("decimal(24,0)") * F.lit(2 * scale) + den).cast(_WIDE)
    bottom = F.nullif(den, F.lit(0)).cast("decimal(20,0)") * F.lit(2).cast("decimal(1,0)")
    return F.call_function("div", top, bottom.cast(_WIDE)).cast("double") / F.lit(float(scale))


def round_half_away(value: Column, places: int) -> Column:
    """Double rounded half away from zero on its decimal text, as double.

    Nine digits are kept first, which absorbs the noise of summation order.
    """
    return F.round(value.cast("decimal(28,9)"), places).cast("double")


def sample_sd(n: Column, total: Column, squares: Column) -> Column:
    """Sample deviation from count, sum and sum of squares of whole numbers.

    Null below two rows. The numerator is exact, so nothing cancels.
    """
    wide = [c.cast("decimal(19,0)") for c in (n, total, squares)]
    spread = wide[0] * wide[2] - wide[1] * wide[1]
    pairs = n.cast("double") * (n - 1).cast("double")
    return F.when(n > 1, F.sqrt(spread.cast("double") / pairs))
