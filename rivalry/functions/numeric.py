"""Money and ratio expressions.

Money is carried as DECIMAL end to end so sums are exact and do not depend
on the order partial aggregates are merged in.  Outputs are rounded to
``MONEY_SCALE`` decimals and then cast to DOUBLE (the output tables' type).
Ratios divide two doubles (exact sums, not rounded ones) with ``try_divide``,
so that a zero denominator yields NULL instead of an ANSI error; ratios of
money are rounded to ``RATIO_SCALE`` decimals at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SCALE = 4
RATIO_SCALE = 6
# Order-line amounts, and sums of them (SKU GMV), exact with four decimals.
AMOUNT_TYPE = "decimal(18,4)"
GMV_TYPE = "decimal(22,4)"


def money_out(col) -> Column:
    """Exact decimal → DOUBLE after rounding to ``MONEY_SCALE`` decimals."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col, MONEY_SCALE).cast("double")


def ratio(num, den) -> Column:
    """``num / den`` in double precision, NULL when ``den`` is 0 or NULL."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


def money_ratio(num, den) -> Column:
    """``num / den`` of exact sums, rounded to ``RATIO_SCALE`` decimals."""
    return F.round(ratio(num, den), RATIO_SCALE)
