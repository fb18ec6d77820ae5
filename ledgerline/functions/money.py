"""Exact decimal arithmetic for fees and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: tax on the merchant fee.
TAX_ON_FEE = "0.18"

_WHOLE = "decimal(19,0)"


def ratio(part: Column, whole: Column, digits: int, scale: int = 1) -> Column:
    """``scale * part / whole`` rounded half away from zero; NULL when whole is 0.

    Both sides are whole numbers. The quotient carries 19 decimals, far more than
    the rounding needs, so no tie is decided by representation error.
    """
    top = (F.lit(scale) * part).cast(_WHOLE)
    bottom = F.nullif(whole.cast(_WHOLE), F.lit(0).cast(_WHOLE))
    return F.round(top / bottom, digits).cast(f"decimal(18,{digits})")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return ratio(part, whole, digits, scale=100)


def fee_split(gross: Column, rate: Column) -> tuple[Column, Column, Column]:
    """Merchant fee, tax on that fee, and what is left of the gross amount."""
    fee = F.round(gross * rate, 2).cast("decimal(12,2)")
    tax = F.round(fee * F.lit(TAX_ON_FEE).cast("decimal(3,2)"), 2).cast("decimal(12,2)")
    return fee, tax, (gross - fee - tax).cast("decimal(12,2)")
