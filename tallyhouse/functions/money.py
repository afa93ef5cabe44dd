"""Exact decimal money arithmetic (never DOUBLE)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference rate for Canadian dollars; every other currency
# passes at 1.0.
CAD_TO_USD = Decimal("0.73")
DEFAULT_RATE = Decimal("1.0")


# Sums over any number of rows; a total in decimal(14,2) overflows at 10**12.
TOTAL = "decimal(38,2)"
# Dividends and divisors of ratios: wide, and the quotient keeps 14 digits.
RATIO = "decimal(24,2)"


def total(c: Column | str) -> Column:
    """Cast a sum of money to :data:`TOTAL`."""
    return (F.col(c) if isinstance(c, str) else c).cast(TOTAL)


def money(c: Column | str, precision: int = 14, scale: int = 2) -> Column:
    """Cast to ``decimal(precision, scale)``."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(f"decimal({precision},{scale})")


def round_money(c: Column, scale: int = 2, precision: int = 14) -> Column:
    """Decimal round (half away from zero) then a fixed-width cast."""
    return F.round(c, scale).cast(f"decimal({precision},{scale})")


def fx_to_usd(currency: Column, rates: dict[str, Decimal] | None = None) -> Column:
    """Conversion factor to USD as an exact decimal literal."""
    rates = rates or {"CAD": CAD_TO_USD}
    expr = None
    for code, rate in rates.items():
        cond = currency == F.lit(code)
        expr = F.when(cond, F.lit(rate)) if expr is None else expr.when(cond, F.lit(rate))
    return expr.otherwise(F.lit(DEFAULT_RATE))
