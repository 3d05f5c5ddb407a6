"""Column expressions shared by the operators.

Money stays in exact decimals end to end.  Ratios divide decimals (never
doubles) and are cast once at the end, so the result is the exact quotient
rounded half-up, which is also how the oracle computes it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as V

# Result types.  The reference casts money to decimal(10,2) / (5,2) / (6,2),
# which overflows on realistic totals; results are widened to (20,2) with the
# same 2-decimal rounding.  Unrounded money sums keep 4 decimals.
MONEY = "decimal(20,2)"
MONEY_1DP = "decimal(20,1)"
RAW_MONEY = "decimal(38,4)"
AVG_4DP = "decimal(20,4)"

# Spark sizes a decimal quotient's integer part as (numerator integer digits
# + denominator scale) and gives the rest of 38 digits to the fraction; the
# numerator is cast to leave 12 fractional digits before the final rounding.
_QUOTIENT_INT_DIGITS = 26


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(value: str) -> Column:
    """An exact decimal literal (``F.lit(0.8)`` would be a double)."""
    return F.lit(Decimal(value))


def money(c: Column | str) -> Column:
    return col(c).cast(MONEY)


def raw_money(c: Column | str) -> Column:
    return col(c).cast(RAW_MONEY)


def ratio(num: Column, den: Column, result_type: str = MONEY,
          num_scale: int = 4, den_scale: int = 4) -> Column:
    """``num / den`` rounded half-up to ``result_type``; NULL when den is 0.

    Operands are cast to decimals of ``num_scale`` / ``den_scale`` fractional
    digits (integers and money fit exactly); the numerator keeps at least 16
    integer digits, so the quotient carries 12 exact digits before the cast.
    Operands of more than 8 decimals, which would leave the numerator too few
    integer digits, are divided as whole numbers instead (sums up to 1e23).
    """
    if den_scale > 8:
        scale = int(result_type.rstrip(")").split(",")[1])
        up = F.lit(Decimal(10) ** max(num_scale, den_scale))
        n, d = ((c * up).cast("decimal(38,0)") for c in (num, den))
        size, unit = F.abs(d), F.lit(Decimal(1).scaleb(-scale))
        halves = F.abs(n) * F.lit(Decimal(2 * 10 ** scale)) + size
        whole = F.call_function("div", halves, F.nullif(size * F.lit(Decimal(2)), F.lit(0)))
        return (F.signum(n).cast("int") * F.signum(d).cast("int") * whole * unit).cast(result_type)
    n_int = max(16, _QUOTIENT_INT_DIGITS - den_scale)
    n = num.cast(f"decimal({n_int + num_scale},{num_scale})")
    d = den.cast(f"decimal({22 + den_scale},{den_scale})")
    return (n / F.nullif(d, F.lit(0))).cast(result_type)


def pct(num: Column, den: Column, result_type: str = MONEY,
        num_scale: int = 4, den_scale: int = 4) -> Column:
    """``num * 100 / den`` (a percentage) like ``ratio``."""
    return ratio(num * F.lit(100), den, result_type, num_scale, den_scale)


def month_start(ts: Column | str) -> Column:
    """DATEFROMPARTS(YEAR(d), MONTH(d), 1) as a DATE."""
    return F.trunc(col(ts).cast("date"), "month")


def segment(store_id: Column | str = "StoreID", person_id: Column | str = "PersonID") -> Column:
    """Store if StoreID is set, else Individual if PersonID is set, else Unknown."""
    return (F.when(col(store_id).isNotNull(), F.lit(V.SEGMENT_STORE))
            .when(col(person_id).isNotNull(), F.lit(V.SEGMENT_INDIVIDUAL))
            .otherwise(F.lit(V.SEGMENT_UNKNOWN)))


def timestamp_ntz(value) -> Column:
    """A date / datetime parameter as a TIMESTAMP_NTZ literal (no zone shift)."""
    return F.lit(str(value)).cast("timestamp_ntz")
