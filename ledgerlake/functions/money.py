"""Money arithmetic with exact decimals.

Policy (see README "Numeric semantics"):

* money is stored as DECIMAL(34,15);
* before a product, the amount is narrowed to DECIMAL(20,8) and the rate to
  DECIMAL(17,7): the product is then an exact DECIMAL(38,15) in Spark (no
  precision-loss rounding to 6 digits) and is cast back to DECIMAL(34,15);
* ratios (unit values, averages, per-unit splits) are computed as DOUBLE from
  exact decimal numerator and denominator with a NULL/zero guard, which is
  correctly rounded in every IEEE engine.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(34, 15)
WIDE_MONEY = DecimalType(38, 15)
AMOUNT = DecimalType(20, 8)
RATE = DecimalType(17, 7)


def zero() -> Column:
    return F.lit(0).cast(MONEY)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    return _c(x).cast(MONEY)


def z(x) -> Column:
    """``COALESCE(CAST(x AS DECIMAL(34,15)), 0)`` — NULL counts as zero."""
    return F.coalesce(_c(x).cast(MONEY), zero())


def mul(amount, rate) -> Column:
    """Exact product of an amount and a rate, as DECIMAL(34,15)."""
    return (_c(amount).cast(AMOUNT) * _c(rate).cast(RATE)).cast(MONEY)


def signed_sum(plus: Sequence = (), minus: Sequence = ()) -> Column:
    """``Σ z(plus) − Σ z(minus)`` as DECIMAL(34,15)."""
    expr = None
    for x in plus:
        expr = z(x) if expr is None else expr + z(x)
    for x in minus:
        expr = (zero() - z(x)) if expr is None else expr - z(x)
    return (expr if expr is not None else zero()).cast(MONEY)


def ratio(num, den) -> Column:
    """num / den as DOUBLE; NULL when den is NULL or 0."""
    d = _c(den).cast("double")
    return F.when(d != 0, _c(num).cast("double") / d)


def ratio_or_zero(num, den) -> Column:
    """F10 variant: 0 when the denominator is 0 or NULL (per-unit splits)."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def fx_divide(amount, rate) -> Column:
    """Amount ÷ FX rate; a zero or missing rate yields NULL."""
    return ratio(amount, rate)


def negate_round(x, digits: int = 15) -> Column:
    """sign inversion and rounding to ``digits`` decimals."""
    return F.round(-_c(x).cast(MONEY), digits).cast(MONEY)


def guard_negative(qty, value) -> Column:
    """C11: ``CASE WHEN qty < 0 THEN 0 ELSE value END``."""
    return F.when(_c(qty) < 0, zero()).otherwise(_c(value).cast(MONEY))


def null_guarded_diff(a, b) -> Column:
    """A − b only when both are present."""
    return F.when(_c(a).isNotNull() & _c(b).isNotNull(), (_c(a).cast(MONEY) - _c(b).cast(MONEY)).cast(MONEY))


def fixed6(x) -> Column:
    """A DOUBLE amount as DECIMAL(38,6), halves rounded toward +inf.

    The rounding is done with IEEE operations (``floor(x*1e6 + 0.5) / 1e6``)
    that every engine evaluates identically; the result is then an exact
    6-decimal value, so the final cast cannot round differently anywhere."""
    return (F.floor(_c(x).cast("double") * 1000000.0 + 0.5) / 1000000.0).cast("decimal(38,6)")


def gated(condition: Column, value) -> Column:
    """Value where ``condition`` holds, NULL elsewhere."""
    return F.when(condition, _c(value))


def waterfall(mode_col, orders: Mapping[str, Iterable[str]], default: Iterable[str] | None = None) -> Column:
    """Per mode, a different ordered COALESCE over candidate columns."""
    expr = None
    for mode, cands in orders.items():
        branch = F.coalesce(*[_c(c) for c in cands])
        expr = F.when(_c(mode_col) == mode, branch) if expr is None else expr.when(_c(mode_col) == mode, branch)
    if default is not None:
        expr = expr.otherwise(F.coalesce(*[_c(c) for c in default]))
    return expr
