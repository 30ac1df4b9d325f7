"""Money in whole cents and rates in millionths, so every product and quotient is exact before it is cut.

All amounts inside the engine are bigint cents. A rate of 4.5 % is 45000 millionths. ``cut`` truncates
toward zero as the settlement rules ask; ``half_up`` rounds a half away from zero. Products go through
DECIMAL(38,0), so sums over very many orders don't overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1_000_000


def _wide(x: Column | str | int) -> Column:
    return (F.lit(x) if isinstance(x, int) else F.col(x) if isinstance(x, str) else x).cast("decimal(38,0)")


def cut(a: Column | str, b: Column | str | int, c: Column | str | int) -> Column:
    """a * b / c in whole units, toward zero; null where c is 0."""
    product, by = (_wide(a) * _wide(b)).cast("decimal(38,0)"), F.nullif(_wide(c), _wide(0))
    return ((product - product % by) / by).cast("decimal(38,0)").cast("long")


def half_up(a: Column | str, b: Column | str | int, c: int) -> Column:
    """a * b / c for amounts of at least 0, a half going up."""
    product = (_wide(a) * _wide(b)).cast("decimal(38,0)") + F.lit(c // 2).cast("decimal(38,0)")
    return ((product - product % _wide(c)) / _wide(c)).cast("decimal(38,0)").cast("long")


def of_rate(amount: Column | str, micro: Column | str | int) -> Column:
    """The cents that a rate takes of an amount in cents, toward zero."""
    return cut(amount, micro, MICRO)


def of_rate_of(amount: int, micro: int) -> int:
    """of_rate() of two numbers."""
    taken = abs(amount * micro) // MICRO
    return taken if amount * micro >= 0 else -taken


def or_zero(x: Column | str) -> Column:
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(0))


def to_cents(amount: Column) -> Column:
    """Cents of an amount with two decimals, from any numeric type."""
    return F.round(amount * 100).cast("long")


def to_decimal(cents: Column | str, scale: int = 2) -> Column:
    """DECIMAL(18, scale) of a whole number of its smallest units."""
    x = F.col(cents) if isinstance(cents, str) else cents
    return (x.cast("decimal(18,0)") * F.lit(f"{10 ** -scale:.{scale}f}").cast(f"decimal({scale + 1},{scale})")).cast(f"decimal(18,{scale})")


def truncated(x: Column, digits: int) -> Column:
    """A decimal cut to so many digits toward zero."""
    return F.when(x >= 0, F.floor(x, F.lit(digits))).otherwise(F.ceil(x, F.lit(digits)))


def previous_period(period: Column, kind: str) -> Column:
    """The period before: one less, or for YYYYMM the month before (January goes to December)."""
    if kind == "sequence":
        return period - 1
    if kind == "yyyymm":
        return F.when(period % 100 == 1, period - 89).otherwise(period - 1)
    raise ValueError(f"unknown kind of period: {kind}")


def ordinal_id(stamp: str, order: Column, width: int = 8) -> Column:
    """An id of a time stamp and a padded ordinal."""
    return F.concat(F.lit(stamp), F.lpad(order.cast("string"), width, "0"))


def unscaled_decimal(base64: Column, scale: int) -> Column:
    """The decimal that a change stream sends as base64 of its two's-complement bytes, of any number; null where it is empty or has more than 38 digits.

    The last 16 bytes are read as two limbs; bytes before them may only repeat the sign.
    """
    digits = F.hex(F.unbase64(base64))
    sign = F.when(F.substring(digits, 1, 1) >= "8", "F").otherwise("0")
    wide = F.lpad(digits, F.greatest(F.length(digits), F.lit(32)), sign)
    beyond = F.length(wide) - 32
    whole = (F.substring(wide, F.lit(1), beyond) == F.repeat(sign, beyond)) & ((F.substring(wide, beyond + 1, F.lit(1)) >= "8") == (sign == "F"))
    limb = lambda k, base: F.conv(F.substring(wide, beyond + 1 + 16 * k, F.lit(16)), 16, base).cast("decimal(20,0)")
    high, low = limb(0, -10), limb(1, 10)
    # high * 2**64 + low; below 0 as (high + 1) * 2**64 - (2**64 - low), so that no term is longer than the result.
    wide_low = low.cast("decimal(38,0)")
    low = F.when(high < 0, wide_low - F.lit(str(2**64)).cast("decimal(38,0)")).otherwise(wide_low).cast("decimal(38,0)")
    high = F.when(high < 0, high + 1).otherwise(high).cast("decimal(20,0)")
    top, rest = divmod(10**38 - 1, 2**64)
    fits = (F.abs(high) < top) | ((F.abs(high) == top) & (F.abs(low) <= F.lit(str(rest)).cast("decimal(38,0)")))
    half = F.lit(2**32).cast("decimal(10,0)")
    value = (F.when(fits, high).cast("decimal(19,0)") * half).cast("decimal(29,0)")
    value = ((value * half).cast("decimal(38,0)") + low).cast("decimal(38,0)")
    value = F.when(whole & fits & (F.length(digits) > 0), value)
    return value if scale == 0 else _scaled(value, scale)


def _scaled(value: Column, scale: int) -> Column:
    """A whole DECIMAL(38,0) with its point moved: exact, by text."""
    text = F.replace(value.cast("string"), F.lit("-"), F.lit(""))  # abs() keeps 34 digits
    text = F.lpad(text, F.greatest(F.length(text), F.lit(scale + 1)), "0")
    moved = F.concat(F.when(value < 0, "-").otherwise(""), F.substring(text, F.lit(1), F.length(text) - scale), F.lit("."), F.substring(text, F.length(text) - scale + 1, F.lit(scale)))
    return F.when(value.isNotNull(), moved).cast(f"decimal(38,{scale})")
