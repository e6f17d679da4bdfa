"""Math, random numbers, bits and numeric conversion."""

from __future__ import annotations

import re
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .core import as_column, as_value


def random(seed: int | None = None) -> Column:
    """Uniform 64-bit integers."""
    r = F.rand(seed) if seed is not None else F.rand()
    low = F.rand(seed + 1) if seed is not None else F.rand()
    return F.xxhash64(r, low)


def randn(seed: int | None = None) -> Column:
    """Standard normal deviates."""
    return F.randn(seed) if seed is not None else F.randn()


def bitnot(e: Any) -> Column:
    return F.bitwise_not(as_column(e))


def to_decimal(e: Any, precision: int, scale: int) -> Column:
    return as_column(e).cast(f"decimal({precision},{scale})")


def _number_type(fmt: str) -> str:
    """Digits are counted by the tokens 9 and 0; those after the point make the scale."""
    whole, _, part = re.sub("[dD]", ".", fmt).partition(".")
    s = len(re.findall("[90]", part))
    return f"decimal({builtin_max(1, len(re.findall('[90]', whole)) + s)},{s})"


builtin_max = max


def to_number(e: Any, fmt: str | None = None, precision: int | None = None, scale: int | None = None) -> Column:
    """By cast, or by a format of the tokens 9 0 . D , G $ S MI; a bad text is an error."""
    c = as_column(e)
    if fmt is not None:
        return F.to_number(c, F.lit(fmt)).cast(f"decimal({precision},{scale or 0})" if precision else _number_type(fmt))
    return c.cast(f"decimal({precision or 38},{scale or 0})")


def try_to_number(e: Any, fmt: str | None = None, precision: int | None = None, scale: int | None = None) -> Column:
    """Like to_number, with null for a bad text."""
    c = as_column(e)
    if fmt is not None:
        return F.try_to_number(c, F.lit(fmt)).try_cast(f"decimal({precision},{scale or 0})" if precision else _number_type(fmt))
    return F.round(c.try_cast("decimal(38,10)"), scale or 0).try_cast(f"decimal({precision or 38},{scale or 0})")


def div0(dividend: Any, divisor: Any) -> Column:
    """0 for a zero divisor."""
    a, b = as_column(dividend), as_column(divisor)
    return F.when(b == 0, F.lit(0)).otherwise(a / b)


def sqrt(e: Any) -> Column:
    return F.sqrt(as_column(e))


def abs(e: Any) -> Column:
    return F.abs(as_column(e))


def acos(e: Any) -> Column:
    return F.acos(as_column(e))


def asin(e: Any) -> Column:
    return F.asin(as_column(e))


def atan(e: Any) -> Column:
    return F.atan(as_column(e))


def atan2(y: Any, x: Any) -> Column:
    return F.atan2(as_column(y), as_column(x))


def ceil(e: Any) -> Column:
    return F.ceil(as_column(e))


def floor(e: Any) -> Column:
    return F.floor(as_column(e))


def cos(e: Any) -> Column:
    return F.cos(as_column(e))


def cosh(e: Any) -> Column:
    return F.cosh(as_column(e))


def exp(e: Any) -> Column:
    return F.exp(as_column(e))


def factorial(e: Any) -> Column:
    return F.factorial(as_column(e))


def log(base: Any, e: Any) -> Column:
    """Logarithm of e to a base, which comes first."""
    return F.ln(as_column(e)) / F.ln(as_column(base))


def log10(e: Any) -> Column:
    return F.log10(as_column(e))


def log1p(e: Any) -> Column:
    return F.log1p(as_column(e))


def pow(a: Any, b: Any) -> Column:
    return F.pow(as_column(a), as_column(b))


#: Scales that a column may give; beyond them a number keeps all its digits, or none.
_SCALES = range(-18, 19)


def _by_scale(c: Column, scale: Column, make) -> Column:
    """make(c, k) for the scale k of each row; only the row's own branch is evaluated."""
    out = F.when(scale.isNull(), F.lit(None))
    for k in _SCALES:
        out = out.when(scale == k, make(c, k))
    return out.when(scale > _SCALES[-1], c).otherwise(c * 0)


def round(e: Any, scale: Any = 0) -> Column:
    """Half away from zero, in the number's own type; a scale column may differ by row."""
    c = as_column(e)
    return F.round(c, scale) if isinstance(scale, int) else _by_scale(c, as_column(scale), F.round)


def _cut(c: Column, scale: int) -> Column:
    if scale <= 0:
        return c - c % F.lit(10**-scale)  # exact for whole numbers and decimals, and for doubles too
    # in decimals exact; of doubles the nearest one may lie just below a decimal that is whole after scaling
    up, down = (F.lit(Decimal(1).scaleb(k)) for k in (scale, -scale))
    scaled = F.round(F.abs(c) * up, 9)
    cut = F.round((scaled - scaled % F.lit(1)) * down, scale)
    # a number with no digit to cut is itself, also where scaling it would lose some
    return F.when(F.abs(c) >= F.lit(Decimal(10) ** 15), c - c % down).when(c < 0, -cut).otherwise(cut)


def trunc(e: Any, scale: Any = 0) -> Column:
    """Cuts digits off towards zero, in the number's own type; a scale column may differ by row."""
    c = as_column(e)
    return _cut(c, scale) if isinstance(scale, int) else _by_scale(c, as_column(scale), _cut)


def bitshiftleft(e: Any, bits: Any) -> Column:
    return F.call_function("shiftleft", as_column(e).cast("long"), as_value(bits).cast("int"))


def bitshiftright(e: Any, bits: Any) -> Column:
    return F.call_function("shiftright", as_column(e).cast("long"), as_value(bits).cast("int"))


shiftleft, shiftright = bitshiftleft, bitshiftright


def sin(e: Any) -> Column:
    return F.sin(as_column(e))


def sinh(e: Any) -> Column:
    return F.sinh(as_column(e))


def tan(e: Any) -> Column:
    return F.tan(as_column(e))


def tanh(e: Any) -> Column:
    return F.tanh(as_column(e))


def degrees(e: Any) -> Column:
    return F.degrees(as_column(e))


def radians(e: Any) -> Column:
    return F.radians(as_column(e))


def sign(e: Any) -> Column:
    return F.signum(as_column(e))


signum = sign


def _sequence(bits: int, from_zero: bool) -> Column:
    """0, 1, 2, ... in `bits` bits. It numbers all rows, so it orders them in one partition; over large data use
    monotonically_increasing_id of Spark, which leaves gaps."""
    n = F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("long") - 1
    if bits == 64:
        return n
    n = F.pmod(n, F.lit(2**bits))
    return n if from_zero else F.when(n >= 2 ** (bits - 1), n - 2**bits).otherwise(n)


def seq1(starts_from_zero: bool = True) -> Column:
    return _sequence(8, starts_from_zero)


def seq2(starts_from_zero: bool = True) -> Column:
    return _sequence(16, starts_from_zero)


def seq4(starts_from_zero: bool = True) -> Column:
    return _sequence(32, starts_from_zero)


def seq8(starts_from_zero: bool = True) -> Column:
    return _sequence(64, starts_from_zero)


def monotonically_increasing_id() -> Column:
    """0, 1, 2, ... without gaps (see seq8)."""
    return _sequence(64, True)


def uniform(low: Any, high: Any, gen: Any = None) -> Column:
    """Uniform numbers in [low, high]: integers for integer bounds, else doubles. `gen` is a column of random()."""
    r = F.rand() if gen is None else F.pmod(F.xxhash64(as_value(gen)), F.lit(2**53)) / F.lit(float(2**53))
    whole = isinstance(low, int) and isinstance(high, int)
    a, b = as_value(low), as_value(high)
    return (F.floor(r * (b - a + 1)) + a).cast("long") if whole else r * (b - a) + a


def format_number(e: Any, d: int) -> Column:
    """Grouped by thousands with d decimals. A negative d gives null; so many digits before the point that the format has no place
    for them (more than six) give number signs."""
    if d < 0:
        return F.lit(None).cast("string")
    c, point = as_column(e), "." if d else ""
    rounded = F.round(c.cast("decimal(38,18)"), d)
    fits = F.abs(rounded) < 1_000_000
    shown = F.trim(F.to_char(F.when(fits, rounded).cast(f"decimal({6 + d},{d})"), F.lit("999,990" + point + "0" * d)))
    return F.when(fits, shown).when(c.isNotNull(), F.lit("###,###" + point + "#" * d))
