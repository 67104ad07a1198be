"""Rounding, guarded arithmetic and banding, all as built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def absent(c: Column | str) -> Column:
    """True for null and for NaN (both mean "missing" in a measure)."""
    x = _col(c).cast("double")
    return x.isNull() | F.isnan(x)


def valid(c: Column | str) -> Column:
    """The measure as double with NaN turned into null."""
    x = _col(c).cast("double")
    return F.when(~F.isnan(x), x)


#: Where a double can be rounded as it is: up to so many places, below this scaled size (an
#: error of 2^-20 at most), and further than this from a tie (nine places move it by 5e-6).
_FAST_DIGITS, _FAST_BELOW, _NEAR_TIE = 4, float(1 << 33), 1e-4


def round_half_up(c: Column | str, digits: int = 2) -> Column:
    """SQL ``ROUND(numeric, n)``: ties go away from zero; NaN becomes null.

    A measure is rounded as the decimal of nine places it stands for, which takes off
    the noise of a double sum; one too large for that (from 1e29) has no such places.
    Adding zero turns -0 into 0. For decimals see :func:`round_exact`.

    A value that is neither large nor near a tie is rounded as a double, with the same
    result: the scaled value is then off by less than its distance from the tie, and the
    division of two whole numbers gives the double nearest to the decimal.
    """
    x = valid(c)
    exact = F.coalesce(F.round(x.try_cast("decimal(38,9)"), digits).cast("double"), x)
    if not 0 <= digits <= _FAST_DIGITS:
        return exact + 0.0
    scaled = F.abs(x) * float(10**digits)
    whole = F.floor(scaled + 0.5).cast("double")
    plain = (scaled < _FAST_BELOW) & (F.abs(scaled + 0.5 - F.rint(scaled + 0.5)) > _NEAR_TIE)
    return F.when(plain, F.signum(x) * whole / float(10**digits)).otherwise(exact) + 0.0


def round_exact(df: DataFrame, c: Column | str, source: str, digits: int = 2) -> Column:
    """``c``, an aggregate of the column ``source``, rounded half up: as a decimal if
    ``source`` is one, else as :func:`round_half_up`."""
    if isinstance(df.schema[source].dataType, DecimalType):
        return F.round(_col(c), digits)
    return round_half_up(c, digits)


def measure(df: DataFrame, c: str) -> Column:
    """The column for exact arithmetic: a decimal as it is, others as a valid double."""
    return F.col(c) if isinstance(df.schema[c].dataType, DecimalType) else valid(c)


def round_half_even(c: Column | str, digits: int = 2) -> Column:
    """Float rounding with ties to the even neighbour, on the scaled double."""
    scale = float(10**digits)
    return F.rint(_col(c) * scale) / scale


def per_unit(amount: Column | str, units: Column | str) -> Column:
    """``amount / units``; zero units give null instead of an ANSI error."""
    return _col(amount) / F.nullif(_col(units).cast("double"), F.lit(0.0))


def clamp(c: Column | str, low: float = 0.0, high: float = 1.0) -> Column:
    """Limit to [low, high]. Missing stays missing, unlike least/greatest,
    which skip nulls and rank NaN above every number."""
    x = valid(c)
    return F.when(x < low, F.lit(float(low))).when(x > high, F.lit(float(high))).otherwise(x)


def row_max_abs(cols: Sequence[Column | str]) -> Column:
    """Largest absolute value in a row; missing values are skipped."""
    sizes = [F.abs(valid(c)) for c in cols]
    return sizes[0] if len(sizes) == 1 else F.greatest(*sizes)


def in_range_or_false(c: Column | str, low: object, high: object) -> Column:
    """Inclusive range test that is false, never null, for a missing value."""
    return F.coalesce(_col(c).between(low, high), F.lit(False))


def band(c: Column | str, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label by the first limit the value lies strictly below.

    A null passes no limit and so lands in ``otherwise``, as in a searched CASE.
    """
    x = _col(c)
    (first, label), *rest = limits
    expr = F.when(x < first, F.lit(label))
    for limit, name in rest:
        expr = expr.when(x < limit, F.lit(name))
    return expr.otherwise(F.lit(otherwise))
