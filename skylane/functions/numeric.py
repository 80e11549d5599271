"""Numeric casts and rounding with the reference's (DuckDB) semantics.

Spark truncates on decimal/double -> int casts and rounds doubles through their
shortest decimal text; the reference rounds to nearest.  These helpers make the
rounding explicit so results do not depend on the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType


def round_half_away(c: Column, digits: int) -> Column:
    """Round a double to ``digits`` places, half away from zero on the binary value.

    ``1.005 -> 1.0`` and ``0.285 -> 0.28`` (their binary values lie below the
    tie), ``-0.125 -> -0.13``.  Result is a double.
    """
    scale = float(10 ** digits)
    x = c.cast("double")
    return F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def to_decimal(c: Column, source_type: DataType, precision: int = 18, scale: int = 3) -> Column:
    """Cast to ``decimal(precision, scale)`` rounding like the reference.

    A double is rounded half away from zero on its binary value times
    10^scale (0.5005 -> 0.500, whose binary value lies below the tie;
    0.0005 -> 0.001); Spark's own cast rounds the shortest decimal text
    instead.  Other types are cast directly.
    """
    target = f"decimal({precision},{scale})"
    if isinstance(source_type, (DoubleType, FloatType)):
        return round_half_away(c, scale).cast(target)
    return c.cast(target)


def to_int_nearest(c: Column, source_type: DataType) -> Column:
    """Cast to int rounding to nearest like the reference.

    decimal: half away from zero (2.5 -> 3); double/float: half to even
    (2.5 -> 2, 3.5 -> 4); integral types: plain cast.
    """
    if isinstance(source_type, DecimalType):
        return F.round(c, 0).cast("int")
    if isinstance(source_type, (DoubleType, FloatType)):
        return F.rint(c).cast("int")
    return c.cast("int")
