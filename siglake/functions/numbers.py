"""Numeric expressions: parsing, small sums, bins and simulation time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_FLOAT = rf"^\s*[+-]?(?:{_NUMBER}|(?i:inf|infinity))\s*$"
_INT = r"^\s*[+-]?[0-9]+\s*$"
_SUM = rf"^({_NUMBER})\s*(?:([+-])\s*({_NUMBER})\s*)?$"

DEFAULT_SIMTIME_EXPONENT = -12  # raw ticks are picoseconds unless the run says otherwise


def to_double(text: Column) -> Column:
    """A floating point number; NULL where the text is none (or is NaN)."""
    return F.when(text.rlike(_FLOAT), text.try_cast("double"))


def to_long(text: Column) -> Column:
    return F.when(text.rlike(_INT), F.trim(text).try_cast("bigint"))


def eval_sum(text: Column) -> Column:
    """Value of ``a``, ``a+b`` or ``a-b``; NULL for anything else, a leading sign included."""
    left = F.regexp_extract(text, _SUM, 1).try_cast("double")
    right = F.regexp_extract(text, _SUM, 3).try_cast("double")
    sign = F.regexp_extract(text, _SUM, 2)
    return (
        F.when(~text.rlike(_SUM), F.lit(None).cast("double"))
        .when(sign == "+", left + right)
        .when(sign == "-", left - right)
        .otherwise(left)
    )


def truncated_bin(column: Column, size: float) -> Column:
    """Lower bin edge, cut toward zero: -0.5 and 0.5 share a bin of size 1."""
    return (column / F.lit(size)).cast("bigint") * F.lit(size)


def time_bucket(ticks: Column, bucket: float = 1e11, scale: float = 10.0) -> Column:
    """Start of the tumbling bucket; by default 100 ms buckets of picoseconds, in seconds."""
    return (ticks / F.lit(bucket)).cast("bigint") / F.lit(scale)


def simtime_seconds(ticks: Column, exponent: Column | None = None) -> Column:
    exponent = F.lit(DEFAULT_SIMTIME_EXPONENT) if exponent is None else exponent
    return ticks * F.pow(F.lit(10.0), exponent)
