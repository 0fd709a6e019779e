"""Numeric helpers (H8-H20) and the partition-independent uniform draw (8.10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den, default=None) -> Column:
    """``num / den`` where ``den != 0``, else ``default`` (NULL by default).

    ANSI mode throws on division by zero, so the guard is mandatory.
    """
    num, den = _col(num), _col(den)
    dflt = default if isinstance(default, Column) else F.lit(default)
    return F.when(den != 0, num / den).otherwise(dflt)


def nan_to_null(c) -> Column:
    """NaN is the reference's missing value; Spark keeps it distinct from NULL."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def floor_long(c) -> Column:
    """Floor as a long; NULL stays NULL (``floor(NaN)`` would be 0)."""
    c = nan_to_null(c)
    return F.floor(c).cast("long")


def clip_lower(c, lo=0) -> Column:
    """``max(c, lo)``."""
    return F.greatest(_col(c), F.lit(lo))


def half_even(c, scale: int) -> Column:
    """Python ``round`` (half-even) = Spark ``bround``."""
    return F.bround(_col(c), scale)


def md5_uniform(seed, *keys) -> Column:
    """Uniform [0, 1) from ``md5(seed-key...)``.

    Deterministic per key, independent of partitioning and retries, and
    reproducible in SQL engines with ``md5``.
    """
    parts = [F.lit(str(seed))] + [_col(k).cast("string") for k in keys]
    hexed = F.substring(F.md5(F.concat_ws("-", *parts)), 1, 8)
    return F.conv(hexed, 16, 10).cast("double") / F.lit(4294967296.0)
