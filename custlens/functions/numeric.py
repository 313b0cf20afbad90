"""Scalar helpers over numbers: money sums, value buckets, recodes, safe math."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(col) -> Column:
    """Spark treats NaN as a value (it sorts highest and poisons max/avg); the
    engine's null model is SQL NULL, so NaN becomes NULL at ingest."""
    c = _c(col).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def money_sum(col, scale: int | None = 2) -> Column:
    """Sum of a money column of ``scale`` decimals.  Amounts are summed as whole
    numbers of the smallest unit, so the sum is exact and does not depend on the
    order of the rows.  What an amount has beyond ``scale`` decimals is summed apart,
    as doubles, and not lost; ``None`` sums the doubles as they are."""
    if scale is None:
        return F.sum(_c(col))
    unit = F.lit(10.0 ** scale)
    whole = F.round(_c(col) * unit)
    return F.sum(whole.cast("bigint")) / unit + F.sum(_c(col) - whole / unit)


def log_bucket(col, per_octave: int = 256) -> Column:
    """Monotone non-decreasing integer bucket of a double: about ``per_octave``
    buckets per doubling of ``|x|``, negatives below zero below positives.
    Used to split one group's value range into many independent pieces."""
    x = _c(col)
    b = F.floor(F.log2(F.abs(x) + F.lit(1.0)) * F.lit(float(per_octave)))
    return F.when(x >= 0, b + 1).otherwise(-b)


def recode(col, mapping: dict, default=None) -> Column:
    """Map values through ``mapping``; anything else becomes ``default`` (NULL)."""
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def row_sum(cols, null_as_zero: bool = True) -> Column:
    """Row-wise sum of numeric columns, nulls and NaN counted as 0 (pandas ``sum(axis=1)``)."""
    parts = [F.coalesce(nan_to_null(c), F.lit(0.0)) if null_as_zero else _c(c).cast("double")
             for c in cols]
    return reduce(lambda a, b: a + b, parts)
