"""Output normalisation for registered queries.

Integral columns are widened to ``bigint`` and the listed double columns are
rounded to 4 decimals (sample std and interpolated medians differ between
engines in the last bits); every other double is computed exactly the same
way in Spark and in the oracle SQL, so it is left as is.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, ShortType

ROUND_DIGITS = 4


def needs_rounding(name: str) -> bool:
    return "_std" in name or "median" in name or name.startswith("std_") or "crossentroy" in name


def tidy(df: DataFrame, round_cols: Iterable[str] | None = None) -> DataFrame:
    to_round = set(round_cols) if round_cols is not None else {
        f.name for f in df.schema.fields if needs_rounding(f.name)}
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ByteType, ShortType, IntegerType)):
            c = c.cast("bigint")
        elif f.name in to_round:
            c = F.round(c, ROUND_DIGITS)
        cols.append(c.alias(f.name))
    return df.select(*cols)
