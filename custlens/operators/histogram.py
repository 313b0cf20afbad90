"""Distinct count, mode and mode frequency from one two-level count.

The reference calls a Python function per group for the mode and its
frequency.  Here every requested column is unpivoted to ``(key, column,
value)`` and counted; a second aggregate straight to one row per key then gives,
per column, with conditional aggregates:

* ``nunique`` = number of distinct non-null values (NULL if none),
* ``mode``    = most frequent value, smallest on ties (``min`` of the struct
  ``(-count, value)``),
* ``freq``    = count of the mode (rows equal to the mode),
* ``minfreq`` = smallest count of any present value.

Whole numbers, decimals (one field per decimal type), other numbers and text are
carried in separate struct fields, so that whole numbers and decimals keep all their
digits and ties break numerically for numbers and lexicographically for text.

The rows meet by key before they are unpivoted: a task's counts are then those of its
keys alone and both aggregates run in one stage.  Counted where they are read, rows in no
order of the key hardly combine, and a task would hold an entry for nearly each value of
its whole split.  Rows of hot keys (above ``hot_rows``) do combine there: they are counted
where they lie, so a hot key collapses to its distinct values before the shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, NumericType

from custlens.operators.skew import HOT_GROUP_ROWS, NONE_HOT, counted_hot_keys

STATS = ("nunique", "mode", "freq", "minfreq")
#: Values (rows times columns) that a task counts.  The number of tasks follows from it, not
#: from the session's shuffle partitions, so that what a task holds does not grow with the input.
TASK_VALUES = 2_000_000


def _decimals(types: list[DataType]) -> dict[DecimalType, str]:
    """A field for each decimal type among ``types``."""
    found = dict.fromkeys(t for t in types if isinstance(t, DecimalType))
    return {t: f"d{j}" for j, t in enumerate(found)}


def value_counts(df: DataFrame, key: str, columns: dict[str, Column]) -> DataFrame:
    """``key, n, i, x, s, c``: rows per distinct non-null value of each named column
    (``n`` = the column's position in ``columns``; whole numbers in ``i``, other
    numbers in ``x``, text in ``s``, decimals in ``d0``, ``d1`` ... after them, a field for
    each decimal type that occurs), with map-side partial aggregation."""
    types = df.select(*[c.alias(n) for n, c in columns.items()]).schema
    decimals = _decimals([f.dataType for f in types.fields])
    entries = []
    for i, field in enumerate(types.fields):
        c = columns[field.name]
        w, x, s = (F.lit(None).cast(t) for t in ("bigint", "double", "string"))
        d = {name: F.lit(None).cast(t) for t, name in decimals.items()}
        if isinstance(field.dataType, IntegralType):
            w = c.cast("bigint")
        elif field.dataType in decimals:
            d[decimals[field.dataType]] = c
        elif isinstance(field.dataType, NumericType):
            x = c.cast("double")
        else:
            s = c.cast("string")
        # The column is identified by its position (an int key hashes and
        # shuffles cheaper than its name).
        entries.append(F.struct(F.lit(i).alias("n"), w.alias("i"), x.alias("x"), s.alias("s"),
                                *[v.alias(name) for name, v in d.items()]))
    fields = ["i", "x", "s", *decimals.values()]
    long = (df.select(key, F.explode(F.array(*entries)).alias("e"))
              .select(key, "e.n", *[f"e.{f}" for f in fields])
              .where(reduce(or_, [F.col(f).isNotNull() for f in fields])))
    return long.groupBy(key, "n", *fields).agg(F.count(F.lit(1)).alias("c"))


def value_stats(df: DataFrame, key: str, columns: dict[str, Column],
                wanted: dict[str, dict[str, str] | list[tuple[str, str]]],
                hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """One row per key.  ``wanted``: ``name -> {stat: output}`` (or a list of
    ``(stat, output)`` pairs, when one stat feeds several outputs) with stat in
    ``nunique, mode, freq, minfreq``; modes come back in the input type.
    ``hot_rows``: ``NONE_HOT`` for rows that lie together by key already.

    The per-value counts are aggregated straight to one row per key with
    conditional aggregates (fixed-size buffers), so a key's distinct values
    are never gathered in one place."""
    types = {f.name: f.dataType for f in
             df.select(*[c.alias(n) for n, c in columns.items()]).schema.fields}
    decimals = _decimals(list(types.values()))
    fields = ["i", "x", "s", *decimals.values()]
    position = {name: i for i, name in enumerate(columns)}
    c = F.col("c")
    outs = []
    for name, stats in wanted.items():
        is_name = F.col("n") == position[name]
        pairs = stats.items() if isinstance(stats, dict) else stats
        for stat, out in pairs:
            if stat == "nunique":
                # NULL (not 0) when the key has no value of this column.
                n = F.count(F.when(is_name, F.lit(1)))
                outs.append(F.when(n > 0, n).alias(out))
            elif stat == "freq":
                outs.append(F.max(F.when(is_name, c)).alias(out))
            elif stat == "minfreq":
                outs.append(F.min(F.when(is_name, c)).alias(out))
            elif stat == "mode":
                best = F.min(F.when(is_name, F.struct((-c).alias("nc"), *[F.col(f) for f in fields])))
                field = ("i" if isinstance(types[name], IntegralType)
                         else decimals[types[name]] if types[name] in decimals
                         else "x" if isinstance(types[name], NumericType) else "s")
                outs.append(best[field].cast(types[name]).alias(out))
            else:
                raise ValueError(f"unknown stat {stat}")

    def stats_of(rows: DataFrame) -> DataFrame:
        return value_counts(rows, key, columns).groupBy(key).agg(*outs)

    if hot_rows >= NONE_HOT:
        return stats_of(df)
    names = [f"_c{i}" for i in range(len(columns))]
    df = df.select(key, *[c.alias(n) for c, n in zip(columns.values(), names, strict=True)])
    columns = {name: F.col(n) for name, n in zip(columns, names, strict=True)}
    hot, _, n_rows = counted_hot_keys(df, [key], hot_rows)
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows * len(columns) // TASK_VALUES))
    if hot is None:
        return stats_of(df.repartition(tasks, key))
    hot = hot.withColumnRenamed(key, "_hot")
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    common = stats_of(df.join(hot, is_hot, "left_anti").repartition(tasks, key))
    return common.unionByName(stats_of(df.join(hot, is_hot, "left_semi")))
