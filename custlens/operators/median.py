"""Exact grouped median that stays parallel inside one big group.

``F.median`` keeps a value -> count map per group and merges it in one task:
fine for a small domain (weeks, weekdays), but a category holding half of all
transactions would put every distinct amount of that half into one map.  This
operator keeps the answer exact (mean of the two middle values, as pandas and
NumPy) and splits each group by value bucket instead:

1. per ``(keys, bucket)`` row counts and, in bucket order, the count before
   each bucket (one small row per bucket) locate the one or two buckets that
   hold the middle ranks;
2. only the rows of those target buckets are counted per distinct value and
   ranked, in a window partitioned by ``(keys, bucket)``.

The target-bucket table has at most two rows per group.  When the caller can
bound the number of groups (categories), it is broadcast: the counts of step
1 are map-side combined and the rows are filtered map-side, so the rows are
never shuffled.  Otherwise the rows are hash-partitioned once by
``(keys, bucket)`` and every later step reuses that partitioning.

Only *hot* groups need this.  A cheap count per group (map-side partial
aggregation of the keys only) finds the groups above ``hot_rows`` rows; the
other groups use the built-in exact ``median``, whose per-group value map is
then bounded by ``hot_rows``.  The hot-key list (at most total rows /
``hot_rows`` entries) is broadcast after its size is checked, and so is the
hot groups' target-bucket table; with no hot group the distributed path is
not planned at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custlens.functions.numeric import log_bucket, nan_to_null
from custlens.operators.skew import HOT_GROUP_ROWS, hot_keys

# Target rows (keys, bucket, offset, two ranks) are ~50 bytes: 200k rows ~ 10 MB.
BROADCAST_MAX_ROWS = 200_000


def _target_buckets(per_bucket: DataFrame, keys: list[str]) -> DataFrame:
    """From ``(keys, _b, _bc)`` counts: the one or two buckets holding the middle
    ranks, as ``(keys, _b, _lo, _r1, _r2)`` (``_lo`` = rows before the bucket)."""
    in_order = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding,
                                                                    Window.currentRow)
    whole = Window.partitionBy(*keys)
    pb = per_bucket.select(*keys, "_b", "_bc", F.sum("_bc").over(in_order).alias("_hi"),
                           F.sum("_bc").over(whole).alias("_n"))
    lo = F.col("_hi") - F.col("_bc")
    r1 = F.floor((F.col("_n") + 1) / 2)          # lower middle rank (1-based)
    r2 = F.floor(F.col("_n") / 2) + 1            # upper middle rank
    return (pb.select(*keys, "_b", "_hi", lo.alias("_lo"), r1.alias("_r1"), r2.alias("_r2"))
              .where(((F.col("_lo") < F.col("_r1")) & (F.col("_r1") <= F.col("_hi")))
                     | ((F.col("_lo") < F.col("_r2")) & (F.col("_r2") <= F.col("_hi"))))
              .drop("_hi"))


def _ranked(base: DataFrame, keys: list[str], max_groups: int | None, per_octave: int) -> DataFrame:
    """Histogram rows of the target buckets with their running count ``_cum``.

    Few groups (``max_groups`` bounded): per-bucket counts are a map-side
    combined aggregate, the target table is broadcast and filters the rows
    map-side, so only target-bucket rows are ever shuffled.  Many groups: the
    rows are hash-partitioned once by ``(keys, bucket)`` and the histogram,
    per-bucket counts, target join and ranking window all reuse it.
    """
    b = base.withColumn("_b", log_bucket("_v", per_octave))
    if max_groups is not None and 2 * max_groups <= BROADCAST_MAX_ROWS:
        per_bucket = b.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_bc"))
        targets = F.broadcast(_target_buckets(per_bucket, keys))
        hist = (b.join(targets, [*keys, "_b"])
                 .groupBy(*keys, "_b", "_v", "_lo", "_r1", "_r2")
                 .agg(F.count(F.lit(1)).alias("_c")))
    else:
        b = b.repartition(*keys, "_b")
        counted = b.groupBy(*keys, "_b", "_v").agg(F.count(F.lit(1)).alias("_c"))
        per_bucket = counted.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"))
        hist = counted.join(_target_buckets(per_bucket, keys), [*keys, "_b"])
    upto = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding,
                                                                       Window.currentRow)
    return hist.withColumn("_cum", F.col("_lo") + F.sum("_c").over(upto))


def _at(rank: str, cond: Column | None = None) -> Column:
    start = F.col("_cum") - F.col("_c")
    hit = (start < F.col(rank)) & (F.col(rank) <= F.col("_cum"))
    if cond is not None:
        hit = hit & cond
    return F.max(F.when(hit, F.col("_v")))


def _base(df: DataFrame, keys: list[str], value) -> DataFrame:
    v: Column = F.col(value) if isinstance(value, str) else value
    cond = F.col("_v").isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.select(*keys, nan_to_null(v).alias("_v")).where(cond)


def _hot_keys(base: DataFrame, keys: list[str], hot_rows: int) -> tuple[DataFrame | None, int]:
    return hot_keys(base, keys, hot_rows)


def exact_median(df: DataFrame, keys: Sequence[str], value, out: str = "median",
                 max_groups: int | None = None, per_octave: int = 256,
                 hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """``keys..., out`` with the exact median of ``value`` per group (NULLs and NaN
    skipped; groups without values are absent).

    ``max_groups``: a proven upper bound on the number of groups; when small
    enough the target-bucket table of the hot groups is broadcast.
    """
    keys = list(keys)
    base = _base(df, keys, value)
    if max_groups is not None and 2 * max_groups <= BROADCAST_MAX_ROWS:
        # Few, possibly huge groups (categories): the broadcast bucket path
        # handles every group without shuffling the rows (and measured faster
        # than the built-in median's per-group value maps).
        return _pick(_ranked(base, keys, max_groups, per_octave), keys, out)
    hot, n_hot = _hot_keys(base, keys, hot_rows)
    if hot is None:
        return base.groupBy(*keys).agg(F.median("_v").alias(out))
    small = (base.join(hot, keys, "left_anti")
                 .groupBy(*keys).agg(F.median("_v").alias(out)))
    ranked = _ranked(base.join(hot, keys, "left_semi"), keys,
                     n_hot if max_groups is None else min(max_groups, n_hot), per_octave)
    return small.unionByName(_pick(ranked, keys, out))


def _pick(ranked: DataFrame, keys: list[str], out: str) -> DataFrame:
    picked = ranked.groupBy(*keys).agg(_at("_r1").alias("_v1"), _at("_r2").alias("_v2"))
    return picked.select(*keys, ((F.col("_v1") + F.col("_v2")) / 2).alias(out))


def exact_medians_by_part(df: DataFrame, key: str, parts: dict[str, tuple[Column, Column]],
                          max_groups: int | None = None, per_octave: int = 256,
                          hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Several medians per ``key`` in one pass.

    ``parts``: ``out_name -> (value, condition)``; each row contributes its value
    to every part whose condition holds.  Returns one row per key (that has
    any value) with one column per part.
    """
    names = list(parts)
    plain = df.select(key, *[F.when(cond, nan_to_null(val)).alias(f"_m{i}")
                             for i, (val, cond) in enumerate(parts.values())])
    plain = plain.where(F.col(key).isNotNull() & F.coalesce(
        *[F.col(f"_m{i}") for i in range(len(names))]).isNotNull())
    hot, n_hot = _hot_keys(plain, [key], hot_rows)

    def builtin(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(*[F.median(f"_m{i}").alias(n) for i, n in enumerate(names)])

    if hot is None:
        return builtin(plain)
    small = builtin(plain.join(hot, [key], "left_anti"))
    # Only the rows of hot keys are taken apart, one row for each part.
    df = df.join(hot, [key], "left_semi")
    entries = F.array(*[
        F.when(cond, F.struct(F.lit(i).alias("p"), val.cast("double").alias("x")))
        for i, (val, cond) in enumerate(parts.values())])
    long = (df.select(key, F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e"))
              .select(key, F.col("e.p").alias("_part"), F.col("e.x").alias("_x")))
    base = _base(long, [key, "_part"], "_x")
    groups = n_hot * len(parts) if max_groups is None else min(max_groups, n_hot) * len(parts)
    ranked = _ranked(base, [key, "_part"], groups, per_octave)
    aggs = []
    for i in range(len(names)):
        is_part = F.col("_part") == i
        aggs += [_at("_r1", is_part).alias(f"_a{i}"), _at("_r2", is_part).alias(f"_b{i}")]
    picked = ranked.groupBy(key).agg(*aggs)
    big = picked.select(key, *[((F.col(f"_a{i}") + F.col(f"_b{i}")) / 2).alias(name)
                               for i, name in enumerate(names)])
    return small.unionByName(big)
