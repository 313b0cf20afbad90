"""Time gaps between a customer's events and per-bucket event counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens.functions.calendar import calendar_parts, iso_week, weekday_mon0, whole_days_between
from custlens.operators.ordered import previous_value
from custlens.operators.skew import HOT_GROUP_ROWS, hot_keys


def day_gaps(events: DataFrame, key: str = "id", tm: str = "trx_tm",
             segment=None, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Per event: whole days since the customer's previous event (NULL for the
    first).  Times are ordered within the customer, as the reference re-sorts
    them before differencing.  ``segment`` (default: between quantiles of the
    customer's own times) splits a customer's history so a very active customer is
    ordered in many tasks, also one whose events all fall on one day."""
    prev = previous_value(events.select(key, tm), [key], segment, tm, "_prev_tm", hot_rows)
    return prev.select(key, tm, whole_days_between("_prev_tm", tm).alias("days"))


def gap_stats(events: DataFrame, key: str = "id", tm: str = "trx_tm", suffix: str = "",
              segment=None, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """``max/mean/std_day_diff{suffix}`` per customer (sample std)."""
    g = day_gaps(events, key, tm, segment, hot_rows)
    d = F.col("days")
    return g.groupBy(key).agg(F.max(d).alias(f"max_day_diff{suffix}"),
                              F.avg(d).alias(f"mean_day_diff{suffix}"),
                              F.stddev_samp(d).alias(f"std_day_diff{suffix}"))


def with_calendar_parts(events: DataFrame, tm: str, prefix: str = "") -> DataFrame:
    """Add ``day, week, weekday (Mon=0), hour``."""
    return events.select("*", *calendar_parts(tm, prefix))


def bucket_counts_rowwise(trd: DataFrame, key: str = "id", tm: str = "trx_tm",
                          hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Each transaction gets the number of its customer's transactions in the same
    ISO week (``trx_tm_week``) and the same weekday (``trx_tm_weekday``).

    Ordinary customers: one hash partitioning by customer serves both count
    windows (one shuffle of the rows).  Hot customers (above ``hot_rows``
    rows): counts are pre-aggregated per ``(id, week)`` / ``(id, weekday)`` and
    joined back, so a hot customer is spread over its weeks (and AQE splits a
    hot week) instead of sitting in one window partition.
    """
    t = trd.withColumns({"week": iso_week(tm), "weekday": weekday_mon0(tm)})

    def windowed(d: DataFrame) -> DataFrame:
        d = d.repartition(key)
        return d.withColumns({
            "trx_tm_week": F.count(tm).over(Window.partitionBy(key, "week")),
            "trx_tm_weekday": F.count(tm).over(Window.partitionBy(key, "weekday"))})

    def joined(d: DataFrame) -> DataFrame:
        wk = d.groupBy(key, "week").agg(F.count(tm).alias("trx_tm_week")).select(
            F.col(key).alias("_k1"), F.col("week").alias("_b1"), "trx_tm_week")
        wd = d.groupBy(key, "weekday").agg(F.count(tm).alias("trx_tm_weekday")).select(
            F.col(key).alias("_k2"), F.col("weekday").alias("_b2"), "trx_tm_weekday")
        # Null-safe keys: a NULL week is its own bucket, as in the window form.
        out = d.join(wk, d[key].eqNullSafe(wk["_k1"]) & d["week"].eqNullSafe(wk["_b1"]), "left")
        out = out.join(wd, out[key].eqNullSafe(wd["_k2"]) & out["weekday"].eqNullSafe(wd["_b2"]),
                       "left")
        return out.drop("_k1", "_b1", "_k2", "_b2")

    # Rows without a customer belong to no group: their counts are NULL.
    known = t.where(F.col(key).isNotNull())
    unknown = t.where(F.col(key).isNull()).withColumns({
        c: F.lit(None).cast("bigint") for c in ("trx_tm_week", "trx_tm_weekday")})
    hot, _ = hot_keys(known, [key], hot_rows)
    if hot is None:
        return windowed(known).unionByName(unknown)
    return (windowed(known.join(hot, key, "left_anti"))
            .unionByName(joined(known.join(hot, key, "left_semi"))).unionByName(unknown))
