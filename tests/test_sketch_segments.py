"""Segments of hot keys from quantile sketches: even, in order, and with the same results."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from custlens.operators import ordered, sequence
from custlens.operators.temporal import day_gaps

DAY = dt.datetime(2024, 3, 1)


def one_day(spark, n=2000):
    """Customer 0 has nearly all events, all on one day and in one narrow hour; some times tie or miss."""
    rng = np.random.default_rng(3)
    rows = [(0, DAY + dt.timedelta(seconds=int(s)), int(k)) for k, s in enumerate(rng.integers(0, 3600, n))]
    rows += [(0, None, n), (1, DAY, 1), (1, DAY + dt.timedelta(days=3), 2), (2, DAY, 3)]
    return spark.createDataFrame(rows, "id int, tm timestamp, k int"), rows


def segments(df, column, hot_rows):
    return ordered._with_segment(df, ["id"], None, column, hot_rows)


@pytest.mark.parametrize("column", ["tm", "score"])
def test_segments_are_even_and_in_order(spark, column):
    df = one_day(spark)[0].withColumn("score", F.when(F.col("tm").isNotNull(), F.col("k") * 1e-9 + 1e-3))
    got = segments(df, column, 400).where("id = 0 and tm is not null").select(ordered.SEG, column).toPandas()
    got["seg"] = [s["v"] for s in got[ordered.SEG]]
    size = got.groupby("seg").size()
    assert len(size) >= 15 and size.max() <= 400
    bounds = got.groupby("seg")[column].agg(["min", "max"]).sort_index()
    assert (bounds["max"].to_numpy()[:-1] <= bounds["min"].to_numpy()[1:]).all()


def test_binary_search_counts_cuts(spark):
    cuts = [-2.5, 0.0, 1.0, 7.0]
    values = [-9.0, -2.5, -1.0, 0.0, 0.5, 1.0, 6.9, 7.0, 8.0, None]
    df = spark.createDataFrame([(v, cuts) for v in values] + [(1.0, [])], "x double, c array<double>")
    got = [r[0] for r in df.select(ordered.cuts_below(F.col("c"), F.col("x"))).collect()]
    assert got == [sum(c <= v for c in cuts) if v is not None else None for v in values] + [0]


@pytest.mark.parametrize("hot_rows", [0, 300, 10 ** 6])
def test_results_do_not_depend_on_the_cuts(spark, hot_rows):
    df, rows = one_day(spark, 900)
    gaps = day_gaps(df, "id", "tm", hot_rows=hot_rows).groupBy("id").agg(
        F.count("days").alias("n"), F.max("days").alias("top")).collect()
    assert {r["id"]: (r["n"], r["top"]) for r in gaps} == {0: (899, 0), 1: (1, 3), 2: (0, None)}
    previous = ordered.previous_value(df, ["id"], None, "tm", "before", hot_rows).toPandas()
    for i, some in previous.groupby("id"):
        times = sorted(t for k, t, _ in rows if k == i and t is not None)
        assert sorted(some["before"].dropna()) == [pd.Timestamp(t) for t in times[:-1]]
    chunks = sequence.token_sequences(df, "id", "k", ["tm", "k"], max_len=50, hot_rows=hot_rows).collect()
    got = [t for r in sorted(chunks, key=lambda r: r["seq_no"]) if r["id"] == 0 for t in r["tokens"]]
    assert got == [str(k) for i, t, k in sorted(rows, key=lambda r: (r[1] or dt.datetime.min, r[2])) if i == 0]


def test_text_order_needs_a_segment(spark):
    with pytest.raises(ValueError, match="segment"):
        ordered.row_numbers(spark.createDataFrame([(1, "a")], "id int, t string"), ["id"], None, ["t"], "n", 0)
