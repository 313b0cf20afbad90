"""Segmented windows and the distributed exact median against brute force,
including a hot key holding most rows and segments/buckets forced small."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from custlens.operators.median import exact_median, exact_medians_by_part
from custlens.operators.ordered import previous_value, row_numbers, running_sums


def _frame(spark, pdf, schema):
    return spark.createDataFrame(pdf, schema=schema)


values = st.lists(st.tuples(st.integers(0, 3), st.one_of(
    st.floats(-1e6, 1e6, allow_nan=False, width=32), st.integers(-5, 5).map(float))),
    min_size=1, max_size=60)


@settings(max_examples=8, deadline=None)
@given(values)
def test_exact_median_matches_numpy(spark, rows):
    # key 0 is made hot: it gets most rows
    rows = rows + [(0, v) for _, v in rows]
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    df = _frame(spark, pdf, "k int, v double")
    want = pdf.groupby("k")["v"].median().to_dict()
    # distributed path for the big groups / built-in only / broadcast bucket path
    for hot_rows, bound in ((4, None), (10**9, None), (10**9, 4)):
        got = {r["k"]: r["median"] for r in
               exact_median(df, ["k"], "v", per_octave=2, hot_rows=hot_rows,
                            max_groups=bound).collect()}
        assert set(got) == set(want)
        for k in want:
            assert np.isclose(got[k], want[k], rtol=1e-12, atol=1e-9), (k, got[k], want[k])


def test_exact_median_nulls_nan_and_broadcast(spark):
    pdf = pd.DataFrame({"k": [1, 1, 1, 2, 2, 3], "v": [1.0, None, 3.0, float("nan"), 5.0, None]})
    df = _frame(spark, pdf, "k int, v double")
    for bound in (None, 10):
        for hot_rows in (0, 1, 10**9):
            got = {r["k"]: r["median"] for r in
                   exact_median(df, ["k"], "v", max_groups=bound, hot_rows=hot_rows).collect()}
            assert got == {1: 2.0, 2: 5.0}


def test_medians_by_part(spark):
    pdf = pd.DataFrame({"id": [1] * 6 + [2] * 3, "a": [5.0, -1.0, 3.0, -7.0, 2.0, 9.0, 1.0, 2.0, 3.0]})
    df = _frame(spark, pdf, "id int, a double")
    a = F.col("a")
    for hot_rows in (0, 4, 10**9):
        got = exact_medians_by_part(df, "id", {"all": (a, a.isNotNull()), "pos": (a, a > 0),
                                               "neg": (a, a < 0)}, hot_rows=hot_rows)
        assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, 2.5, 4.0, -4.0),
                                                                    (2, 2.0, 2.0, None)]


def test_running_sums_and_row_numbers(spark):
    rng = np.random.default_rng(7)
    n = 400
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.7, 0, rng.integers(1, 5, n)),
                        "t": rng.integers(0, 50, n), "u": np.arange(n), "x": rng.integers(1, 9, n)})
    df = _frame(spark, pdf, "k long, t long, u long, x long")
    seg = F.floor(F.col("t") / 7)
    pdf = pdf.sort_values(["k", "t", "u"])
    pdf["cx"] = pdf.groupby("k")["x"].cumsum()
    pdf["rn"] = pdf.groupby("k").cumcount() + 1
    for hot_rows in (0, 100, 10**9):  # all segmented / key 0 hot / plain windows
        out = running_sums(df, ["k"], seg, ["t", "u"], {"cx": F.col("x")}, hot_rows).toPandas()
        m = out.merge(pdf, on=["k", "t", "u", "x"], suffixes=("", "_want"))
        assert len(m) == n and (m["cx"] == m["cx_want"]).all()
        rn = row_numbers(df, ["k"], seg, ["t", "u"], "rn", hot_rows).toPandas()
        m = rn.merge(pdf, on=["k", "t", "u"], suffixes=("", "_want"))
        assert len(m) == n and (m["rn"] == m["rn_want"]).all()


def test_running_sums_keep_null_order_rows(spark):
    pdf = pd.DataFrame({"k": [1, 1, 1], "t": [None, 5.0, 2.0]})
    df = _frame(spark, pdf, "k int, t double")
    for hot_rows in (0, 10**9):
        out = row_numbers(df, ["k"], F.floor(F.col("t")), ["t"], "rn", hot_rows).orderBy("rn").collect()
        assert [(r["t"], r["rn"]) for r in out] == [(None, 1), (2.0, 2), (5.0, 3)]


def test_previous_value_across_segments(spark):
    rng = np.random.default_rng(3)
    n = 300
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.6, 0, rng.integers(1, 4, n)),
                        "t": rng.integers(0, 100, n)})
    df = _frame(spark, pdf, "k long, t long")
    want = pdf.sort_values(["k", "t"]).assign(p=lambda d: d.groupby("k")["t"].shift())
    b = want.sort_values(["k", "t", "p"], na_position="first").reset_index(drop=True)
    for hot_rows in (0, 100, 10**9):
        out = previous_value(df, ["k"], F.floor(F.col("t") / 10), "t", "p", hot_rows).toPandas()
        a = out.sort_values(["k", "t", "p"], na_position="first").reset_index(drop=True)
        assert len(a) == len(b) and (a["t"] == b["t"]).all()
        assert a["p"].fillna(-1).tolist() == b["p"].fillna(-1).tolist()


def test_running_sums_with_nulls_do_not_depend_on_the_split_of_hot_keys(spark):
    from pyspark.sql import functions as F
    from custlens.operators.ordered import running_sums
    rows = [(1, i, v) for i, v in enumerate([None, None, 5, None, None, 2, None])] + [(2, 0, None)]
    df = spark.createDataFrame(rows, "id int, t int, v int")
    for hot in (0, 10**9):
        out = running_sums(df, ["id"], F.floor(F.col("t") / 2), ["t"], {"s": F.col("v")}, hot)
        got = [r["s"] for r in out.orderBy("id", "t").collect()]
        assert got == [None, None, 5, 5, 5, 7, 7, None]


def test_money_sums_are_exact_and_independent_of_partitions(spark):
    from pyspark.sql import functions as F
    from custlens.functions import money_sum
    df = spark.range(300_000).select((F.col("id") % 9973 / 100 + 12345.01).alias("amt"))
    want = sum(round((i % 9973) + 1234501) for i in range(300_000)) / 100
    for d in (df.coalesce(1), df.repartition(8)):
        assert d.agg(money_sum("amt")).first()[0] == want


def test_modes_keep_all_digits_of_whole_numbers(spark):
    from pyspark.sql import functions as F
    from custlens.operators.histogram import value_stats
    df = spark.createDataFrame([(1, 2**53), (1, 2**53 + 1), (1, 2**53 + 1)], "id int, n bigint")
    got = value_stats(df, "id", {"n": F.col("n")}, {"n": {"mode": "m", "nunique": "k"}}).first()
    assert (got["m"], got["k"]) == (2**53 + 1, 2)


def test_rows_without_a_customer_get_no_bucket_count(spark):
    from datetime import datetime
    from custlens.operators.temporal import bucket_counts_rowwise
    day = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, day), (1, day), (None, day), (None, day)], "id int, trx_tm timestamp")
    got = bucket_counts_rowwise(df).orderBy("id").collect()
    assert [(r["id"], r["trx_tm_week"]) for r in got] == [(None, None), (None, None), (1, 2), (1, 2)]


def test_values_are_counted_by_key_in_tasks_of_bounded_size(spark, monkeypatch):
    from custlens.operators import histogram
    rows = [(k, f"v{(k * 7 + j) % 5}", j % 3) for k in range(20) for j in range(k + 1)] + [(None, "v1", 1), (3, None, 1)]
    df = spark.createDataFrame(rows, "id long, s string, n int")
    columns, wanted = {"s": F.col("s"), "n": F.col("n")}, {"s": {"mode": "m", "freq": "f"}, "n": {"nunique": "k"}}

    def stats(**kw):
        return histogram.value_stats(df, "id", columns, wanted, **kw)

    plain = sorted(map(str, stats().collect()))
    assert len(plain) == 21 and plain == sorted(map(str, stats(hot_rows=histogram.NONE_HOT).collect()))
    # Hot keys, the missing one among them, are counted apart.
    assert plain == sorted(map(str, stats(hot_rows=10).collect())) == sorted(map(str, stats(hot_rows=0).collect()))
    # The number of tasks follows from the values: 212 rows of two columns.
    monkeypatch.setattr(histogram, "TASK_VALUES", 10)
    few = stats()
    assert few.rdd.getNumPartitions() == 43 and plain == sorted(map(str, few.collect()))
