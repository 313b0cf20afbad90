"""Invariants from the test strategy: results do not depend on partitioning
or input order; signed sums add up; narrowing keeps integer values."""

import math

from pyspark.sql import functions as F

from custlens.operators.clean import narrow_types
from custlens.operators.profile import transaction_profile
from custlens.sources import fixtures as fx
from custlens.sources.tables import read_table
from tests.conftest import SF0001


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_profile_invariant_under_repartition_and_order(spark):
    trd = fx.trd(spark, SF0001).cache()
    fams = ["amount", "signed", "calendar", "flag1", "codes", "flag3", "buckets"]
    a = _rows(transaction_profile(trd, fams))
    shuffled = trd.repartition(7).orderBy(F.rand(3))
    b = _rows(transaction_profile(shuffled, fams))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert u == v or (isinstance(u, float) and math.isclose(u, v, rel_tol=1e-9))
    trd.unpersist()


def test_signed_sums_add_up(spark):
    p = transaction_profile(fx.trd(spark, SF0001), ["amount", "signed"]).collect()
    for r in p:
        parts = (r["cny_trx_amt_positive_sum"] or 0.0) + (r["cny_trx_amt_negative_sum"] or 0.0)
        assert abs(parts - r["cny_trx_amt_sum"]) < 0.011


def test_narrowing_keeps_integer_values(spark):
    li = read_table(spark, SF0001, "lineitem")
    narrow = narrow_types(li)
    ints = [c for c, t in li.dtypes if t in ("bigint", "int")]
    a = _rows(li.select(*ints))
    b = _rows(narrow.select(*[F.col(c).cast("bigint") for c in ints]))
    assert a == b
    assert all(t in ("tinyint", "smallint", "int") for c, t in narrow.select(*ints).dtypes)


def test_hot_customer_profile_matches_pandas(spark):
    """One customer holds a third of all transactions; with a low hot
    threshold its medians come from the distributed path."""
    import datetime as dt

    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(9)
    n = 3000
    ids = np.where(np.arange(n) % 3 == 0, 0, rng.integers(1, 60, n))
    amt = np.round(rng.normal(50, 400, n), 2)
    tm = [dt.datetime(2020, 1, 1) + dt.timedelta(hours=int(h)) for h in rng.integers(0, 24 * 400, n)]
    pdf = pd.DataFrame({"id": ids, "trx_tm": tm, "amt": amt,
                        "flg1": rng.choice(["B", "C"], n), "flg3": rng.choice(["A", "B", "C"], n),
                        "cod1": rng.choice(["x", "y"], n), "cod2": rng.choice(["p", "q", "r"], n)})
    df = spark.createDataFrame(pdf)
    got = transaction_profile(df, ["amount", "signed", "flag3"], hot_rows=200).toPandas().set_index("id")
    g = pdf.groupby("id")
    want_all = g["amt"].median()
    want_pos = pdf[pdf.amt > 0].groupby("id")["amt"].median()
    want_a = pdf[pdf.flg3 == "A"].groupby("id")["amt"].median()
    assert np.allclose(got.loc[want_all.index, "cny_trx_amt_median"], want_all)
    assert np.allclose(got.loc[want_pos.index, "cny_trx_amt_positive_median"], want_pos)
    assert np.allclose(got.loc[want_a.index, "A_median"], want_a)
    assert np.isclose(got.loc[0, "cny_trx_amt_sum"], round(pdf[pdf.id == 0].amt.sum(), 2))


def test_profile_outputs_subset(spark):
    trd = fx.trd(spark, SF0001)
    full = transaction_profile(trd, ["codes", "calendar"])
    some = transaction_profile(trd, ["codes", "calendar"], outputs=["trx1_mode", "week_kurl2"])
    assert some.columns == ["id", "trx1_mode", "week_kurl2"]
    assert _rows(some) == _rows(full.select("id", "trx1_mode", "week_kurl2"))


def test_profile_median_only(spark):
    trd = fx.trd(spark, SF0001)
    m = transaction_profile(trd, ["amount"], outputs=["cny_trx_amt_median"])
    full = transaction_profile(trd, ["amount"]).select("id", "cny_trx_amt_median")
    assert _rows(m) == _rows(full)


def test_bucket_counts_rowwise_paths_agree(spark):
    from custlens.operators.temporal import bucket_counts_rowwise
    t = fx.trd(spark, SF0001).select("id", "l_orderkey", "l_linenumber", "trx_tm")
    a = _rows(bucket_counts_rowwise(t))
    b = _rows(bucket_counts_rowwise(t, hot_rows=20))  # busy customers take the join path
    assert a == b and len(a) == t.count()
