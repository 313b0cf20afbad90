"""Cleaning, narrowing, member fills, WOE and category money on hand-made frames."""
import pytest

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from custlens.operators import clean, encode

BS = "\\N"


def test_null_sentinels_three_cases(spark):
    rows = [  # id, split, a (no -1), b (categorical, -1 in train), c (numeric, -1 in train)
        (1, "train", BS, "-1", "-1"),
        (2, "train", "x", "31", BS),
        (3, "score", "30", "y", "7"),
        (4, "score", "z", "-1", BS),
        (5, "train", "w", "v", "12"),
    ]
    df = spark.createDataFrame(rows, "id int, split string, a string, b string, c string")
    out = clean.null_sentinels(df, categorical=["b"]).orderBy("id")
    assert dict(out.dtypes)["c"] == "double"
    got = [tuple(r) for r in out.collect()]
    assert got == [(1, "train", None, None, None), (2, "train", "x", None, None),
                   (3, "score", None, "y", 7.0), (4, "score", "z", None, None),
                   (5, "train", "w", "v", 12.0)]


def test_numbers_of_a_numeric_split_are_no_sentinels(spark):
    # age: numbers only; amt: text in the scoring rows alone, where its sentinels go.
    rows = [(1, "train", "-1", "-1"), (2, "train", "30", "30"), (3, "score", "31", BS),
            (4, "score", "45", "31"), (5, "score", "7", "8")]
    df = spark.createDataFrame(rows, "id int, split string, age string, amt string")
    out = clean.infer_numeric(clean.null_sentinels(df), skip=["id", "split"]).orderBy("id")
    assert [(r["age"], r["amt"]) for r in out.collect()] == [
        (-1.0, -1.0), (30.0, 30.0), (31.0, None), (45.0, None), (7.0, 8.0)]


def test_nan_is_no_value(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, nan, 2.0), (2, 1.0, nan)], "id int, a double, b double")
    assert dict(clean.narrow_types(df, skip=["id"]).dtypes)["a"] == "float"
    from custlens.operators import encode
    got = encode.ratio_features(df, ["a", "b"], "s").orderBy("id").collect()
    assert [r["s"] for r in got] == [2.0, 1.0]
    txt = spark.createDataFrame([("NaN",), ("2",)], "t string")
    assert [r["t"] for r in clean.infer_numeric(txt).collect()] == [None, 2.0]


def test_repeated_ids_are_refused(spark):
    clean.require_unique(spark.createDataFrame([(1,), (2,), (None,), (None,)], "id int"))
    with pytest.raises(ValueError, match="id is repeated: 2"):
        clean.require_unique(spark.createDataFrame([(1,), (2,), (2,)], "id int"))


def test_null_sentinels_keeps_clean_and_score_only_minus_one(spark):
    # "-1" only in scoring rows: rule (a) applies, "-1" stays
    rows = [(1, "train", BS), (2, "score", "-1"), (3, "train", "5")]
    df = spark.createDataFrame(rows, "id int, split string, a string")
    got = [r["a"] for r in clean.null_sentinels(df).orderBy("id").collect()]
    assert got == [None, "-1", "5"]
    clean_df = spark.createDataFrame([(1, "train", "q")], "id int, split string, a string")
    assert clean.null_sentinels(clean_df).collect()[0]["a"] == "q"


def test_narrow_types_strict_bounds(spark):
    df = spark.createDataFrame([(127, -128, 1, 1.5, 3.4e39, None), (0, 0, 32767, 2.0, 0.0, None)],
                               "a long, b long, c int, d double, e double, f double")
    out = clean.narrow_types(df)
    assert dict(out.dtypes) == {"a": "smallint", "b": "smallint", "c": "int", "d": "float",
                                "e": "double", "f": "double"}
    df2 = spark.createDataFrame([(126, -127)], "a long, b long")
    assert dict(clean.narrow_types(df2).dtypes) == {"a": "tinyint", "b": "tinyint"}


def test_member_fill(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    facts = spark.createDataFrame([(1, 5), (1, 6), (3, 7)], "id int, x int")
    marked = clean.mark_member(users, facts, "id", "m")
    stats = spark.createDataFrame([(1, None), (3, 4)], "id int, s int")
    out = clean.fill_for_members(marked.join(stats, "id", "left"), ["s"], "m", 0)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, 0), (2, 0, None), (3, 1, 4)]


def test_ratio_and_product(spark):
    df = spark.createDataFrame([(1, 1.0, None, 2.0), (2, -1.0, 0.0, 0.0)], "id int, a double, b double, c double")
    out = encode.ratio_features(df, ["a", "b", "c"], "s").orderBy("id").collect()
    assert out[0]["s"] == 3.0 and out[0]["a_ratio"] == 0.25 and out[0]["b_ratio"] is None
    assert out[1]["a_ratio"] is None  # divisor 0 -> NULL
    p = encode.product_features(df, {"ab": ("a", "c")}).orderBy("id").collect()
    assert [r["ab"] for r in p] == [2.0, -0.0]


def _woe_pdf(n=600, seed=1):
    rng = np.random.default_rng(seed)
    cat = rng.choice(["u", "v", "w"], n)
    flag = (rng.random(n) < np.where(cat == "u", 0.5, 0.2)).astype(int)
    split = np.where(rng.random(n) < 0.2, "score", "train")
    return pd.DataFrame({"id": np.arange(n), "flag": flag, "split": split, "c": cat,
                         "tiny": np.where(np.arange(n) % 100 == 0, "r", "q")})


def test_woe_matches_formula_and_guard(spark):
    pdf = _woe_pdf()
    df = spark.createDataFrame(pdf)
    out = encode.woe_encode(df, ["c", "tiny"]).toPandas()
    assert "tiny_crossentroy" not in out.columns  # smallest class <= 100
    tr = pdf[pdf.split == "train"]
    pos, neg = tr.flag.sum(), len(tr) - tr.flag.sum()
    g = tr.groupby("c")["flag"].agg(["sum", "count"])
    want = np.log((g["sum"] / pos) * (neg / (g["count"] - g["sum"])))
    for _, r in out.iterrows():
        assert math.isclose(r["c_crossentroy"], want[r["c"]], rel_tol=1e-12)


def test_woe_flips_sign_with_label(spark):
    pdf = _woe_pdf()
    a = encode.woe_encode(spark.createDataFrame(pdf), ["c"]).toPandas().set_index("id")
    flipped = pdf.assign(flag=1 - pdf.flag)
    b = encode.woe_encode(spark.createDataFrame(flipped), ["c"]).toPandas().set_index("id")
    assert np.allclose(a["c_crossentroy"], -b["c_crossentroy"].loc[a.index])


def test_category_money_against_pandas(spark):
    rng = np.random.default_rng(5)
    users = pd.DataFrame({"id": np.arange(40), "split": np.where(np.arange(40) % 4 == 0, "score", "train"),
                          "g": rng.choice(["a", "b", None], 40)})
    trd = pd.DataFrame({"id": rng.integers(0, 45, 500),
                        "amt": np.round(rng.normal(0, 100, 500), 2)})
    for copies in (1, 2):
        out = encode.category_money(spark.createDataFrame(users), spark.createDataFrame(trd), ["g"],
                                    scoring_copies=copies).toPandas().set_index("id")
        sc = trd[trd.id.isin(users[users.split == "score"].id)]
        all_trd = pd.concat([trd] + [sc] * (copies - 1)).merge(users, on="id", how="left")
        for suffix, sub in (("_cny", all_trd), ("pos_cny", all_trd[all_trd.amt > 0]),
                            ("neg_cny", all_trd[all_trd.amt < 0])):
            med = users.g.map(sub.groupby("g")["amt"].median())
            tot = users.g.map(sub.groupby("g")["amt"].sum())
            assert np.allclose(out.loc[users.id, f"g{suffix}_median"].astype(float), med, equal_nan=True)
            assert np.allclose(out.loc[users.id, f"g{suffix}_sum"].astype(float), tot.round(2), equal_nan=True)


def test_woe_out_of_fold_matches_refit_per_fold(spark):
    pdf = _woe_pdf(n=900, seed=4)
    pdf["fold"] = np.arange(len(pdf)) % 3
    out = encode.woe_encode(spark.createDataFrame(pdf), ["c"], fold_col="fold").toPandas()
    tr = pdf[pdf.split == "train"]
    full = encode.woe_encode(spark.createDataFrame(pdf), ["c"]).toPandas().set_index("id")
    for f in range(3):
        other = tr[tr.fold != f]
        pos, neg = other.flag.sum(), len(other) - other.flag.sum()
        g = other.groupby("c")["flag"].agg(["sum", "count"])
        want = np.log((g["sum"] / pos) * (neg / (g["count"] - g["sum"])))
        rows = out[(out.split == "train") & (out.fold == f)]
        assert np.allclose(rows["c_crossentroy"].values, want.loc[rows["c"]].values, rtol=1e-12)
    sc = out[out.split == "score"].set_index("id")
    assert np.allclose(sc["c_crossentroy"], full.loc[sc.index, "c_crossentroy"], rtol=1e-12)


def test_infer_numeric(spark):
    df = spark.createDataFrame([("1", "2.5", "a", None), ("7", None, "3", None)],
                               "id string, x string, y string, z string")
    out = clean.infer_numeric(df, skip=["id"])
    assert dict(out.dtypes) == {"id": "string", "x": "double", "y": "string", "z": "string"}


def test_category_codes_are_ranks_or_bounded_hashes(spark):
    rows = [(i, f"v{i:03d}", "b" if i % 3 else "a", None, i < 40) for i in range(60)]
    rows += [(100, None, None, None, True), (101, "v007", "new", "late", False), (102, "", "a", None, True)]
    df = spark.createDataFrame(rows, "id int, many string, few string, none string, learn boolean")
    got, sizes = encode.category_codes(df, ["many", "few", "none"], F.col("learn"), max_codes=20)
    assert sizes == {"many": 20, "few": 2, "none": 0}
    by = {r["id"]: r for r in got.collect()}
    assert len(by) == len(rows) and got.columns == [*df.columns, "many_code", "few_code", "none_code"]
    assert {by[i]["few_code"] for i in range(60)} == {0, 1} and by[0]["few_code"] == 0
    # Missing values get n, unlearned ones n + 1 (hashed columns know all values).
    assert (by[100]["few_code"], by[101]["few_code"]) == (2, 3)
    assert (by[100]["many_code"], by[100]["none_code"], by[101]["none_code"]) == (20, 0, 1)
    assert by[101]["many_code"] == by[7]["many_code"]
    hashed = {r["many_code"] for i, r in by.items() if i != 100}
    assert hashed <= set(range(20)) and len(hashed) > 10
    ranks, sizes = encode.category_codes(df, ["many"], F.col("learn"), max_codes=41)
    by = {r["id"]: r["many_code"] for r in ranks.collect()}
    # The empty text is a value, the first in order.
    assert sizes == {"many": 41} and by[102] == 0 and [by[i] for i in range(40)] == list(range(1, 41))
    assert by[50] == 42 and by[100] == 41
    empty, sizes = encode.category_codes(df.limit(0), ["few"], max_codes=5)
    assert empty.collect() == [] and sizes == {"few": 0}
    assert encode.category_codes(df, [])[0] is df
