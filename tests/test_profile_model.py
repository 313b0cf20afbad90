"""Profile traps, gaps, folds, AUC, blending, sequences, selection and I/O."""

import datetime as dt
import os
import tempfile

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from custlens.operators import model, select, sequence
from custlens.operators.histogram import value_stats
from custlens.operators.profile import transaction_profile
from custlens.operators.temporal import gap_stats
from custlens.sources import io

T0 = dt.datetime(2021, 1, 3, 10, 0)  # a Sunday: ISO week 53 of 2020, weekday 6


def _trd(spark, rows):
    return spark.createDataFrame(rows, "id long, trx_tm timestamp, amt double, flg1 string, "
                                       "flg3 string, cod1 string, cod2 string")


def test_calendar_parts_and_traps(spark):
    rows = [(1, T0, 10.0, "B", "A", "x", "t1"), (1, T0 + dt.timedelta(days=1), -4.0, "C", "A", "y", "t1"),
            (1, T0 + dt.timedelta(days=8), 6.0, "Z", "B", "y", "t2"), (2, T0, 5.0, "B", "C", "x", "t3")]
    p = transaction_profile(_trd(spark, rows)).orderBy("id").collect()
    a, b = p[0].asDict(), p[1].asDict()
    assert a["week_mode2"] == 1 and a["week_nunique2"] == 3 and a["weekday_mode2"] == 0
    assert a["dat1_count"] == 2 and a["dat1_nunique"] == 2 and a["dat1_mean"] == 0.5  # Z -> NULL
    assert a["dat3_mode"] == "A" and a["dat3_modev"] == 2 and a["trx1_mode"] == "y"
    assert a["cny_trx_amt_negative_nunique"] == 1 and b["cny_trx_amt_negative_nunique"] is None  # T10
    assert b["cny_trx_amt_negative_sum"] is None and b["cny_trx_amt_sum"] == 5.0
    assert a["A_std"] is not None and b["A_max"] == 0 and b["A_std"] == 0  # member fill
    assert b["C_std"] == 0  # one-row std is NULL, filled with 0 for members (T2)
    assert a["week_max2"] == 1 and a["week_min2"] == 1 and a["cny_trx_amt_median"] == 6.0


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["b", "a", "c", "10", "9"])),
                min_size=1, max_size=40))
def test_mode_is_most_frequent_smallest(spark, rows):
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    df = spark.createDataFrame(pdf, "k long, v string")
    out = value_stats(df, "k", {"v": F.col("v")}, {"v": {"mode": "m", "freq": "f", "nunique": "n",
                                                          "minfreq": "lo"}})
    for r in out.collect():
        vc = pdf[pdf.k == r["k"]].v.value_counts()
        top = vc.max()
        assert r["f"] == top and r["m"] == min(vc[vc == top].index) and r["n"] == len(vc)
        assert r["lo"] == vc.min()


def test_gap_stats_whole_days(spark):
    rows = [(1, dt.datetime(2021, 1, 1, 23, 0)), (1, dt.datetime(2021, 1, 3, 1, 0)),
            (1, dt.datetime(2021, 1, 2, 0, 0)), (2, dt.datetime(2021, 5, 1))]
    df = spark.createDataFrame(rows, "id long, trx_tm timestamp")
    g = {r["id"]: r for r in gap_stats(df).collect()}
    # sorted: 1/1 23:00 -> 1/2 00:00 (0 days) -> 1/3 01:00 (1 day)
    assert g[1]["max_day_diff"] == 1 and g[1]["mean_day_diff"] == 0.5
    assert g[2]["max_day_diff"] is None and g[2]["std_day_diff"] is None


def test_folds_disjoint_complete_balanced(spark):
    n = 523
    df = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(n)], "id long, s int")
    f = model.assign_folds(df, "id", "s").toPandas()
    assert len(f) == n and f.id.is_unique and set(f.fold) == {0, 1, 2, 3, 4}
    for _, g in f.groupby("s"):
        counts = g.fold.value_counts()
        assert counts.max() - counts.min() <= 1
    again = model.assign_folds(df.repartition(3), "id", "s").toPandas()
    assert f.sort_values("id").fold.tolist() == again.sort_values("id").fold.tolist()
    segmented = model.assign_folds(df, "id", "s", hot_rows=0).toPandas()
    assert f.sort_values("id").fold.tolist() == segmented.sort_values("id").fold.tolist()


def test_auc_matches_pairwise_count(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 300), "label": rng.integers(0, 2, 300),
                        "score": rng.integers(0, 20, 300) / 20.0})
    for hot_rows in (0, 10**9):
        out = {r["g"]: r["auc"] for r in
               model.auc_by_group(spark.createDataFrame(pdf), ["g"], hot_rows=hot_rows).collect()}
        for g, d in pdf.groupby("g"):
            p, n = d[d.label == 1].score.values, d[d.label == 0].score.values
            want = ((p[:, None] > n[None, :]).sum()
                    + 0.5 * (p[:, None] == n[None, :]).sum()) / (len(p) * len(n))
            assert abs(out[g] - want) < 1e-12


def test_blend_means(spark):
    rows = [(1, 0, 7, 0.2), (1, 1, 7, 0.4), (2, 0, 7, 0.9), (1, 0, 8, 1.0)]
    df = spark.createDataFrame(rows, "model int, fold int, id long, score double")
    got = {r["id"]: r["score"] for r in model.blend(df).collect()}
    assert np.isclose(got[7], (0.3 + 0.9) / 2) and got[8] == 1.0


def test_token_sequences_chunked(spark):
    rows = [(1, T0 + dt.timedelta(hours=i % 30), i, i % 4) for i in range(25)]
    df = spark.createDataFrame(rows, "id long, tm timestamp, o long, tok long")
    got = sequence.token_sequences(df, "id", "tok", ["tm", "o"], max_len=10).orderBy("seq_no").collect()
    want = [str(t) for _, _, _, t in sorted(rows, key=lambda r: (r[1], r[2]))]
    assert [r["seq_no"] for r in got] == [0, 1, 2]
    assert [t for r in got for t in r["tokens"]] == want
    assert max(len(r["tokens"]) for r in got) == 10


def test_mean_vector(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 6.0]), (2, [0.5, 0.5])], "k int, v array<double>")
    got = {r["k"]: r["mean_vec"] for r in sequence.mean_vector(df, "k", "v", 2).collect()}
    assert got == {1: [2.0, 4.0], 2: [0.5, 0.5]}
    wide = sequence.mean_vector(df, "k", "v", 2, prefix="w").orderBy("k").collect()
    assert tuple(wide[0]) == (1, 2.0, 4.0)


def test_importance_scores(spark):
    actual = spark.createDataFrame([("f", 10.0, 4), ("f", 20.0, 8), ("g", 1.0, 1), ("h", 1.0, 1)],
                                   "feature string, importance_gain double, importance_split int")
    null = spark.createDataFrame([("f", 1.0, 1), ("f", 12.5, 9), ("f", None, 2), ("g", 5.0, 0)],
                                 "feature string, importance_gain double, importance_split int")
    s = {r["feature"]: r for r in select.importance_scores(null, actual).collect()}
    # thresholds for f: gain 12.5 (25th pct of 10, 20), split 5
    assert abs(s["f"]["gain_score"] - 100 / 3) < 1e-12 and abs(s["f"]["split_score"] - 200 / 3) < 1e-12
    assert s["g"]["gain_score"] == 0.0 and s["h"]["gain_score"] is None
    kept = select.select_features(select.importance_scores(null, actual), categorical=["g"]).collect()
    assert [r["feature"] for r in kept] == []


def test_io_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="custlens-io-")
    beh = os.path.join(d, "beh.csv")
    with open(beh, "w") as f:
        f.write("id,page_no,\n7,p1,2020-06-01 10:00:00\n")
    pv = io.read_page_views(spark, beh, "train").collect()[0]
    assert pv["page_tm"] == dt.datetime(2020, 6, 1, 10, 0) and pv["split"] == "train"
    scores = spark.createDataFrame([(1, 0, 5, 0.5), (2, 0, 5, 0.7)], "model int, fold int, id long, score double")
    io.write_scores(scores, os.path.join(d, "scores"))
    back = io.read_scores(spark, os.path.join(d, "scores"))
    assert sorted(r["model"] for r in back.collect()) == [1, 2]
    io.write_submission(model.blend(back), os.path.join(d, "sub"))
    lines = [ln for p in os.listdir(os.path.join(d, "sub")) if p.endswith(".csv")
             for ln in open(os.path.join(d, "sub", p))]
    assert lines == ["5\t0.6\n"]
    cust = os.path.join(d, "tag.csv")
    with open(cust, "w") as f:
        f.write("id,flag,age\n1,0,\\N\n2,1,31\n")
    t = io.read_customers(spark, cust, "train")
    assert dict(t.dtypes)["age"] == "string" and dict(t.dtypes)["flag"] == "int"


def test_features_to_scores_end_to_end(spark):
    from custlens.plans.features import build_features, score_customers
    from custlens.sources import fixtures as fx
    from tests.conftest import SF0001
    users = fx.tag(spark, SF0001)
    trd = fx.trd(spark, SF0001)
    feats = build_features(users, trd, fx.beh(spark, SF0001), categorical=["seg_cd", "nat_cd"],
                           woe_cols=[], embed=True)
    assert {"0", "5", "max_day_diff2", "seg_cd_cny_median", "trx2_modev"} <= set(feats.columns)
    blended, aucs = score_customers(feats, trd, categorical=["seg_cd", "nat_cd", "trx1_mode"],
                                    max_iter=3)
    b = blended.collect()
    n_score = users.where("split = 'score'").count()
    assert len(b) == n_score and all(0.0 <= r["score"] <= 1.0 for r in b)
    a = aucs.collect()
    assert sorted((r["model"], r["fold"]) for r in a) == [(m, f) for m in (1, 2, 3) for f in range(5)]


def test_selection_that_keeps_nothing_is_an_error(spark):
    import pytest
    from custlens.plans.features import score_customers
    from custlens.sources import fixtures as fx
    from tests.conftest import SF0001
    feats = fx.tag(spark, SF0001)
    with pytest.raises(ValueError):
        score_customers(feats, fx.trd(spark, SF0001), fx.imp_null(spark, SF0001),
                        fx.imp_actual(spark, SF0001))


def test_oof_fit_importance_and_onehot_limit(spark):
    rng = np.random.default_rng(2)
    n = 300
    pdf = pd.DataFrame({"id": np.arange(n), "x": rng.normal(size=n),
                        "few": rng.choice(["a", "b", "c"], n),
                        "many": [f"v{i % 70}" for i in range(n)],
                        "split": np.where(np.arange(n) % 6 == 0, "score", "train")})
    pdf["flag"] = (pdf.x + (pdf.few == "a") > 0.5).astype(int)
    pdf["fold"] = np.where(pdf.split == "train", np.arange(n) % 5, -1)
    df = spark.createDataFrame(pdf)
    scores, oof, imp = model.oof_fit(df, ["x"], ["few", "many"], encoding="onehot", max_iter=3)
    assert scores.count() == 5 * (pdf.split == "score").sum()
    assert oof.count() == (pdf.split == "train").sum()
    got = {r["feature"]: r["importance"] for r in imp.collect()}
    assert set(got) == {"x", "few", "many"} and abs(sum(got.values()) - 5.0) < 1e-6
    aucs = model.auc_by_group(oof, ["model", "fold"]).collect()
    assert len(aucs) == 5 and all(a["auc"] > 0.5 for a in aucs)


def test_csv_files_to_submission(spark):
    from custlens.plans.features import score_from_files
    from custlens.sources import fixtures as fx
    from tests.conftest import SF0001
    d = tempfile.mkdtemp(prefix="custlens-csv-")
    tag = fx.tag(spark, SF0001).toPandas()
    tag["age"] = np.where(tag.id % 9 == 0, "\\N", (20 + tag.id % 50).astype(str))
    paths = {}
    for split in ("train", "score"):
        t = tag[tag.split == split].drop(columns=["split"])
        if split == "score":
            t = t.drop(columns=["flag"])
        paths[split] = os.path.join(d, f"{split}_tag.csv")
        t.to_csv(paths[split], index=False)
    trd = fx.trd(spark, SF0001).toPandas().rename(columns={
        "flg1": "Dat_Flg1_Cd", "flg3": "Dat_Flg3_Cd", "cod1": "Trx_Cod1_Cd", "cod2": "Trx_Cod2_Cd",
        "amt": "cny_trx_amt"})[["id", "Dat_Flg1_Cd", "Dat_Flg3_Cd", "Trx_Cod1_Cd", "Trx_Cod2_Cd",
                                "trx_tm", "cny_trx_amt"]]
    beh = fx.beh(spark, SF0001).toPandas()
    tpaths, bpaths = {}, {}
    for split in ("train", "score"):
        ids = set(tag[tag.split == split].id)
        tpaths[split] = os.path.join(d, f"{split}_trd.csv")
        trd[trd.id.isin(ids)].to_csv(tpaths[split], index=False)
        bpaths[split] = os.path.join(d, f"{split}_beh.csv")
        b = beh[beh.id.isin(ids)][["id", "page", "page_tm"]]
        with open(bpaths[split], "w") as f:  # the time column has no name
            f.write("id,page_no,\n")
            b.to_csv(f, index=False, header=False)
    out = os.path.join(d, "out")
    blended = score_from_files(spark, paths, tpaths, bpaths, out, categorical=["seg_cd", "nat_cd"],
                           model_ids=(1,), max_iter=2, embed=False)
    n_score = int((tag.split == "score").sum())
    assert blended.count() == n_score
    lines = [ln for p in os.listdir(os.path.join(out, "submission")) if p.endswith(".csv")
             for ln in open(os.path.join(out, "submission", p))]
    assert len(lines) == n_score and all(len(ln.split("\t")) == 2 for ln in lines)
