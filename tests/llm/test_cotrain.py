import numpy as np

from custlens.llm import cotrain as C
from tests.llm.cases import hard_docs, hard_rows, no_docs


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = C.classify(docs, labels.where("doc_id % 10 < 7"))
    rows = got.withColumnRenamed("toxic", "p_toxic").join(labels.where("doc_id % 10 >= 7"), "doc_id").collect()
    clean = [r for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    junk = [r for r in rows if r["quality"] == 0]
    toxic = [r for r in rows if r["toxic"] == 1]
    assert np.mean([r["kept"] for r in clean]) > 0.98
    assert np.mean([r["kept"] for r in junk]) < 0.05
    assert np.mean([r["kept"] for r in toxic]) < 0.25
    assert got.count() == docs.count()


def test_views_teach_each_other():
    # Word 1 marks half of the good rows, which metadata tells apart; few rows have labels.
    rng = np.random.default_rng(0)
    n = 2000
    y = (rng.random(n) < 0.5).astype(int)
    text = (np.stack([np.where(y == 1, 1, 2), rng.integers(10, 5000, n)], 1).ravel(), np.arange(n + 1) * 2)
    meta = (np.where(rng.random(n) < 0.95, y, 1 - y), np.arange(n + 1))
    known = np.where(np.arange(n) < 80, y, -1)
    views = C.co_train(text, meta, known)
    p = views.probabilities(text, meta)[2]
    assert ((p > 0.5) == y)[80:].mean() > 0.97


def test_all_unlabelled_documents_take_part(spark, monkeypatch):
    # Five times as many documents as rows that are fitted on.
    monkeypatch.setattr(C, "LABELLED", 200)
    monkeypatch.setattr(C, "HELD", 20)
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    seen, picked = [], []

    class Pool(C.SparkPool):
        def tails(self, weights):
            out = super().tails(weights)
            seen.append(out[0, 0, 0, C.TAIL])
            return out

        def picks(self, weights, cuts):
            out = super().picks(weights, cuts)
            picked.append((out[1], cuts))
            return out

    monkeypatch.setattr(C, "SparkPool", Pool)
    C.train(docs, labels.where("doc_id % 10 < 3"))
    assert seen == [docs.join(labels.where("doc_id % 10 < 3"), "doc_id", "left_anti").count()] * C.ROUNDS
    for n, cuts in picked:
        assert all(abs(n[t, k] - cuts[t][1][k][2]) <= 12 for t in (0, 1) for k in (0, 1))
        assert n.max() <= C.GIVEN * seen[0] + 12


def test_cut_takes_the_surest_share():
    count = np.zeros(C.TAIL + 1, int)
    count[C.TAIL], count[4000], count[3000], count[10] = 1000, 60, 80, 500
    assert C.cut(count) == (3001, 0.5, 100.0)


def test_hard_cases(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (7, 0, None), (None, 1, 1), (12, None, 1)],
                                   "doc_id long, quality int, toxic int")
    got = C.classify(hard_docs(spark), labels)
    assert got.columns == ["doc_id", "p_text", "p_meta", "score", "toxic", "kept"]
    assert got.count() == len(hard_rows()) and got.where("kept is null or score is null").count() == 0
    assert C.classify(no_docs(spark), labels).collect() == []
    free = C.classify(hard_docs(spark), labels.limit(0)).collect()
    assert all(r["score"] == 0.5 and r["kept"] for r in free)
