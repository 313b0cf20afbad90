"""Quality rules against a plain count of every text, and of the ratios by hash buckets."""
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from custlens.llm import quality_rules as Q
from tests.llm.cases import hard_docs, hard_rows, no_docs, words


def base(text):
    text = text or ""
    w = words(text)
    win = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if win[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if words(x)]
    n = len(w)
    return (n, sum(map(len, w)), sum(c in Q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def trusted(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "doc_id long")


def test_base_counts(spark):
    got = Q.assess(hard_docs(spark), trusted(spark, [1, 7, 7, None])).collect()
    want = Counter((r[0], *base(r[1])) for r in hard_rows())
    assert Counter((r["doc_id"], *[r[c] for c in COLS]) for r in got) == want
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_ratios_and_scores_match_a_plain_count(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ids = Q.trusted_ids(spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    good = {r[0] for r in ids.collect()}
    rows = docs.select("doc_id", "text", Q.words_of(F.col("text")).alias("w")).collect()
    apart = docs.select("doc_id", F.posexplode(Q.words_of(F.col("text"))).alias("i", "w")).select(
        "doc_id", "i", F.xxhash64("w").alias("h"))
    nxt = apart.select("doc_id", (F.col("i") - 1).alias("i"), F.col("h").alias("h2"))
    pairs = apart.join(nxt, ["doc_id", "i"], "left").select(
        "doc_id", F.pmod("h", F.lit(Q.BUCKETS)).alias("one"),
        F.when(F.col("h2").isNotNull(), F.pmod(F.xxhash64("h", "h2"), F.lit(Q.BUCKETS))).alias("two")).collect()
    grams = {}
    for r in pairs:
        grams.setdefault(r["doc_id"], []).extend(x for x in (r["one"], r["two"]) if x is not None)
    rows = [{"doc_id": r["doc_id"], "text": r["text"], "g": grams.get(r["doc_id"])} for r in rows]
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(r["g"] or [])
        if r["doc_id"] in good:
            target.update(r["g"] or [])
    share = sum(raw.values()) / sum(target.values())
    w = [math.log((target[b] * share + Q.SMOOTHING) / (raw[b] + Q.SMOOTHING)) for b in range(Q.BUCKETS)]
    assert Q.log_ratios(docs, ids) == pytest.approx(w)
    got = {r["doc_id"]: r for r in Q.assess(docs, ids).collect()}
    for r in rows:
        n = len(words(r["text"]))
        assert len(r["g"] or []) == max(0, 2 * n - 1)
        llr = sum(w[b] for b in r["g"] or []) / max(1, 2 * n - 1)
        g = got[r["doc_id"]]
        assert g["llr"] == pytest.approx(llr, abs=1e-6)
        assert g["kept"] == (not g["base_failed"] and g["llr"] >= Q.THRESHOLD)


def test_rejects_junk_and_keeps_prose(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.assess(docs, Q.trusted_ids(labels)).join(labels, "doc_id").where("not base_failed")
    n = {(r["quality"], r["kept"]): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.01 * n[1, True]
    assert n.get((0, True), 0) <= 0.1 * n[0, False]


def test_keep_returns_whole_rows(spark):
    docs = hard_docs(spark)
    ids = trusted(spark, [1])
    kept = Q.keep(docs, ids)
    assert kept.columns == docs.columns
    want = Counter(r["doc_id"] for r in Q.assess(docs, ids).where("kept").collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == want
    assert all(r["kept"] == "clash" for r in kept.collect())


def test_empty_and_untrusted(spark):
    assert Q.assess(no_docs(spark), trusted(spark, [1])).collect() == []
    assert Q.keep(no_docs(spark), trusted(spark, [])).collect() == []
    assert all(r["llr"] == 0 for r in Q.assess(hard_docs(spark), trusted(spark, [])).collect())
