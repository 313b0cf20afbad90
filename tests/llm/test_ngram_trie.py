"""The trie and the scores against a plain trigram model."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from custlens.llm import ngram_trie as L
from tests.llm.cases import hard_docs, hard_rows, no_docs, words


def plain(rows):
    """(doc_id, held out, tokens, known, N, base, score) of each row by dictionaries."""
    toks = [[*words(t, lower=True), None] for _, t in rows]
    held = [zlib.crc32(str(d).encode() if d is not None else b"") % 5 == 1 for d, _ in rows]
    one, two, three, ctx2, ctx3 = Counter(), Counter(), Counter(), Counter(), Counter()
    for w, h in zip(toks, held, strict=True):
        if not h:
            p = [0, 0, *w]
            for i in range(2, len(p)):
                a, b, c = p[i - 2:i + 1]
                one[c] += 1
                two[b, c] += 1
                three[a, b, c] += 1
                ctx2[b] += 1
                ctx3[a, b] += 1
    n, v = sum(one.values()), len(one)
    z = n + 0.5 * (v + 1)
    for (doc, _), w, h in zip(rows, toks, held, strict=True):
        p, base, score = [0, 0, *w], 0.0, 0.0
        for i in range(2, len(p)):
            a, b, c = p[i - 2:i + 1]
            p1 = (one[c] + 0.5) / z
            p2 = (two[b, c] + L.STRENGTH_2 * p1) / (ctx2[b] + L.STRENGTH_2)
            p3 = (three[a, b, c] + L.STRENGTH_3 * p2) / (ctx3[a, b] + L.STRENGTH_3)
            base, score = base + math.log10(p1), score + math.log10(p3)
        yield doc, h, len(w), sum(one[c] > 0 for c in w), n, base, score


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted(map(tuple, L.score(df).collect()), key=key)
    want = sorted(plain(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5])
        assert abs(g[6] - w[6]) <= 2.5 * L.STEP * g[2]


def test_hard_cases_and_empty_table(spark):
    check(hard_docs(spark))
    assert L.score(no_docs(spark)).collect() == []
    assert len(hard_rows()) == L.score(hard_docs(spark)).count()


def test_documents_and_held_out_gain(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    # The number of shards is the driver's choice; results don't depend on it.
    monkeypatch.setattr(L, "SHARD_TOKENS", 40_000)
    check(docs)
    # Nor do they on the number of a word's classes: here up to 50 of them.
    monkeypatch.setattr(L, "CLASS_TOKENS", 200)
    monkeypatch.setattr(L, "SHARDS_A_GROUP", 2)
    check(docs)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("custlens_slices_")]
    held = L.score(docs).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > held["sum(base_score)"]


def test_trie_levels_hold_a_proper_model():
    rng = np.random.default_rng(1)
    n = 4000
    words_ = np.sort(rng.choice(10**6, 60, replace=False)).astype(np.uint64)
    node, c, a = (rng.integers(0, k, n) for k in (7, 60, 60))
    unigram = np.bincount(c, minlength=60) + 0.5
    unigram = unigram / unigram.sum()
    trie = L.Trie(L.build_trie(words_, unigram, node, c, a, 30.0, 3.0))
    every = np.arange(60)
    log1 = np.log10(unigram)
    for k, w in [(0, 0), (3, 17), (6, 59), (2, -1), (99, 5)]:
        p = 10 ** trie.log10(np.full(60, k), every, np.full(60, w), log1)
        assert p.sum() == pytest.approx(1, abs=2e-3)


def test_frequent_words_fall_into_classes():
    count = np.array([1, L.CLASS_TOKENS - 1, L.CLASS_TOKENS, 5 * L.CLASS_TOKENS])
    assert L._classes(count).tolist() == [1, 1, 2, 6]
    a = np.arange(1000, dtype=np.uint64)
    kinds = L._node(a, np.full(1000, 4, np.uint64), a)
    assert set(kinds.tolist()) == {0, 1, 2, 3}


def test_pairs_of_any_numbers():
    b, c, n = (np.array(x) for x in ([7, 3, 7, 3], [1, 2, 1, 9], [1, 2, 3, 4]))
    for up in (0, 1 << 40):
        got = L._pair_keys(b + up, c + up, n)
        assert [x.tolist() for x in got] == [[3 + up, 3 + up, 7 + up], [2 + up, 9 + up, 1 + up], [2, 4, 4], [2, 0, 2, 1]]
