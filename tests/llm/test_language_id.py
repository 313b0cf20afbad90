import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from custlens.llm import language_id as li
from custlens.llm.registry import op12_language_id
from tests.conftest import SF001
from tests.llm.cases import hard_docs, hard_rows, no_docs

PIECES = (li.MARK, "a", "b", "ab", "ba", li.MARK + "a", "aba", li.MARK + "ab")


def cuts(word):
    """All segmentations of a marked word into pieces; other characters are number n."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        head = word[:k]
        number = PIECES.index(head) if head in PIECES else len(PIECES) if k == 1 else None
        if number is not None:
            yield from ([number, *rest] for rest in cuts(word[k:]))


@pytest.fixture
def table():
    p = np.random.default_rng(3).random((len(PIECES) + 1, 2))
    return p / p.sum(0)


WORDS = ["a", "b", "ab", "abab", "babba", "abxab", "aaaaaaa", "é"]


def test_sum_over_all_segmentations(table):
    got = li.word_scores(pa.array(WORDS), li.Pieces(PIECES), table)
    want = [[math.log(sum(math.prod(table[i, k] for i in c) for c in cuts(li.MARK + w))) for k in (0, 1)]
            for w in WORDS]
    assert np.allclose(got, want)


def test_expected_uses(table):
    lang, n = np.arange(len(WORDS)) % 2, np.arange(len(WORDS)) + 1.0
    got = sum(li.expected_uses(points, lang[at], n[at], li.Pieces(PIECES), table)
              for at, points in li.by_length(pa.array(WORDS)))
    want = np.zeros(table.shape)
    for w, k, c in zip(WORDS, lang, n, strict=True):
        all_cuts = [(math.prod(table[i, k] for i in x), x) for x in cuts(li.MARK + w)]
        for weight, x in all_cuts:
            for i in x:
                want[i, k] += c * weight / sum(v for v, _ in all_cuts)
    assert np.allclose(got, want)


def test_long_words_do_not_vanish(table):
    small = table * 1e-7
    word = pa.array(["ab" * 2000])
    got = li.word_scores(word, li.Pieces(PIECES), small)
    # A plain forward pass in logarithms.
    text = li.MARK + "ab" * 2000
    sums = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        sums[end] = np.logaddexp.reduce([sums[s] + math.log(small[PIECES.index(text[s:end]), 0])
                                         for s in range(max(0, end - 3), end) if text[s:end] in PIECES])
    assert np.isclose(got[0, 0], sums[-1])
    (at, points), = li.by_length(word)
    uses = li.expected_uses(points, np.zeros(1, int), np.ones(1), li.Pieces(PIECES), small)
    length = np.array([len(x) for x in PIECES] + [1])
    assert np.isclose((uses[:, 0] * length).sum(), len(text))


def test_learning_raises_the_likelihood(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("doc_id < 200").select("text", "lang")
    words = defaultdict(Counter)
    for text, lang in docs.collect():
        w, code, _ = li.letter_words(pa.array([text]))
        words[lang].update(w.take(pa.array(code)).to_pylist())

    def likelihood(model):
        total = 0.0
        for k, lang in enumerate(model.langs):
            scores = li.word_scores(pa.array(list(words[lang])), li.Pieces(model.pieces), model.p)[:, k]
            total += (scores * np.array(list(words[lang].values()))).sum()
        return total

    models = [li.learn(docs, rounds=r) for r in (0, 1, 3)]
    assert [*models[0].langs] == sorted(words)
    assert likelihood(models[0]) < likelihood(models[1]) < likelihood(models[2])
    assert np.allclose(models[2].p.sum(0), 1, atol=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = op12_language_id(spark, SF001)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = got.collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_only_the_text_counts(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("doc_id < 300")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    other = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))).withColumn(
        "source", F.lit(None).cast("string"))
    a, b = ({r["doc_id"]: (r["lang_pred"], round(r["score"], 9)) for r in li.identify(d).collect()}
            for d in (docs, other))
    assert a == b


def test_hard_cases(spark):
    docs = hard_docs(spark)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["lang_pred"]) for r in li.identify(docs).collect())
    assert len(got) == len(hard_rows())
    by_id = {d: lang for none, d, lang in got if not none}
    assert by_id[4] == by_id[5] == by_id[6] == li.UNKNOWN
    assert by_id[1] in ("en", "x") and by_id[7] != li.UNKNOWN
    assert sum(none for none, _, _ in got) == 2
    for column in ("doc_id", "text", "lang", "source"):
        kind = "long" if column == "doc_id" else "string"
        rows = li.identify(docs.withColumn(column, F.lit(None).cast(kind))).collect()
        assert len(rows) == len(hard_rows())
        if column in ("text", "lang"):
            assert {(r["lang_pred"], r["score"]) for r in rows} == {(li.UNKNOWN, 0.0)}
    assert not li.identify(no_docs(spark)).collect()
