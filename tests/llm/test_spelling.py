import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from custlens.llm import spelling
from custlens.llm.registry import op13_spelling
from tests.conftest import SF001
from tests.llm.cases import SCHEMA, hard_docs, no_docs, same_rows

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def count(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 5}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(a[:i] + a[i + (len(a) == len(b)):] == b[:i] + b[i + 1:] for i in range(len(b)))


def edits(word):
    """What is left of a word without one of its letters."""
    return {(word[:i] + word[i + 1:], i) for i in range(len(word))}


def near_pairs(words):
    """Pairs one edit apart, by what is left of them without a letter."""
    left = {}
    for w in words:
        for rest in {r for r, _ in edits(w)} | {w}:
            left.setdefault(rest, set()).add(w)
    return {p for some in left.values() for p in combinations(sorted(some), 2) if near(*p)}


def plain(rows):
    n = count(rows)
    close = {w: set() for w in n}
    for a, b in near_pairs(n):
        close[a].add(b)
        close[b].add(a)
    form = {}
    for w, some in close.items():
        best = min(some, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None))
    return out


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_query_equals_plain(spark):
    got = op13_spelling(spark, SF001)
    assert got.columns == COLUMNS
    want = plain(rows_of(spark.read.parquet(f"{SF001}/documents.parquet")))
    assert len(want) > 1000 and any(w[1] for w in want)
    same_rows(got.collect(), want)


def test_all_near_words_of_few_letters(spark):
    # Few letters, many repeated grams: ties of rarity within and between words.
    r = random.Random(5)
    words = sorted({"".join(r.choice("abé") for _ in range(r.randint(6, 9))) for _ in range(1500)}
                   | {"a" * k for k in range(6, 12)} | {"ab" * k for k in range(3, 7)})
    got = spelling.near_words(spark.createDataFrame(list(enumerate(words)), "id long, word string")).collect()
    want = near_pairs(words)
    assert len(got) == len(want) and {tuple(x) for x in got} == want


def test_chains_of_forms(spark):
    n = {"abcdef": 20_000, "abcdeg": 3000, "abcdhg": 500, "abcihg": 80, "abjihg": 12, "akjihg": 5, "zzzzzz": 7}
    text = " ".join(w for w, k in n.items() for _ in range(k))
    docs = spark.createDataFrame([(1, text, "en", "s", 3)], SCHEMA)
    got = {r["word"]: r for r in spelling.group(docs).collect()}
    same_rows(got.values(), plain([(1, text)]))
    assert got["abjihg"]["root"] == "abcdef" and got["zzzzzz"]["root"] == "zzzzzz"


def test_damage_of_joined_checksums():
    r = np.random.default_rng(1)
    fronts, ends = ([bytes(r.integers(0, 256, n)) for n in r.integers(0, 40, 50)] for _ in range(2))
    got = spelling.joined_crc(*(np.array([zlib.crc32(x) for x in xs], np.uint32) for xs in (fronts, ends)),
                              np.array([len(x) for x in ends]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(fronts, ends, strict=True)]


def test_pivots_are_the_rarest_disjoint_pair():
    r = np.random.default_rng(2)
    words = ["".join(r.choice(list("abcde"), n)) for n in r.integers(6, 15, 300)]
    count = np.zeros(1 << 16, np.int64)
    for w in words:
        for a, b in zip(w, w[1:], strict=False):
            count[ord(a) * 256 + ord(b)] += 1
    for rows, _, (row, place, _), (p_row, p_place, _) in spelling.word_keys(pa.array(words), count):
        for k, w in enumerate(rows.tolist()):
            inside = place[row == k].tolist()
            cost = {i: count[ord(words[w][i]) * 256 + ord(words[w][i + 1])] for i in inside}
            best = min(cost[i] + cost[j] for i, j in combinations(inside, 2) if j - i >= 2)
            i, j = p_place[p_row == k].tolist()
            assert j - i >= 2 and cost[i] + cost[j] == best


def test_hard_cases(spark):
    long = "ab" * 1_000 + "c"
    more = spark.createDataFrame([(20, " ".join([long, "d" + long] * 6), "en", "a", 1),
                                  (21, "ÀÉÿ×÷Àa ÀÉÿ×÷Àb ÀÉÿ×÷Ab " * 9, None, None, None),
                                  (None, "Missing misssing missing " * 30, "en", "a", 1)], SCHEMA)
    docs = hard_docs(spark, False).unionByName(more).withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    same_rows(spelling.group(docs).collect(), plain(rows_of(docs)))
    for column in ("doc_id", "text"):
        some = docs.withColumn(column, F.lit(None).cast("long" if column == "doc_id" else "string"))
        same_rows(spelling.group(some).collect(), plain(rows_of(some)))
    got = spelling.group(no_docs(spark))
    assert not got.collect() and got.columns == COLUMNS
