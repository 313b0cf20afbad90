"""The join against comparing every pair of sets, and its parts against their guarantees."""
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from custlens.llm import jaccard_join as J
from custlens.llm.components import components
from tests.llm.cases import SCHEMA, hard_docs, hard_rows, no_docs, prose, same_rows, words


def sets_of(rows):
    out = []
    for doc, text in rows:
        w = words(text, lower=True)
        s = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        out.append((doc, frozenset(s)))
    return out


def brute(rows):
    """(doc_id, set size, component) of each row, by inverted lists over all rows."""
    sets = sets_of(rows)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    lists = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        shared = Counter(j for x in s for j in lists[x])
        for j, k in shared.items():
            if 100 * k >= 75 * (len(s) + len(sets[j][1]) - k):
                parent[find(i)] = find(j)
        for x in s:
            lists[x].append(i)
    least = {}
    for i, (doc, _) in enumerate(sets):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return Counter((doc, len(s), least.get(find(i)) if s else doc) for i, (doc, s) in enumerate(sets))


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = J.join(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_hard_cases_and_empty_table(spark):
    check(hard_docs(spark))
    assert J.join(no_docs(spark)).collect() == []


def test_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(3)
    for n in [*range(3, 40), 60, 120, 300, 700]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            b = a
            # Swap and drop tokens as far as the similarity allows.
            while True:
                c = b.copy()
                if rng.random() < 0.5 and len(c) > 1:
                    c = np.delete(c, rng.integers(len(c)))
                else:
                    c = np.unique(np.append(c, rng.integers(0, 2**63, 1).astype(np.uint64)))
                same = len(np.intersect1d(a, c))
                if 4 * same < 3 * (len(a) + len(c) - same):
                    break
                b = c
            edges = J.band_edges(max(len(a), len(b)))
            common = set(J._tables_of(len(a), edges)) & set(J._tables_of(len(b), edges))
            k = min(int(np.searchsorted(edges, len(x), side="right")) - 1 for x in (a, b))
            assert k in common
            h = J.most_different(edges, k)
            assert len(a) + len(b) - 2 * len(np.intersect1d(a, b)) <= h
            m = J.segment_count(h)
            scarce = {}
            for t in range(1, J.MOST_LEAST + 1):
                few = []
                for x in (a, b):
                    _, _, have, at, _ = J._segments(x, k, m)
                    size = np.diff(np.concatenate([at, [len(x)]]))
                    few.append(m - int((size >= t).sum()))
                scarce[t] = max(few)
            cost = {(int(i), lvl): float(rng.random()) for i in range(m) for lvl in (0, 1)}
            level, least = J.allot(h, m, scarce, cost)
            assert len(np.intersect1d(J.keys(a, k, m, level, least), J.keys(b, k, m, level, least)))


def test_links_span_components_of_a_group():
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 2**62, 80).astype(np.uint64)) for _ in range(3)]
    sets = [np.unique(np.concatenate([np.delete(b, rng.integers(0, 80, 8)), rng.integers(0, 2**62, 5).astype(np.uint64)]))
            for b in base for _ in range(20)]
    want = {(i, j) for i in range(60) for j in range(i)
            if 4 * (s := len(np.intersect1d(sets[i], sets[j]))) >= 3 * (len(sets[i]) + len(sets[j]) - s)}
    got = J.links(sets)
    assert {(max(p), min(p)) for p in got} <= want

    def comps(edges):
        parent = list(range(60))
        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in edges:
            parent[max(find(a), find(b))] = min(find(a), find(b))
        return [find(x) for x in range(60)]
    assert comps(got) == comps(want) and len(got) < 60


def test_large_groups_are_verified_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "GROUP_TOKENS", 300)
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_components(spark):
    rows = [(1, 2), (2, 3), (9, 3), (5, 5), (7, 6), (6, 7), (20, 21), (22, 21), (22, 23), (23, 40), (1, 2)]
    got = components(spark.createDataFrame(rows, "u long, v long")).collect()
    assert {(r["node"], r["component"]) for r in got} == {
        (1, 1), (2, 1), (3, 1), (9, 1), (6, 6), (7, 6), (20, 20), (21, 20), (22, 20), (23, 20), (40, 20)}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_one_of_each_group_stays(spark):
    docs = hard_docs(spark).where(F.col("doc_id").isNotNull())
    out = J.keep_one(docs)
    assert out.columns == docs.columns
    # 2 and 3 are copies of 1, which is there twice; 9 has the words of 8.
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(
        {r[0] for r in hard_rows() if r[0] is not None} - {2, 3, 9})


def test_an_id_with_two_texts(spark):
    one, other = prose(200, 31), prose(200, 32)
    near = one.replace(one.split()[100], "zzz", 1)
    rows = [(3, one), (5, near), (5, other), (None, near), (None, prose(90, 33)), (8, ""), (8, None), (7, other)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA).withColumn("row_key", F.lit("mine"))
    out = J.keep_one(docs)
    assert out.columns == docs.columns
    same_rows([(r["doc_id"], r["text"]) for r in out.collect()], [(3, one), (5, other), (None, prose(90, 33)), (8, ""), (8, None)])


@pytest.mark.parametrize("top", [1, 7, 100, 5000])
def test_partners_are_in_neighbouring_bands(top):
    edges = J.band_edges(top)
    for n in range(1, top + 1):
        band = np.searchsorted(edges, n, side="right")
        most = np.searchsorted(edges, n * 4 // 3, side="right")
        assert most - band <= 1
