import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from custlens.llm import source_audit as sa
from tests.conftest import SF0001
from tests.llm.cases import SCHEMA, hard_docs, no_docs, same_rows
from tests.oracle_compare import compare, duck


def plain(rows, least):
    """Every term priced for every pair, in whole numbers."""
    docs = [tuple(x or "" for x in r) for r in rows]
    count, seen = defaultdict(Counter), defaultdict(Counter)
    groups = sorted({(lang, source) for _, lang, source in docs})
    for text, lang, source in docs:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        count[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in seen[lang].items() if n >= least]
        own = [g for g in groups if g[0] == lang]
        size = {g: sum(count[g][t] for t in kept) for g in own}
        whole = Counter({t: sum(count[g][t] for g in own) for t in kept})
        p = {g: {t: 1 + 10 ** 9 * (count[g][t] + 5) // (size[g] + 5 * len(kept)) for t in kept} for g in own}
        q = {t: 1 + 10 ** 9 * (whole[t] + 5) // (sum(size.values()) + 5 * len(kept)) for t in kept}
        me = lang, source
        pair = [(g[1], sum(abs(p[me][t] - p[g][t]) for t in kept)) for g in own if g != me]
        term = [(t, p[me][t] - q[t]) for t in kept if count[me][t] and p[me][t] > q[t]]
        for part, items in (("pair", pair), ("term", term)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, v, k + 1) for k, (item, v) in enumerate(items)
                    if part == "pair" or k < 50]
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("text", "lang", "source").collect()]


def test_equals_sql(spark):
    got = compare(spark, duck(SF0001), lambda s, d: sa.audit(s.read.parquet(f"{d}/documents.parquet")), sa.SQL, SF0001)
    assert got["cols_match"] and got["values_match"] and got["spark_rows"], got


@pytest.mark.parametrize("least,chunk,band", [(3, 40, 2), (3, 4096, 256), (10 ** 6, 40, 2)])
def test_equals_plain_in_any_blocks(spark, least, chunk, band):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").where("doc_id < 90").withColumn(
        "source", F.concat(F.lit("é"), F.col("doc_id") % 7))
    same_rows(sa.audit(docs, least, chunk, band).collect(), plain(rows_of(docs), least))


def test_hard_cases(spark):
    docs = hard_docs(spark)
    for least in (1, 2):
        same_rows(sa.audit(docs, least, 10, 1).collect(), plain(rows_of(docs), least))
    for column in ("text", "lang", "source"):
        some = docs.withColumn(column, F.lit(None).cast("string"))
        same_rows(sa.audit(some, 1).collect(), plain(rows_of(some), 1))
    got = sa.audit(no_docs(spark))
    assert not got.collect()
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    one = spark.createDataFrame([(1, "a b", "x", "s", 3)] * 40, SCHEMA)
    assert not sa.audit(one).where("part = 'pair'").collect()


def test_products_equal_sums():
    r = np.random.default_rng(7)
    a, b = r.poisson(2, (90, 5)) * r.integers(0, 40, (90, 1)), r.poisson(1, (90, 4))
    sizes_a, sizes_b = a.sum(0).tolist(), b.sum(0).tolist()

    def price(c, n):
        return 1 + 10 ** 9 * (c + 5) // (n + 5 * 90)

    want = [[sum(abs(price(int(x), n) - price(int(y), m)) for x, y in zip(a[:, i], b[:, j], strict=True))
             for j, m in enumerate(sizes_b)] for i, n in enumerate(sizes_a)]
    got = sa.distances(a.astype(np.int64), b.astype(np.int64), sizes_a, sizes_b, 90, n_terms=16, n_sources=2)
    assert got.tolist() == want
    own = sa.distances(a.astype(np.int64), None, sizes_a, sizes_a, 90, n_terms=16, n_sources=2)
    full = sa.distances(a.astype(np.int64), a.astype(np.int64), sizes_a, sizes_a, 90)
    assert (np.triu(own, 1) == np.triu(full, 1)).all()
