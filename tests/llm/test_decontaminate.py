import random

from pyspark.sql import functions as F

from custlens.llm import decontaminate as D
from tests.llm.cases import hard_docs, hard_rows, no_docs, prose

ITEMS = [(1, prose(40, 100)), (2, prose(9, 101)), (3, None), (4, ""), (None, prose(30, 102)), (5, prose(3, 103)),
         (6, prose(60, 104)), (6, prose(60, 105))]


def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit(7))


def spoil(text, every, seed=0):
    r = random.Random(seed)
    w = text.split()
    for i in range(3, len(w), every):
        w[i] = f"sub{r.random()}"
    return " ".join(w)


def planted():
    inside = lambda x, k: prose(200, 200 + k) + "\n" + x + " " + prose(100, 300 + k)
    whole = ITEMS[0][1]
    return [(1, inside(whole, 1)), (2, inside(whole.upper().replace(" ", ",  "), 2)), (3, inside(spoil(whole, 6), 3)),
            (4, inside(" ".join(whole.split()[10:26]), 4)), (5, inside(ITEMS[1][1], 5)), (6, inside(ITEMS[4][1], 6)),
            (7, inside(spoil(ITEMS[6][1], 7) + " x " + ITEMS[7][1], 7)), (8, prose(400, 400)),
            (9, inside(" ".join(whole.split()[:8]), 9)), (10, inside(spoil(whole, 2), 10)), (11, ITEMS[0][1])]


def test_planted_passages_are_found_and_clean_texts_are_not(spark):
    docs = spark.createDataFrame(planted(), "doc_id long, text string")
    got = D.find(docs, bench(spark)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {
        (1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, None), (7, 6), (11, 1)}
    (one,) = [r for r in got if r["doc_id"] == 3]
    assert one["n_compared"] > one["n_equal"] >= 30
    (one,) = [r for r in got if r["doc_id"] == 4]
    assert (one["n_equal"], one["doc_start"], one["item_start"], one["item_tokens"]) == (16, 200, 10, 40)
    assert sorted(r["doc_id"] for r in D.clean(docs, bench(spark)).collect()) == [8, 9, 10]


def test_every_stretch_of_whole_items_in_the_documents(spark):
    d = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r["item_id"]: " ".join(r["text"].split()) for r in items.collect()}
    want = {(r["doc_id"], i) for r in docs.collect() for i, t in texts.items() if t in " ".join((r["text"] or "").split())}
    assert want and want <= {(r["doc_id"], r["item_id"]) for r in D.find(docs, items).collect()}


def test_benchmark_in_blocks_gives_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(planted(), "doc_id long, text string")
    whole = {tuple(r) for r in D.find(docs, bench(spark)).collect()}
    monkeypatch.setattr(D, "BLOCK_TOKENS", 100)
    assert len(D.seed_tables(bench(spark))) > 2
    assert {tuple(r) for r in D.find(docs, bench(spark)).collect()} == whole


def brute(doc, item):
    """The most equal tokens of any stretch that meets the rule, on any diagonal."""
    doc, item = doc.split(), item.split()
    least, most = max(6, min(13, -(-3 * len(item) // 4))), 0
    for shift in range(-len(item), len(doc)):
        same = [doc[k + shift] == w for k, w in enumerate(item) if 0 <= k + shift < len(doc)]
        for x in range(len(same)):
            for y in range(x + 1, len(same) + 1):
                equal = sum(same[x:y])
                if equal >= least and 3 * (y - x - equal) <= equal:
                    most = max(most, equal)
    return most


def test_every_stretch_that_meets_the_rule_is_found():
    import pyarrow as pa

    def words(marks, k):
        # A token of the item where the mark is 1, another one elsewhere.
        return (" ".join(f"w{k}i{j}" for j in range(len(marks))),
                "ahead " * 3 + " ".join(f"w{k}i{j}" if m == "1" else f"x{k}i{j}" for j, m in enumerate(marks)) + " after" * 3)

    r = random.Random(5)
    marks = ["1" * 10 + "0" * 4 + "1" * 10, "1" + "0" + "1" * 10 + "0" + "1", "1" * 6, "11011011", "1" * 5, "1110" * 5,
             "1011101110111" * 2, "111011" * 3]
    marks += ["".join(r.choice("1110") for _ in range(r.randint(6, 40))) for _ in range(150)]
    made = [words(m, k) for k, m in enumerate(marks)]
    table = D.SeedTable.build(list(range(len(made))), pa.array([i for i, _ in made]))
    got = {(row, item) for row, item, *_ in D.overlaps(pa.array([d for _, d in made]), table)}
    assert got == {(k, k) for k, (i, d) in enumerate(made) if brute(d, i)}
    assert {(k, k) for k in (0, 1, 2, 3, 5)} <= got and (4, 4) not in got


def test_hard_cases(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find(hard_docs(spark), none).collect() == []
    assert D.find(no_docs(spark), bench(spark)).collect() == []
    out = D.clean(hard_docs(spark), bench(spark))
    assert out.columns == hard_docs(spark).columns and out.count() == len(hard_rows())
    assert D.clean(no_docs(spark), bench(spark)).collect() == []
