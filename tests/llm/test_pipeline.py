"""The pipeline against its operators applied one by one, and the registry."""
import corpus_pipeline
from custlens.llm import decontaminate, quality_rules, secret_scan
from custlens.llm.registry import ORACLE, QUERIES
from tests.llm.cases import hard_docs, no_docs
from tests.llm.test_jaccard_join import brute
from tests.llm.test_tokens import ids_of

SF = "/root/testdata/sf0.001"


def test_stages_are_as_ordered():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "jaccard_join", "decontamination", "secret_scan", "packing"]
    assert [k.split("_")[0] for k in QUERIES] == [f"op{i}" for i in range(1, 14)] and set(ORACLE) <= set(QUERIES)


def test_run_packs_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r["doc_id"] for r in quality_rules.assess(docs, quality_rules.trusted_ids(labels)).where("kept").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in kept]
    firsts = {doc for doc, _, component in brute(rows) if doc == component}
    bad = {r["doc_id"] for r in decontaminate.find(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    want = {}
    for doc, text in rows:
        if doc in firsts - bad:
            parts, end = [], 0
            for a, _, b in secret_scan.find_spans(text):
                if a >= end:
                    parts += [text[end:a], "[SECRET]"]
                end = max(end, b)
            want[doc] = len(ids_of("word_bpe_49k.json", "".join([*parts, text[end:]]), 2))
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        assert r["doc_tokens"] == want[r["doc_id"]]
    assert got == want and 0 < len(want) < docs.count()


def test_stages_take_hard_and_empty_tables(spark):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (hard_docs(spark), no_docs(spark)):
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.columns == docs.columns
            out.collect()
