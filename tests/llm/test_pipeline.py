"""The pipeline, and the columns that registered queries must have."""

import corpus_pipeline
import numpy as np

from tidemark.llm import decontamination
from tidemark.llm.queries import QUERIES
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.simhash import simhash_components

SF_DIR = "/root/testdata/sf0.001"


def test_stages_filter_and_keep_columns(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        kept = {r["doc_id"] for r in out.select("doc_id").collect()}
        if name == "quality rules":
            good = quality_rules(docs).filter("kept").collect()
            assert kept == {r["doc_id"] for r in good}
        if name == "SimHash near-dedup":
            groups = simhash_components(docs).collect()
            assert kept == {r["component_id"] for r in groups}
        if name == "PII":
            assert len(kept) == docs.count()
        docs = spark.createDataFrame(out.collect(), docs.schema)


def test_odd_rows_pass_every_stage(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
    kept = corpus_pipeline.near_dedup(spark, odd, SF_DIR).select("doc_id").collect()
    assert sorted(r[0] for r in kept if r[0]) == [1, 4, 5, 6, 7]


def test_leaks_are_sought_by_all_passages(spark, make, monkeypatch):
    """Some 25,000 passages: every pass over the latent space takes all of them."""
    texts = [" ".join(f"w{(i * k) % 997}" for i in range(25_600)) for k in range(1, 33)]
    passes = []
    run = decontamination.gram_times

    def multiply(rows, *rest):
        known = [decontamination.numbers_of(r["numbers"]) for r in rows.collect()]
        sizes = np.array([len(k) for k in known])
        passes.append(int(decontamination.passage_numbers(sizes, decontamination.Retrieval()).sum()))
        return run(rows, *rest)

    monkeypatch.setattr(decontamination, "gram_times", multiply)
    docs = make(*texts)
    assert corpus_pipeline.decontaminate(spark, docs, SF_DIR).columns == docs.columns
    assert passes == [32 * 799] * 3


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_run_gives_the_mix(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
