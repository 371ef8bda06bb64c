"""The pipeline, stage by stage, against what brute force says should stay."""

import re

import fixtures as fx
import oracle
import test_queries as tq

import corpus_pipeline
from folioflow import session
from folioflow.session import materialize


def test_stages(spark):
    docs = fx.table(spark, "documents")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, oracle.SF_DIR), name)
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(docs.columns) >= set(columns) and docs.count() == len(kept[name])
    assert len(kept["language_id"]) > 0.99 * len(before)
    best = {}
    for d, t in kept["language_id"].items():
        key = re.sub("[\x20\x09-\x0D]", "", t or "")
        best[key] = min(best.get(key, (1, 0)), (-len(t or ""), d))
    assert set(kept["exact_dedup"]) == {d for _, d in best.values()}
    root = tq.components(tq.links_of({d: fx.shingle_set(t) for d, t in kept["exact_dedup"].items()}))
    assert set(kept["ngram_jaccard_join"]) == {d for d in root if root[d] == d}
    items = [s for r in fx.table(spark, "benchmark").collect() if (s := fx.shingle_set(r["text"]))]
    leaks = {d for d, t in kept["ngram_jaccard_join"].items() for own in [fx.shingle_set(t)] if any(len(s & own) >= 0.8 * len(s) for s in items)}
    assert leaks and set(kept["benchmark_decontamination"]) == set(kept["ngram_jaccard_join"]) - leaks
    assert set(kept["source_mixing"]) == set(kept["benchmark_decontamination"])


def test_run_leaves_its_result_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_base", lambda spark: str(tmp_path))
    rows = corpus_pipeline.run(spark, oracle.SF_DIR)
    assert [p.name.rpartition("-")[0] for p in tmp_path.iterdir() if p.name[0] != "."] == ["pipeline-source_mixing"]
    assert rows.count() > 0 and {"mix_slot", "mix_seq"} <= set(rows.columns)


def test_odd_documents(spark):
    docs = fx.documents(spark, clash=False)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, oracle.SF_DIR).count() <= docs.count()
        assert stage(spark, fx.empty(spark), oracle.SF_DIR).count() == 0
    assert corpus_pipeline.mix_sources(spark, docs, oracle.SF_DIR).count() == docs.count()
