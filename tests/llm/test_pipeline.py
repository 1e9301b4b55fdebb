from __future__ import annotations

import brute
import corpus_pipeline
from profitgrid.llm import bpe_codec, decontaminate, simhash, toxicity
from profitgrid.llm.common import stored


def test_each_stage_on_what_the_one_before_kept(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, small))
        kept[name] = before, docs
        assert docs.columns == columns or name == "bpe"

    ids = {name: ([r.doc_id for r in a.collect()], [r.doc_id for r in b.collect()]) for name, (a, b) in kept.items()}
    labels = spark.read.parquet(f"{small}/labels.parquet")
    verdict = toxicity.toxicity(kept["toxicity"][0], labels).where("predicted = 0").collect()
    assert sorted(ids["toxicity"][1]) == sorted(r.doc_id for r in verdict)
    assert sorted(ids["line_dedup"][0]) == sorted(ids["line_dedup"][1])
    assert all(r.n_chars == len(r.text) for r in kept["line_dedup"][1].collect())
    rows = kept["near_dedup"][0].collect()
    roots = brute.groups([brute.fingerprint(r.text) for r in rows])
    first = {}
    for r, root in zip(rows, roots, strict=True):
        first[root] = min(first.get(root, r.doc_id), r.doc_id)
    assert sorted(ids["near_dedup"][1]) == sorted(first.values())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    clean = [r.doc_id for r in kept["decontamination"][0].collect() if not brute.contaminated(r.text, items)[1]]
    assert sorted(ids["decontamination"][1]) == sorted(clean)
    texts = {r.doc_id: r.text for r in kept["bpe"][0].collect()}
    for r in kept["bpe"][1].collect():
        assert r.decoded_sha256 == brute.sha(texts[r.doc_id])
        assert r.ids_sha256 == brute.sha(bpe_codec.encode(texts[r.doc_id], bpe_codec.vocabulary()))


def test_stages_call_the_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None and simhash.DISTANCE == 3 and decontaminate.WINDOW == 10
