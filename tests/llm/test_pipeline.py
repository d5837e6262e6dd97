from test_set_join import brute as near_classes

import corpus_pipeline
from sheafline.llm import common, decontamination, toxicity

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark):
    docs = common.documents(spark, SMALL)
    before = {r.doc_id: r.text or "" for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact", "near", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        kept_docs = common.stage(stage(spark, docs, SMALL), "test")
        if name == "packing":
            assert {r.doc_id for r in kept_docs.collect()} == set(before)
            break
        assert kept_docs.columns == columns
        kept = {r.doc_id: r.text or "" for r in kept_docs.collect()}
        assert all(before[i] == t for i, t in kept.items())
        if name == "toxicity":
            labels = common.read(spark, SMALL, "labels")
            scored = toxicity.score(docs, toxicity.learning_rows(docs, labels)).collect()
            assert set(kept) == {r.doc_id for r in scored if r.score < toxicity.REJECT}
        elif name == "exact":
            last = {t: max(i for i, x in before.items() if x == t) for t in before.values()}
            assert kept == {i: t for t, i in last.items()}
        elif name == "near":
            assert set(kept) == {i for i, _, c in near_classes(list(before.items())) if i == c}
        else:
            items = [decontamination.word_ids(r.text) for r in common.read(spark, SMALL, "benchmark").collect()]
            for i, text in before.items():
                ids = decontamination.word_ids(text)
                best = max(decontamination.smith_waterman(w, ids)[0] / (2 * len(w)) for w in items if len(w))
                assert (i in kept) == (best < decontamination.THRESHOLD)
        docs, before = kept_docs, kept
