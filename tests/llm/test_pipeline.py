import hashlib

import corpus_pipeline
from drumlin.llm import neardup, pii
from drumlin.llm.common import BATCH_ROWS, staged, table
from tests.llm.frames import docs

SF_DIR = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    frames = [table(spark, SF_DIR, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(staged(stage(spark, frames[-1], SF_DIR), f"test-{name}"))
    raw, known, single, clean, mixed, tokens = frames
    assert all(f.columns == raw.columns for f in frames[1:-1])
    assert known.where("lang is null").count() == 0
    # One of each class stays, and it is the one with the least id.
    classes = {r.doc_id: r.class_id for r in neardup.registered(known).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(classes.values()))
    assert clean.count() == single.count()
    for r in clean.collect():
        assert pii.base_spans(r.text or "") == [] and r.n_chars == len(r.text or "")
    assert 0 < mixed.count()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(corpus_pipeline.vocabulary())
    rows = tokens.collect()
    assert len(rows) == mixed.count()
    for r in rows:
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(r.doc_id for r in rows)


def test_edge_cases(spark):
    for frame in (docs(spark, extra=True), docs(spark, empty=True)):
        now = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = staged(stage(spark, now, SF_DIR), f"edge-{name}")
            assert now.columns == frame.columns
        corpus_pipeline.STAGES[-1][1](spark, now, SF_DIR).collect()


def test_a_core_has_one_worker_for_tokens(spark):
    """Ids are written before they are decoded, so no two workers hold the vocabulary for one task."""
    found = corpus_pipeline.tokens(spark, docs(spark), SF_DIR)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert 0 < int(spark.conf.get(BATCH_ROWS)) <= corpus_pipeline.BATCH
