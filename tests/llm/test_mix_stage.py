"""The pipeline's mix stage hands on as many words as its budget, also where it ends within a document."""

import corpus_pipeline


def test_mix_stage_cuts_the_last_document(spark, sf_dir):
    texts = {i: f" first{i}\n\tand é" + " word" * 98 for i in range(3)}
    rows = [(i, t, "en", "src0", len(t)) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    found = corpus_pipeline.mixed(spark, docs, sf_dir).collect()
    assert sum(len(r.text.split()) for r in found) == sum(len(t.split()) for t in texts.values()) * 60 // 100
    assert all(texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) for r in found)
    assert any(r.text == texts[r.doc_id] for r in found) and any(r.text != texts[r.doc_id] for r in found)
