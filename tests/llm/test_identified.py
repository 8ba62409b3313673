"""The pipeline's language stage labels words before it judges a document."""

from dataclasses import replace

import numpy as np

from pitfeat.llm import langid


def test_evidence_counts_in_the_identified_language(docs):
    """Features met in the fit, but in another language than the field gives the words, identify nothing."""
    model = langid.learn(docs)
    some = docs.where("lang = 'en' and n_chars > 300").orderBy("doc_id").limit(30)
    texts = [r["text"] for r in some.collect()]
    langs, evidence = model.identify(texts)
    assert langs == [x[0] for x in model.label(texts)] and evidence.min() > 0.95
    elsewhere = np.broadcast_to(np.array(model.langs) != "en", model.met.shape).copy()
    other = replace(model, met=elsewhere, cache={})
    assert other.identify(texts)[0] == langs == ["en"] * 30 and other.identify(texts)[1].max() < 0.3
    assert langid.keep_identified(some, model).count() == 30 and langid.keep_identified(some, other).count() == 0
    assert model.identify([None, "", "123 ---"])[0] == ["und"] * 3
