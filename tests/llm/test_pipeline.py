"""The pipeline's stages against plain versions, each on its own input."""

import zlib
from collections import Counter

import brute
import corpus_pipeline
import numpy as np

from pitfeat.session import materialize

SF = "/root/testdata/sf0.01"


def rows(df):
    return Counter((r["doc_id"], zlib.crc32((r["text"] or "").encode())) for r in df.select("doc_id", "text").collect())


def test_stages(spark, docs):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    now, results = docs, [docs]
    for name, stage in corpus_pipeline.STAGES:
        now = materialize(stage(spark, now, SF), name="test-stage")
        if name != "packing":
            assert now.columns == docs.columns
        results.append(now)
    start, good, lang, unique, mixed, packed = results
    kept = rows(good)
    assert not kept - rows(start)
    ids = {d for d, _ in kept}
    assert np.mean([d in ids for d, q in labels.items() if q == 1]) > 0.98
    assert np.mean([d in ids for d, q in labels.items() if q == 0]) < 0.15
    assert rows(lang) == rows(good)  # every good document has letters of one language
    comp = brute.components([(r["doc_id"], r["text"]) for r in lang.collect()], 5)
    assert {d for d, _ in rows(unique)} == {d for d, (_, c) in comp.items() if c == d}
    copies = rows(mixed)
    assert set(copies) <= set(rows(unique)) and max(copies.values()) <= 2
    words = sum(len(brute.words(r["text"])) for r in unique.collect())
    assert abs(sum(len(brute.words(r["text"])) for r in mixed.collect()) / words - 1.5) < 0.08
    firsts = Counter(r["doc_id"] for r in packed.where("start = 0").collect())
    want = Counter()
    for (d, _), n in copies.items():
        want[d] += n
    assert firsts == want


def test_empty_and_hard(spark, hard):
    for docs in (hard.limit(0), hard):
        now = docs
        for name, stage in corpus_pipeline.STAGES:
            now = materialize(stage(spark, now, SF), name="test-stage")
            if name != "packing":
                assert now.schema.names == docs.schema.names
        now.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0 and corpus_pipeline.ORACLE_SQL is None
