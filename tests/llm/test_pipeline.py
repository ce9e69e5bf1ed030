"""Every stage of the pipeline against brute force on the stage's own input."""

from collections import Counter

import corpus_pipeline as pipeline
from threadloom.llm import packing
from threadloom.llm.common import stage
from threadloom.llm.queries import vocabulary

from .test_dedup import components, fingerprint_brute, line_brute
from .test_selection import mixing_brute


def test_stages(spark, mini):
    docs = stage(spark.read.parquet(f"{mini}/documents.parquet"), "test")
    before = docs.collect()
    for name, step in pipeline.STAGES:
        out = stage(step(spark, docs, mini), "test")
        after = out.collect()
        if name != "packing":
            assert out.dtypes == docs.dtypes
        if name == "quality classifier":
            assert not Counter(after) - Counter(before) and 0 < len(after) <= len(before)
        elif name == "line dedup":
            want = line_brute([r.text for r in before], 10)
            texts = [(r.doc_id, r.text if not n else kept) for r, (_, kept, n) in zip(before, want)]
            assert Counter((r.doc_id, r.text) for r in after) == Counter(texts)
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in after)
        elif name == "simhash near-dedup":
            fps = [fingerprint_brute(r.text) for r in before]
            groups = list(components(len(before), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3))
            assert len(after) == len(groups) and not Counter(after) - Counter(before)
            best = Counter(min((before[i].doc_id is None, before[i].doc_id) for i in g)[1] for g in groups)
            assert Counter(r.doc_id for r in after) == best
        elif name == "mixing":
            _, _, target = mixing_brute([(r.doc_id, r.text, None, r.source) for r in before])
            words = Counter()
            for r in after:
                words[r.source] += len((r.text or "").encode().split())
            assert all(abs(words[s] - target[s]) <= 0.5 for s in target if s in words or target[s] > 0.5)
        else:
            ids = {r.doc_id for r in before}
            assert {r.doc_id for r in after} == ids
            tokens = packing.Encoder(vocabulary()).tokenizer.encode_batch([r.text or "" for r in before], add_special_tokens=False)
            assert sum(r.length for r in after) == sum(len(e.ids) + 1 for e in tokens)
        docs, before = out, after


def test_run_and_empty(spark, mini, empty):
    assert pipeline.run(spark, mini).count() > 0
    assert pipeline.run(spark, empty).count() == 0
