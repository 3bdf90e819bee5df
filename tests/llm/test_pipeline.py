import hashlib
import re

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as P
from holdfast.llm import bpe, language, mixing

from .test_near_dedup import expected


def test_stages_and_result(spark, sf, documents):
    """Each stage against a brute-force version on what the one before kept."""
    assert len(P.STAGES) == 5
    docs, seen = documents, []
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == documents.columns
        docs = spark.createDataFrame(docs.collect(), documents.schema)
        seen.append({r.doc_id: r for r in docs.collect()})
    one, two, three, four = seen
    predicted = {r.doc_id for r in language.predictions(documents).collect() if r.lang_pred != "und" and r.score >= language.MIN_SCORE}
    assert set(one) == predicted
    groups = {}
    for r in one.values():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", r.text or ""), []).append((-len(r.text or ""), r.doc_id))
    assert set(two) == {min(g)[1] for g in groups.values()}
    assert set(three) == {k for k, (_, least) in expected(two.values(), 5).items() if k == least}
    assert set(four) <= set(three)
    kept = spark.createDataFrame(list(three.values()), documents.schema)
    times = {r.doc_id: r.taken // r.size for r in mixing.plan(kept).collect() if r.taken}
    library = Tokenizer.from_file(bpe.vocabulary_path())
    found = P.run(spark, sf).collect()
    want = []
    for k, n in times.items():
        ids = library.encode(three[k].text, add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want += [(k, len(ids), digest, hashlib.sha256(three[k].text.encode()).hexdigest())] * n
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(want)


def test_edges(spark, edges, empty, sf):
    for table in (edges, empty):
        docs = table
        for _, stage in P.STAGES:
            docs = stage(spark, docs, sf)
        docs.collect()
