from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

import __spark_entry__
import corpus_pipeline
from daymill.llm import bpe, mixing, severity

from .test_disclosure import by_hand as entities
from .test_simhash import by_hand as fingerprint
from .test_simhash import groups

SMALL = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    model = severity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    made = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        made.append((name, docs.collect()))
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == columns
            docs = spark.createDataFrame(made[-1][1], docs.schema)
    toxic, single, hidden, mixed, coded = (rows for _, rows in made)
    clean = {k: t for k, t in texts.items() if model.above(np.array([model.score(t)]))[0, 0] < model.reject_from}
    assert {r.doc_id: r.text for r in toxic} == clean
    first = groups(sorted(clean), {k: fingerprint(t) for k, t in clean.items()})
    assert {r.doc_id for r in single} == {k for k, c in first.items() if k == c}
    assert all(not entities(r.text) and r.n_chars == len(r.text) for r in hidden) and len(hidden) == len(single)
    words = {r.doc_id: len(r.text.split()) for r in hidden}
    taken = Counter()
    for r in mixed:
        taken[r.doc_id] += len(r.text.split())
    assert all(n <= 2 * words[k] for k, n in taken.items()) and abs(sum(taken.values()) - 1.5 * sum(words.values())) < 21 * mixing.BLOCK_WORDS
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert Counter((r.doc_id, tuple(r.ids)) for r in coded) == Counter((r.doc_id, tuple(library.encode_ordinary(r.text))) for r in mixed)


def test_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5
