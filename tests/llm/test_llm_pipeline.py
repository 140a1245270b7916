"""Each stage of the pipeline held against its operator or brute force on its own input."""

from __future__ import annotations

import base64

import corpus_pipeline
import public_tokenizers
import tiktoken
from llm_data import SCHEMA, row

from wxspark.llm import byte_bpe, common, compression, decontaminate, language, near_duplicates, toxicity
from wxspark.llm.common import stored, table

SF = "/root/testdata/sf0.01"


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages(spark):
    docs = table(spark, SF, "documents")
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = stored(stage(spark, docs, SF), f"test-{name}")
    d = inputs["toxicity"]
    judged = toxicity.toxicity_table(d, toxicity.learn(d, table(spark, SF, "labels")))
    assert ids(inputs["language"]) == ids(judged.where("not toxic"))
    d = inputs["language"]
    assert ids(inputs["near_duplicates"]) == ids(language.language_table(d, language.learn(language.learnable(d))).where("not rejected"))
    assert ids(inputs["decontamination"]) == ids(near_duplicates.grouped(inputs["near_duplicates"], corpus_pipeline.NEAR).where("kept"))
    marked = decontaminate.contamination_table(inputs["decontamination"], table(spark, SF, "benchmark"))
    assert ids(inputs["byte_bpe"]) == ids(marked.where("not contaminated"))
    assert all(f.columns == table(spark, SF, "documents").columns for f in inputs.values())

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in inputs["byte_bpe"].collect()}
    got = {r.doc_id: r.ids for r in docs.collect()}
    assert got == {i: own.encode_ordinary(t) for i, t in texts.items()}


def test_run_applies_all(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    n = table(spark, "/root/testdata/sf0.001", "documents").count()
    assert 0 < out.count() < n
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_workers_remember_for_one_operator():
    """The next operator's task gives back what the one before remembered, and results do not depend on it."""
    path, text = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "two wise words, two wise words"
    first = byte_bpe.codec(path, public_tokenizers.PATTERN).encode([text])
    assert byte_bpe.codec(path, public_tokenizers.PATTERN).encode([text]) == first and byte_bpe._codecs
    sizes = compression.sizes([text.encode()], (b"two wise men", b"three words"))
    assert compression._made and not byte_bpe._codecs
    common.at_work("near-duplicates", near_duplicates._hashes.clear)
    shingles = near_duplicates.shingle_set(text).tolist()
    assert near_duplicates._hashes and not compression._made
    assert byte_bpe.codec(path, public_tokenizers.PATTERN).encode([text]) == first and not near_duplicates._hashes
    assert (compression.sizes([text.encode()], (b"two wise men", b"three words")) == sizes).all()
    assert near_duplicates.shingle_set(text).tolist() == shingles


def test_near_duplicate_stage_links_from_80(spark):
    """Pairs at and just around 0.8, found by counting: the stage drops those from 0.8 on, op7 keeps them apart."""

    def shingles(words):
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    texts, dropped = {}, set()
    for k in range(30):
        length = 40 + 7 * k
        base = [f"b{k}_{i}" for i in range(length)]
        for tail in range(length // 14, length // 5):
            other = base[:-tail] + [f"t{k}_{i}" for i in range(tail)]
            a, b = shingles(base), shingles(other)
            if 74 * len(a | b) <= 100 * len(a & b) < 85 * len(a | b):
                first = len(texts)
                texts |= {first: " ".join(base), first + 1: " ".join(other)}
                if 100 * len(a & b) >= 80 * len(a | b):
                    dropped.add(first + 1)
                break
        base = [f"c{k}_{i}" for i in range(84 + 5 * k)]
        texts[len(texts)] = " ".join(base)
        tail = next(t for t in range(len(base), 0, -1) if 100 * (len(base) - 4 - t) >= 80 * (len(base) - 4 + t))
        dropped.add(len(texts))  # as little over 0.8 as there can be
        texts[len(texts)] = " ".join(base[:-tail] + [f"u{k}_{i}" for i in range(tail)])
    docs = spark.createDataFrame([row(i, t) for i, t in texts.items()], SCHEMA)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert len(dropped) >= 30
    assert ids(stage(spark, docs, SF)) == texts.keys() - dropped
    assert ids(near_duplicates.deduplicated(docs)) == texts.keys()
