"""Every operator on null, empty, blank, long and repeated rows, on clashing names, and on empty tables."""

from __future__ import annotations

import public_tokenizers
import pytest
from llm_data import LONG, awkward, empty

from wxspark.llm import (
    byte_bpe,
    chat,
    decontaminate,
    language,
    licences,
    line_rules,
    near_duplicates,
    piece_bpe,
    quality,
    token_records,
    toxicity,
)

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def labels(spark, rows=((6, 1, 0), (5, 0, 1), (7, None, None), (None, 1, 1), (6, 0, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def items(spark, rows=((1, "one small text of words"), (2, None), (3, ""), (None, "no id at all"), (1, "one small text of words"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "tokens": lambda s, d: token_records.record_table(s, token_records.write_records(d, WORDS)),
    "quality": lambda s, d: quality.quality_table(d, quality.learn(d, labels(s))),
    "benchmark": lambda s, d: decontaminate.contamination_table(d, items(s)),
    "rules": lambda s, d: line_rules.rule_table(d),
    "bpe": lambda s, d: byte_bpe.digest_table(d, BPE, public_tokenizers.PATTERN),
    "pieces": lambda s, d: piece_bpe.digest_table(d, PIECES),
    "near": lambda s, d: near_duplicates.grouped(d),
    "licences": lambda s, d: licences.licence_table(d),
    "language": lambda s, d: language.language_table(d, language.learn(language.learnable(d))),
    "toxicity": lambda s, d: toxicity.toxicity_table(d, toxicity.learn(d, labels(s))),
}
FILTERS = {
    "toxic": lambda s, d: toxicity.without_toxic(d, toxicity.learn(d, labels(s))),
    "language": lambda s, d: language.identified(d, language.learn(language.learnable(d))),
    "near": lambda s, d: near_duplicates.deduplicated(d),
    "benchmark": lambda s, d: decontaminate.decontaminated(d, items(s)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(spark, name):
    docs = awkward(spark)
    got = OPERATORS[name](spark, docs).collect()
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in got)
    assert ids == sorted((r.doc_id is not None, r.doc_id or 0) for r in docs.collect())
    nulls = [n for r in got for n, v in r.asDict().items() if v is None]
    assert set(nulls) <= {"doc_id", "component_id", "first_word", "last_word"}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, empty(spark)).collect() == []


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_the_columns(spark, name):
    docs = awkward(spark)
    got = FILTERS[name](spark, docs)
    assert got.columns == docs.columns
    assert 0 < got.count() < docs.count() or name == "toxic"
    assert FILTERS[name](spark, empty(spark)).collect() == []


def test_no_items_and_no_labels(spark):
    docs = awkward(spark)
    none = decontaminate.contamination_table(docs, items(spark, [])).collect()
    assert len(none) == docs.count() and not any(r.contaminated for r in none)
    unlabelled = labels(spark, [])
    assert {r.score for r in quality.quality_table(docs, quality.learn(docs, unlabelled)).collect()} == {0.5}
    assert not any(r.toxic for r in toxicity.toxicity_table(docs, toxicity.learn(docs, unlabelled)).collect())


def test_words_of_long_text(spark):
    rows = {r.doc_id: r for r in line_rules.rule_table(awkward(spark)).collect()}
    assert rows[5].n_words == len(LONG.split()) and rows[5].n_repeat_words == 40_000 and not rows[5].kept
    assert rows[1].n_words == rows[2].n_words == rows[3].n_words == 0


MESSAGES = "conv_id long, turn long, role string, text string, score double, alone int, copy int, key string"


def test_chat_edges(spark):
    rows = [(1, 0, "user", "Hi?"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, 1, "other", ""),
            (None, 0, "user", "x"), (None, None, None, "y\nz"), (2, None, None, "Bot: q"), (2, 0, "user", "w " * 50_000)]
    messages = spark.createDataFrame([(*r, 0.0, 1, 1, "k") for r in rows], MESSAGES)
    got = chat.turns(messages, chat.learn(messages)).collect()
    count = lambda found: sorted((str(r.conv_id), str(r.turn)) for r in found)
    assert count(got) == count(messages.collect())
    assert all(r.role in chat.ROLES and r.rendered.startswith("<|") for r in got)
    none = messages.limit(0)
    assert chat.turns(none, chat.learn(none)).collect() == []
