"""SentencePiece's BPE against the library whose results it promises, and the memory of pieces."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SCHEMA, row
from sentencepiece import SentencePieceProcessor

from wxspark.llm import piece_bpe, pieces, queries
from wxspark.llm.common import table

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  a  b ", "▁a ▁▁b▁", "\n\t x\x00y", "<s> </s> <unk> <0x0A>", "Ⅷ ½ ﬁ é é", "👩‍👩‍👧 ok", "日本語 한국어 ไทย", "\U0010ffff a\U0010ffffb",
    " " * 17, "a" + " " * 35 + "b", " " * 100 + "\n" + " " * 16, "==== ---- ....", "don't I'LL e.g. x_y1 {[()]}", "﻿z", "ab1." * 50,
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def coder():
    return piece_bpe.codec(PATH)


def same(coder, library, texts):
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert ids == library.encode(text), repr(text)
        assert coder.decode([*ids, 2]).decode() == library.decode([*ids, 2]), repr(text)


def test_odd_texts(coder, library):
    same(coder, library, ODD)
    assert coder.encode([None]) == [[]] and coder.decode([2]) == b""


def test_runs_of_blanks(coder, library):
    same(coder, library, [before + " " * n + after for n in range(60) for before in ("", "a", "\n") for after in ("", "the", "\x00", "▁")])


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60).map(lambda t: t.encode("utf-8", "ignore").decode()))
def test_any_text(text):
    coder = piece_bpe.codec(PATH)
    assert coder.encode([text])[0] == SentencePieceProcessor(model_file=PATH).encode(text)


def test_texts_of_tokens(coder, library):
    """Tokens side by side, so that pairs of them are tested that no prose has."""
    rng = random.Random(5)
    names = [t for i, t in enumerate(coder.vocabulary.tokens) if coder.vocabulary.rank[i] >= 0]
    same(coder, library, ["".join(rng.choice(names) for _ in range(rng.randrange(1, 8))).replace("▁", " ") for _ in range(3_000)])


def test_prefix_table(coder, library):
    """The last token of every prefix is that of the prefix's own encoding."""
    word = "▁unbelievableness"
    for n, token in enumerate(coder.last_tokens(word), 1):
        assert library.encode(word[1:n])[-1:] == [token] or n == 1


def test_every_merge_is_known(coder):
    left, right = piece_bpe.merge_splits(coder.vocabulary)
    tokens, rank = coder.vocabulary.tokens, coder.vocabulary.rank
    for i, r in enumerate(rank):
        if r >= 0:
            assert left[i] >= 0 and tokens[left[i]] + tokens[right[i]] == tokens[i]


@pytest.mark.parametrize("text", [" " * 100_000, "x" * 100_000, "-" * 100_000, "한" * 50_000, "\x00" * 50_000])
def test_long_pieces(coder, library, text):
    same(coder, library, [text])
    assert all(len(p) <= pieces.LONGEST for p in coder.memory._young)


def test_query(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    got = queries.op13_piece_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    digest = lambda data: hashlib.sha256(data.encode()).hexdigest()
    for r in got:
        ids = library.encode(texts[r.doc_id]) + [2]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(" ".join(map(str, ids))))
        assert r.decoded_sha256 == digest(library.decode(ids))


def test_round_trip(spark):
    docs = spark.createDataFrame([row(i, t) for i, t in enumerate(["a b", None, "", "é 日本", " x"])], SCHEMA)
    back = piece_bpe.decoded(piece_bpe.encoded(docs, PATH), PATH)
    assert {r.doc_id: r.text for r in back.collect()} == {0: "a b", 1: "", 2: "", 3: "é 日本", 4: " x"}
    assert {tuple(r.ids) for r in piece_bpe.encoded(docs, PATH, end=False).where("doc_id in (1, 2)").collect()} == {()}


def test_memory_is_bounded_in_bytes():
    asked = []
    memory = pieces.Memory(lambda new: [asked.append(p) or p.upper() for p in new], generation_bytes=40 * 350)
    for start in range(0, 2_000, 10):
        cut = [[f"p{k}" for k in range(start, start + 10)] + ["kept"] + ["long" * 50]]
        assert [list(t) for t in memory.encoded(cut)] == [[p.upper() for p in cut[0]]]
        assert len(memory._young) + len(memory._old) < 120
    assert asked.count("kept") < 20 and asked.count("long" * 50) == 200
    assert max(map(len, [*memory._young, *memory._old])) <= pieces.LONGEST
