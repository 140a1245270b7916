"""The source divergence audit against plain counting; its SQL is in test_llm_pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SCHEMA

from wxspark.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def small(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least, top):
    """(lang, source, part, item, value, rank) from (lang, source, text)."""
    counts, documents = {}, {}
    for lang, source, text in rows:
        terms = TERM.findall(small(text))
        counts.setdefault((lang or "", source or ""), Counter()).update(terms)
        documents.setdefault(lang or "", Counter()).update(set(terms))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in documents[lang].items() if n >= least]
        groups = {s: c for (la, s), c in counts.items() if la == lang}
        whole = sum(groups.values(), Counter())

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s, c in groups.items():
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def check(spark, rows, least=2, top=5, parts=5):
    full = [(i, text, lang, source, 1, 0.5, "n", "k", "w", 1, 1, 1, 1, 1, "p") for i, (lang, source, text) in enumerate(rows)]
    docs = spark.createDataFrame(full, SCHEMA).repartition(parts)
    got = sorted(map(tuple, divergence.audit(docs, least, top).collect()))
    assert got == brute(rows, least, top)
    return got


WORDS = ["a", "word", "eightlet", "ninelette", "sixteenletters_x"[:14] + "xy", "seventeenlettersx", "über", "日本語テキスト日本語", "long" * 40, "Zz", "é" * 9, "x" * 5000]


def drawn(rng, n, langs=("en", "de", None), sources=("s1", "s2", "s3", "", None)):
    return [(rng.choice(langs), rng.choice(sources), " ".join(rng.choice(WORDS) for _ in range(rng.randrange(12)))) for _ in range(n)]


def test_counts_by_hand(spark):
    rng = random.Random(4)
    rows = drawn(rng, 150) + [("fr", "one", "seul"), ("fr", "one", "seul"), ("xx", "a", None), ("xx", "b", ""), ("xx", "c", "1 2 3")]
    rows += [("en", "hot", "word Word WORD a")] * 120  # a hot group of equal rows
    got = check(spark, rows)
    assert {r[:4] for r in got if r[0] == "xx"} >= {("xx", "a", "pair", "b"), ("xx", "b", "pair", "a")}
    assert {r[4] for r in got if r[0] == "xx"} == {0}


def test_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 3)
    monkeypatch.setattr(divergence, "CHUNK", 2)
    check(spark, drawn(random.Random(5), 200, sources=[f"s{k}" for k in range(9)]), least=3)


def test_merges_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(divergence, "MERGE_BYTES", 500)
    monkeypatch.setattr(divergence, "FLUSH_BYTES", 2_000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        check(spark, drawn(random.Random(6), 200))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("rows", [[], [(None, None, None)], [("en", "a", "x" * 200_000 + " y"), ("en", "b", "y " * 50_000)]])
def test_empty_and_long(spark, rows):
    check(spark, rows, least=1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.text(alphabet="aBz é日|1 @[`{\x00\n", max_size=60))), max_size=8))
def test_packing_counts_any_text(rows):
    column = pa.array([t for _, t in rows], pa.string())
    got = {}
    for bucket in divergence.pack(column, np.array([g for g, _ in rows], dtype=np.uint32)).values():
        for group, term, n, docs in zip(bucket.keys[0].tolist(), bucket.terms(), bucket.n.tolist(), bucket.docs.tolist()):
            got[group, term.decode()] = (n, docs)
    n, docs = Counter(), Counter()
    for g, text in rows:
        terms = TERM.findall(small(text))
        n.update((g, t) for t in terms)
        docs.update((g, t) for t in set(terms))
    assert got == {k: (n[k], docs[k]) for k in n}


def test_radix_order_is_stable():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 3, 500).astype(np.uint32), rng.integers(0, 2**64, 8, dtype=np.uint64)[rng.integers(0, 8, 500)]
    assert (divergence.radix_order([a, b]) == np.lexsort([b, a])).all()
    assert len(divergence.radix_order([a[:0], b[:0]])) == 0
