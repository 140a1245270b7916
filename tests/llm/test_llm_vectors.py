"""Vector codes against brute force."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wxspark.llm import queries, vector_codes
from wxspark.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, code string, part int, error long, n int, numbers int, key string"


def vectors(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, k, "c", 1, 2, 3, 4, "k") for i, v, k in rows], schema)


def brute(rows):
    """(vec_id, code, error, label_error, digest) of each kept row, by plain counting."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], k) for i, v, k in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4) * 4
    kept = [(i, v + [0] * (width - len(v)), k) for i, v, k in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:256]
    step = width // 4
    cut = lambda v: [tuple(v[p * step : (p + 1) * step]) for p in range(4)]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(4)]

    def near(book, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            of = {}
            for _, v, _ in kept:
                of.setdefault(near(books[p], cut(v)[p])[1], []).append(cut(v)[p])
            for e, parts in of.items():
                books[p][e] = tuple(sum(c) // len(parts) for c in zip(*parts))
    found = [[near(books[p], cut(v)[p]) for p in range(4)] for _, v, _ in kept]
    errors = [sum(d for d, _ in f) for f in found]
    of_label = {}
    for (_, _, k), e in zip(kept, errors):
        of_label[k] = of_label.get(k, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(i, "".join(f"{e:02x}" for _, e in f), d, of_label[k], digest) for (i, _, k), f, d in zip(kept, found, errors)]


def same(got, want):
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    assert order(got) == order(want)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, sf, "embeddings").collect()]
    got = queries.op11_vector_codes(spark, sf)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    same(got.collect(), brute(rows))


def test_awkward_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=8).tolist(), int(i) % 3) for i in rng.permutation(400)]
    rows += [(5, [1.0] * 8, None), (5, [1.0] * 8, None), (-7, [0.5] * 7, 1), (None, [2.0] * 8, 1), (None, [], 2), (3, [0.25], 9)]
    rows += [(1000, None, 1), (1001, [1.0, None] * 4, 1), (1002, [math.nan] * 8, 1), (1003, [math.inf] + [0.0] * 7, 1)]
    rows += [(2000 + i, [0.125] * 8, 4) for i in range(300)]  # one vector many times
    same(vector_codes.code_table(vectors(spark, rows).repartition(7)).collect(), brute(rows))


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [math.nan], 2)]])
def test_nothing_kept(spark, rows):
    assert vector_codes.code_table(vectors(spark, rows)).collect() == []


@pytest.mark.parametrize("rows", [[(1, [], 1), (2, [], None)], [(4, [0.3, 0.1], None)], [(None, [1.5] * 5, 1), (None, [0.5] * 5, 1)]])
def test_few_rows(spark, rows):
    same(vector_codes.code_table(vectors(spark, rows)).collect(), brute(rows))


def test_large_components(spark):
    """Beyond what 32 and 64 bits hold of a transform; and beyond what a result can hold."""
    wide = SCHEMA.replace("array<float>", "array<double>")
    for scale in (100.0, 1e4, 5e5):
        rows = [(i, [scale * ((i * 7 + j) % 11 - 5) for j in range(16)], i % 2) for i in range(20)]
        rows += [(30, [scale * 5.5] * 16, 1)]
        same(vector_codes.code_table(vectors(spark, rows, wide)).collect(), brute(rows))
    with pytest.raises(Exception, match="beyond 62 bits"):
        vector_codes.code_table(vectors(spark, [(1, [1e300] * 4, 1)], wide)).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 40), st.integers(0, 10**6), st.sampled_from([2, 300, 10**5, 10**9, 10**12]))
def test_nearest_is_exact(length, entries, seed, reach):
    rng = np.random.default_rng(seed)
    book = rng.integers(-reach, reach, (entries, length))
    parts = np.concatenate([rng.integers(-reach, reach, (30, length)), book[rng.integers(0, entries, 10)]])
    distance = ((parts.astype(object)[:, None] - book.astype(object)[None]) ** 2).sum(axis=2)
    code, error = vector_codes.Nearest(book)(parts)
    assert code.tolist() == [row.index(min(row)) for row in distance.tolist()]
    assert error.tolist() == distance.min(axis=1).tolist()


def test_transform_keeps_distances_and_order():
    order = vector_codes.sequency_order(8)
    rows = vector_codes.transform(np.eye(8, dtype=np.int64)).T  # basis functions in the order given out
    assert sorted(order.tolist()) == list(range(8))
    assert [int((r[1:] != r[:-1]).sum()) for r in rows] == list(range(8))
    assert (rows @ rows.T == 8 * np.eye(8)).all()


def test_codes_decode_to_entries(spark):
    sf = "/root/testdata/sf0.001"
    kept = vector_codes.kept_vectors(table(spark, sf, "embeddings")).persist()
    books = vector_codes.learn(kept)
    numbers = {r.vec_id: r.numbers for r in kept.collect()}
    for r in vector_codes.codes(kept, books).collect():
        assert sum((a - b) ** 2 for a, b in zip(numbers[r.vec_id], vector_codes.decode(r.code, books).tolist())) == r.error
    kept.unpersist()
