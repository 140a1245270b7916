"""Near-duplicates, decontamination and line rules against brute force and SQL."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest
from compare import connect, differences
from llm_data import LINES, SCHEMA, row

from wxspark.llm import decontaminate, line_rules, near_duplicates, queries
from wxspark.llm.common import table


def brute_groups(texts: dict[int, str | None]) -> tuple[dict[int, int], dict[int, int]]:
    sets = {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    group = {i: i for i in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                group[b] = a
    return {i: len(s) for i, s in sets.items()}, {i: find(i) for i in sets}


def check_groups(docs):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    sizes, groups = brute_groups(texts)
    got = near_duplicates.grouped(docs).collect()
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert {r.doc_id: r.component_id for r in got} == groups
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return groups


def family(rng, n, edits, length=80):
    """A text and copies of it with a few words changed."""
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(words))
    return out


def test_groups_of_documents(spark, sf_dir):
    check_groups(table(spark, sf_dir, "documents"))


@pytest.mark.parametrize(("small", "chunk"), [(8, 128), (2, 3)])
def test_large_families(spark, monkeypatch, small, chunk):
    monkeypatch.setattr(near_duplicates, "SMALL", small)
    monkeypatch.setattr(near_duplicates, "CHUNK", chunk)
    rng = random.Random(7)
    texts = family(rng, 60, 4) + family(rng, 40, 2) + ["A b c"] * 30 + ["a B c d"] * 5 + [None, "", "one"]
    texts += [" ".join(f"u{k}_{i}" for i in range(30)) for k in range(20)]
    # a chain: neighbours are near, ends are not
    chain = [f"c{i}" for i in range(120)]
    texts += [" ".join(chain[k : k + 100]) for k in range(0, 20, 2)]
    rng.shuffle(texts)
    groups = check_groups(spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], SCHEMA))
    assert len(set(groups.values())) < len(groups) - 60


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame([row(i, "the very same text of six words") for i in range(5, 9)] + [row(1, "other")], SCHEMA)
    assert sorted(r.doc_id for r in near_duplicates.deduplicated(docs).collect()) == [1, 5]


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(3)
    for shared, own in ((900, 50), (500, 250), (20, 1), (6, 1)):
        common = rng.integers(0, 2**63, shared, dtype=np.uint64)
        a, b = (
            near_duplicates.registers(np.unique(near_duplicates.mixed(np.concatenate([common, rng.integers(0, 2**63, own, dtype=np.uint64)]))))
            for _ in range(2)
        )
        near = near_duplicates.estimate(a[None], b[None])[0]
        assert abs(near - shared / (shared + 2 * own)) < 0.15


@pytest.mark.parametrize("threshold", [80, 85])
def test_estimate_loses_no_pair_of_short_texts(threshold):
    """Sets of 51 or 48 shingles and some more, exactly at the threshold, whose registers are borrowed for the most part."""
    rng = np.random.default_rng(11)
    common = 60 * threshold // 100
    pairs = []
    for _ in range(15_000):
        drawn = rng.integers(0, 2**64, 60, dtype=np.uint64)
        half = (60 + common) // 2
        pairs.append([near_duplicates.registers(np.sort(x)) for x in (drawn[:half], np.r_[drawn[:common], drawn[half:]])])
    a, b = np.array(pairs).swapaxes(0, 1)
    assert (near_duplicates.estimate(a, b) < threshold / 100 - 0.09).any()  # four standard errors are too few
    assert near_duplicates.let_through(a, b, threshold).all()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, name, sf):
    path = f"/root/testdata/{sf}"
    assert differences(queries.QUERIES[name](spark, path), queries.ORACLES[name], connect(path)) is None


def test_contamination_by_hand(spark, monkeypatch):
    long_item = " ".join(f"k{i}" for i in range(14))
    items = spark.createDataFrame(
        [(7, long_item), (10, "Two Words"), (11, "lone"), (12, "a b c d e f g"), (None, "nameless item")],
        "item_id long, text string",
    )
    docs = {
        1: "start " + " ".join(f"K{i}" for i in range(2, 14)) + " end",  # twelve words, three windows
        2: "two, words; two words lone",
        3: " ".join(f"k{i}" for i in range(9)),  # one word short
        4: "a b c d e f",
        5: "a b c d e f g a b c d e f g",
        6: "k0 k1 k2 k3 k4 k5 k6 k7 k8 XX k9 k10 k11 k12 k13",
        7: "a nameless item",
        8: None,
    }
    frame = spark.createDataFrame([row(i, t) for i, t in docs.items()], SCHEMA)
    for block in (1_000_000, 4):  # in one block, and in many
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.contamination_table(frame, items).collect()}
        assert got == {1: (12, 1), 2: (5, 2), 3: (0, 0), 4: (0, 0), 5: (14, 1), 6: (0, 0), 7: (2, 0), 8: (0, 0)}


def test_native_plans(spark, sf_dir):
    for name in ("op4_decontamination", "op5_line_rules"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


def test_rules_on_odd_lines(spark, tmp_path):
    """Rules, menus, capitals and symbols, alone and mixed, against the SQL; very long lines in reasonable time."""
    rng = random.Random(3)
    marks = ["-", "---", "|", " | ", "»", "•", ">", "A", "AB", "Ab", "word", "WORD", "É", "é", "!!", "D!!", ".", " ", "  ", "#", "1", "»Ok", "log in", "Sign in", "\t"]
    lines = ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 12))) for _ in range(3_000)]
    rows = [row(i, "\n".join(lines[i : i + 6])) for i in range(0, 3_000, 6)] + [row(9_000 + k, t) for k, t in enumerate(LINES)]
    docs = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text")
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    assert differences(line_rules.rule_table(spark.read.parquet(str(tmp_path / "d"))), queries.ORACLES["op5_line_rules"], con) is None
