"""Classifiers on documents they have not seen, licences against plain search, and the Viterbi decoding."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wxspark.llm import chat, common, language, licences, quality, queries, toxicity
from wxspark.llm.common import table

SF = "/root/testdata/sf0.01"


def share(df, condition):
    return df.agg(F.avg(condition.cast("double"))).first()[0]


def test_quality_held_out(spark):
    scored = queries.op3_quality(spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out")
    assert share(scored.where("quality = 1"), F.col("predicted") == 1) > 0.95
    assert share(scored.where("quality = 0"), F.col("predicted") == 0) > 0.6  # learned from some forty bad texts


def test_language_held_out(spark):
    named = queries.op9_language(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    assert share(named.where("held_out"), F.col("lang") == F.col("lang_pred")) > 0.95
    assert share(named, F.col("rejected")) < 0.05


def test_language_learns_rare_ones_too(spark, monkeypatch):
    """Seventy languages of different frequency, each with words of its own."""
    rng = np.random.default_rng(5)
    words = {f"l{k:02d}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 8)) for _ in range(12)] for k in range(70)}
    rows = [
        (i, " ".join(rng.choice(words[name], 40)), name)
        for i, name in enumerate(name for k, name in enumerate(words) for _ in range(2 + (69 - k) // 20))
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs)
    assert set(model.names) == set(words)
    assert [p[0] for p in language.predict([text for _, text, _ in rows], model)] == [name for *_, name in rows]
    monkeypatch.setattr(common, "MAX_LABELS", 69)
    with pytest.raises(ValueError, match="more than 69"):
        language.learn(docs)


def test_language_rejects_letterless_and_narrow():
    model = language.Languages(("de", "en"), (b"der die das und nicht " * 200, b"the and of with from that " * 200))
    names = [p[0] for p in language.predict(["the and of with from that the and", "12 34", None, "", "?", "½ ² Ⅷ", "½ the and of"], model)]
    assert names == ["en", "und", "und", "und", "und", "und", "en"]
    for text in ("a½b ² c Ⅷ", "½", "x_1 y", "日本 一二 ٣", "é-è"):
        assert language._letters(text) == language.NOT_LETTERS.sub(" ", text.lower()).encode()
    assert language.predict(["zzqx"], model)[0][2] < language.MARGIN


def test_toxicity_unseen(spark):
    """Learn from one half of the labels, judge the other."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    chain = toxicity.learn(docs, labels.where(half))
    judged = toxicity.toxicity_table(docs, chain).join(labels.withColumnRenamed("toxic", "label"), "doc_id").where(~half)
    assert share(judged.where("label = 0"), ~F.col("toxic")) > 0.97
    assert share(judged.where("label = 1"), F.col("toxic")) > 0.6


def test_toxicity_all_labels(spark):
    judged = queries.op10_toxicity(spark, SF).join(table(spark, SF, "labels").select("doc_id", F.col("toxic").alias("label")), "doc_id")
    assert share(judged, F.col("toxic") == (F.col("label") == 1)) > 0.97


def chain_of(texts, toxic):
    found = [toxicity.buckets_of(t) for t in texts]
    kept = np.unique([b for f, bad in zip(found, toxic) if bad for b in f])
    x = np.array([[float(k in set(f)) for k in kept] for f in found])
    y = toxicity.category_labels(x, toxic)
    return toxicity.fit_chain(kept, x, y, [np.arange(len(kept))] * len(toxicity.CATEGORIES))


def test_chain_uses_out_of_fold_predictions():
    texts = ["zorg qwub and mirf"] * 30 + ["a fine day with friends"] * 30 + ["plok vunt this day"] * 30
    toxic = np.array([1.0] * 30 + [0.0] * 30 + [1.0] * 30)
    order = np.random.default_rng(0).permutation(90)
    chain = chain_of([texts[i] for i in order], toxic[order])
    assert np.tril(np.ones_like(chain.links), -1)[chain.links != 0].all()  # only earlier categories
    p = toxicity.score(["zorg qwub and mirf", "a fine day with friends", "", None], chain)
    assert p[0, -1] > 0.9 and (p[1:, -1] < 0.5).all()
    assert p[0, :2].max() > 0.8 and p[0, :2].min() < 0.5  # of one of the two groups, and not of the other


def test_categories_are_found_in_the_data():
    """Two families of words that do not occur together, a rarer third, and toxic texts of none."""
    x = np.zeros((100, 6))
    x[:40, :2], x[40:70, 2:4], x[70:75, 4] = 1, 1, 1
    x[90:, 5] = 1  # only harmless texts have it
    toxic = np.r_[np.ones(85), np.zeros(15)]
    assert [g.tolist() for g in toxicity.grouped_features(x[toxic == 1])] == [[0, 1], [2, 3], [4]]
    y = toxicity.category_labels(x, toxic)
    assert y.sum(axis=0).tolist() == [40, 30, 5, 10, 85]


def test_toxicity_learns_from_whole_texts(spark):
    """What tells them apart stands at the end of long texts."""
    rows = [(i, "plain words " * 4_000 + ("vunt plok" if i % 2 else "good day")) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    judged = toxicity.toxicity_table(docs, toxicity.learn(docs, labels)).collect()
    assert {(r.doc_id % 2 == 1) == r.toxic for r in judged} == {True}


def test_licences_against_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = {r.doc_id: r for r in licences.licence_table(docs).collect()}
    for r in docs.collect():
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)
        hits = [
            (i, label)
            for phrase, label in licences.BASE_PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        mine = got[r.doc_id]
        assert (mine.n_words, mine.n_base) == (len(words), len(hits))
        assert mine.first_word == min((i for i, _ in hits), default=None)
        assert mine.last_word == max((i for i, _ in hits), default=None)
        assert mine.base_labels == ",".join(sorted({x for _, x in hits}))
        assert set(filter(None, mine.base_labels.split(","))) <= set(filter(None, mine.labels.split(",")))
        assert 0 <= mine.score <= 1


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        ("Released under the MIT License.", "mit"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
        ("x GNU Lesser General Public License y", "gpl,lgpl"),
        ("released by MIT under a license", ""),
        ("apache version license the 2 0", ""),
    ],
)
def test_licence_templates(text, labels):
    assert licences.scan(text, licences.build_index(100, {}))[5] == labels


def test_licence_mandatory_phrases_alone():
    """Whatever the frequencies: the phrase word for word gives the label, the rest of the notice is not needed."""
    known = sorted(licences.vocabulary())
    outside = {w: 10 for w in known} | {w: 9_000 for _, _, p in licences.TEMPLATES for w in " ".join(p).encode().split()}
    tables = [{}, {w: 10_000 for w in known}, outside]
    rng = np.random.default_rng(2)
    tables += [dict(zip(known, map(int, rng.integers(0, 10_001, len(known))), strict=True)) for _ in range(20)]
    for frequencies in tables:
        index = licences.build_index(10_000, frequencies)
        for label, notice, phrases in licences.TEMPLATES:
            if len(phrases) > 1:
                assert label in licences.scan(notice.title(), index)[5].split(",")
                continue
            phrase = phrases[0]
            for text in (phrase, f"x {phrase.title()} y"):
                *_, labels, score = licences.scan(text, index)
                assert label in labels.split(",") and 0 < score <= 1
            broken = phrase.split()
            broken.insert(1, "zzz")
            *_, base_labels, labels, _ = licences.scan(" ".join(broken), index)
            assert label not in set(labels.split(",")) - set(base_labels.split(","))


def searched_labels(words):
    """Labels by trying every place for every template."""

    def at(phrase, place):
        return words[max(0, place) : place + len(phrase)] == phrase if place >= 0 else False

    found = set()
    for label, notice, phrases in licences.TEMPLATES:
        notice, parts = notice.split(), [p.split() for p in phrases]
        places = [next(i for i in range(len(notice)) if notice[i : i + len(p)] == p) for p in parts]
        for i in range(len(words)):
            if at(parts[0], i):
                offsets = [i + p - places[0] for p in places[1:]]
                if all(any(at(p, o + d) for d in range(-licences.SLACK, licences.SLACK + 1)) for p, o in zip(parts[1:], offsets)):
                    found.add(label)
    return found | {label for phrase, label in licences.BASE_PHRASES.items() if any(at(phrase.split(), i) for i in range(len(words)))}


def test_licence_labels_against_search(spark, sf_dir):
    """Notices with words left out, put in or changed, one after another, and the documents."""
    rng = np.random.default_rng(8)
    texts = [r.text or "" for r in table(spark, sf_dir, "documents").select("text").collect()][:150]
    for _ in range(400):
        words = []
        for _ in range(rng.integers(1, 3)):
            _, notice, _ = licences.TEMPLATES[rng.integers(len(licences.TEMPLATES))]
            part = notice.split()
            for _ in range(rng.integers(0, 4)):
                k = int(rng.integers(len(part)))
                part[k : k + int(rng.integers(0, 2))] = ["filled"] * int(rng.integers(0, 12))
                part = part or ["x"]
            words += part
        texts.append(" ".join(words))
    seen = set()
    for frequencies in ({}, {w: 900 for w in licences.vocabulary()}):
        index = licences.build_index(1_000, frequencies)
        for text in texts:
            small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            want = searched_labels(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", small))
            assert licences.scan(text, index)[5] == ",".join(sorted(want))
            seen |= want
    assert seen == {label for label, _, _ in licences.TEMPLATES}


@pytest.mark.parametrize(("clauses", "label", "other"), [(2, "bsd-2-clause", "bsd-3-clause"), (3, "bsd-3-clause", "bsd-2-clause")])
def test_bsd_clauses(clauses, label, other):
    text = licences._BSD + (licences._BSD_NO_ENDORSEMENT if clauses == 3 else "") + licences._BSD_DISCLAIMER
    labels = licences.scan("Copyright (c) 1999, Someone\n" + text, licences.build_index(10, {}))[5].split(",")
    assert "bsd" in labels and label in labels and other not in labels


@pytest.fixture(scope="module")
def model(spark):
    return chat.learn(table(spark, SF, "conversations"))


def test_viterbi_is_the_best_path(model):
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 7):
        emit, opens = rng.normal(size=(n, 3)) * 3, rng.integers(0, 2, n)

        def total(path, emit=emit, opens=opens):
            out = model.start[path[0]] + emit[0, path[0]]
            for i in range(1, len(path)):
                out += (model.across if opens[i] else model.within)[path[i - 1], path[i]] + emit[i, path[i]]
            return out

        best = max(itertools.product(range(3), repeat=n), key=total)
        assert np.isclose(total(chat.viterbi(emit, opens, model.start, np.zeros(3), model)), total(best))


def test_roles_found(spark):
    messages = table(spark, SF, "conversations")
    got = queries.op2_chat(spark, SF).withColumnRenamed("role", "found").join(messages, ["conv_id", "turn"])
    assert share(got, F.col("found") == F.col("role")) > 0.93


def test_a_long_conversation_over_many_tasks(spark, model):
    """The same roles whether one task decodes it or many."""
    texts = ["Short?", "A long answer. " * 30, "And?", "Yes. " * 60, "Bot: marked\nUser: inside"]
    rows = [(1, t, None, texts[(t * 7 + t // 5) % 5]) for t in range(600)] + [(0, 0, None, "a"), (2, 0, None, "b")]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    found = {}
    try:
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            found[n] = sorted((r.conv_id, r.turn, r.roles) for r in chat.turns(messages, model).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found["1"] == found["16"]


def test_markers_become_turns(model):
    text = "User: hi there\nhow?\nAssistant: fine\n\nQ: x"
    lines = chat.observe(text)
    roles = chat.viterbi(chat.scores(lines, model), lines[:, 1], model.start, np.zeros(3), model)
    assert chat.render(text, roles) == (
        "<|user|>\nhi there\nhow?\n<|end|>\n<|assistant|>\nfine\n<|end|>\n<|user|>\nx\n<|end|>\n"
    )
