"""Licence notices by a positional rare-token index.

The index holds, for each template, the words of highest inverse document frequency of its first mandatory phrase with
their places. Where a file has such a word, the word's postings say where each template would have to begin; places
that several words agree on are candidates, and a candidate counts if the first mandatory phrase stands there word for
word, and each further one within SLACK words of its own place, as names and years are filled in between. The notice's
other words add to the score only. Document frequencies of the templates' words are counted over all documents.

Beside that, the places of fixed base phrases are counted. Null texts count as empty; they have no words, no
labels and score 0. Very long texts are scanned whole, in time proportional to their length. Rows that repeat are scanned
one by one; other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import bounded_batches

#: Phrase words and label of each base phrase.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
_GNU = (
    "is free software you can redistribute it and or modify it under the terms of the gnu {} as published by the free software"
    " foundation either version {} of the license or at your option any later version this program is distributed in the hope"
    " that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a"
    " particular purpose see the gnu {} for more details you should have received a copy of the gnu {} along with this program"
)
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
    " conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the"
    " following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and"
    " the following disclaimer in the documentation and or other materials provided with the distribution "
)
_BSD_NO_ENDORSEMENT = (
    "3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission "
)
_BSD_DISCLAIMER = (
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including"
    " but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
)
#: Label, notice, its mandatory phrases. Short mentions first, then the standard notices.
TEMPLATES = (
    ("agpl", "gnu affero general public license", ("affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("artistic", "the artistic license 2 0", ("artistic license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ("redistribution and use in source and binary forms",)),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc0", "cc0 1 0 universal public domain dedication", ("public domain dedication",)),
    ("eclipse", "eclipse public license v 2 0", ("eclipse public license",)),
    ("gpl", "licensed under the gnu general public license version 3", ("gnu general public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose",
     ("permission to use copy modify and or distribute this software",)),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ("permission is hereby granted free of charge",)),
    ("mpl-2.0", "mozilla public license version 2 0", ("mozilla public license",)),
    ("reserved", "all rights reserved", ("all rights reserved",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("unencumbered software released into the public domain",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files the software to deal in the software without restriction including without limitation the rights to"
     " use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the"
     " software is furnished to do so subject to the following conditions the above copyright notice and this permission notice"
     " shall be included in all copies or substantial portions of the software the software is provided as is without warranty of"
     " any kind express or implied including but not limited to the warranties of merchantability fitness for a particular"
     " purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other"
     " liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the"
     " use or other dealings in the software",
     ("to any person obtaining a copy of this software and associated documentation files",
      "shall be included in all copies or substantial portions of the software")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
     " provided that the above copyright notice and this permission notice appear in all copies the software is provided as is"
     " and the author disclaims all warranties with regard to this software including all implied warranties of merchantability"
     " and fitness",
     ("for any purpose with or without fee is hereby granted", "the author disclaims all warranties with regard to this software")),
    ("bsd-2-clause", _BSD + _BSD_DISCLAIMER,
     ("redistributions of source code must retain the above copyright notice",
      "materials provided with the distribution this software is provided by")),
    ("bsd-3-clause", _BSD + _BSD_NO_ENDORSEMENT + _BSD_DISCLAIMER,
     ("redistributions of source code must retain the above copyright notice", "neither the name of",
      "may be used to endorse or promote products derived from this software")),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with"
     " the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable"
     " law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or"
     " conditions of any kind either express or implied see the license for the specific language governing permissions and"
     " limitations under the license",
     ("may not use this file except in compliance with the license", "http www apache org licenses license 2 0",
      "governing permissions and limitations under the license")),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not"
     " distributed with this file you can obtain one at http mozilla org mpl 2 0",
     ("source code form is subject to the terms of the mozilla public license", "if a copy of the mpl was not distributed")),
    ("gpl-or-later", "this program " + _GNU.format("general public license", "3", *["general public license"] * 2),
     ("under the terms of the gnu general public license as published by the free software foundation",
      "or at your option any later version")),
    ("lgpl-or-later",
     "this library " + _GNU.format("lesser general public license", "2 1", *["lesser general public license"] * 2),
     ("under the terms of the gnu lesser general public license as published by the free software foundation",
      "or at your option any later version")),
    ("agpl-or-later",
     "this program " + _GNU.format("affero general public license", "3", *["affero general public license"] * 2),
     ("under the terms of the gnu affero general public license as published by the free software foundation",
      "or at your option any later version")),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
     ("to the extent possible under law", "waived all copyright and related or neighboring rights")),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish"
     " use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial"
     " or non commercial and by any means",
     ("unencumbered software released into the public domain", "anyone is free to copy modify publish use compile sell or distribute")),
)
#: Words that a further phrase may stand away from its place in the notice.
SLACK = 30
#: Rare words of a mandatory phrase that the index holds, and how many must agree on a place.
ANCHORS, AGREEING = 3, 2
#: Byte by byte: A-Z to a-z; 0-9, a-z and bytes beyond ASCII stay; all others separate words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


class Index(NamedTuple):
    postings: dict[bytes, tuple[tuple[int, int], ...]]  # word: (template, place in it)
    templates: tuple[tuple[str, tuple[bytes, ...], tuple[tuple[int, tuple[bytes, ...]], ...]], ...]  # label, words, phrases
    needed: tuple[int, ...]  # words that must agree, per template
    idf: dict[bytes, float]
    base: dict[bytes, tuple[tuple[tuple[bytes, ...], str], ...]]  # first word: (words, label)


def vocabulary() -> frozenset[bytes]:
    return frozenset(w for _, notice, _ in TEMPLATES for w in notice.encode().split())


def document_frequencies(docs: DataFrame) -> tuple[int, dict[bytes, int]]:
    """The number of documents, and of those with each word of the templates: one row a word reaches the driver."""
    known = vocabulary()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[bytes, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                count[b""] = count.get(b"", 0) + 1
                for word in known.intersection(words_of(text)):
                    count[word] = count.get(word, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in count], pa.string()), pa.array(list(count.values()), pa.int64())],
            ["word", "n"],
        )

    rows = docs.select("text").mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n")).collect()
    found = {w.encode(): n for w, n in rows}
    return found.pop(b"", 0), found


def build_index(n_docs: int, frequencies: dict[bytes, int]) -> Index:
    idf = {w: math.log((1 + n_docs) / (1 + frequencies.get(w, 0))) + 1.0 for w in vocabulary()}
    postings: dict[bytes, list[tuple[int, int]]] = {}
    templates, needed = [], []
    for t, (label, notice, phrases) in enumerate(TEMPLATES):
        words = tuple(notice.encode().split())
        placed = []
        for phrase in phrases:
            part = tuple(phrase.encode().split())
            placed.append((next(i for i in range(len(words)) if words[i : i + len(part)] == part), part))
        at, part = placed[0]
        rare = sorted(range(at, at + len(part)), key=lambda i: (-idf[words[i]], i))[:ANCHORS]
        for i in rare:
            postings.setdefault(words[i], []).append((t, i))
        templates.append((label, words, tuple(placed)))
        needed.append(min(AGREEING, len(rare)))
    base: dict[bytes, list[tuple[tuple[bytes, ...], str]]] = {}
    for phrase, label in BASE_PHRASES.items():
        part = tuple(phrase.encode().split())
        base.setdefault(part[0], []).append((part, label))
    return Index(
        {w: tuple(p) for w, p in postings.items()},
        tuple(templates),
        tuple(needed),
        idf,
        {w: tuple(p) for w, p in base.items()},
    )


def _near(words: list[bytes], place: int, phrase: tuple[bytes, ...]) -> bool:
    """Whether a phrase stands within SLACK words of a place."""
    around = range(max(0, place - SLACK), place + SLACK + 1)
    return any(words[i : i + 1] == [phrase[0]] and tuple(words[i : i + len(phrase)]) == phrase for i in around)


def scan(text: str | None, index: Index) -> tuple:
    """The columns of RESULT after doc_id."""
    words = words_of(text)
    if index.postings.keys().isdisjoint(words) and index.base.keys().isdisjoint(words):
        return len(words), 0, None, None, "", "", 0.0
    n_base, first, last = 0, None, None
    base_labels: set[str] = set()
    votes: dict[tuple[int, int], int] = {}
    for i, word in enumerate(words):
        for part, label in index.base.get(word, ()):
            if tuple(words[i : i + len(part)]) == part:
                n_base += 1
                first, last = i if first is None else first, i
                base_labels.add(label)
        for t, place in index.postings.get(word, ()):
            votes[t, i - place] = votes.get((t, i - place), 0) + 1
    labels, score = set(base_labels), 1.0 if base_labels else 0.0
    for (t, start), agreed in votes.items():
        label, notice, ((at, part), *further) = index.templates[t]
        if agreed < index.needed[t] or start + at < 0 or tuple(words[start + at : start + at + len(part)]) != part:
            continue
        if not all(_near(words, start + place, phrase) for place, phrase in further):
            continue
        labels.add(label)
        there = sum(
            index.idf[w] for k, w in enumerate(notice) if 0 <= start + k < len(words) and words[start + k] == w
        )
        score = max(score, there / sum(index.idf[w] for w in notice))
    return len(words), n_base, first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score


def licence_table(docs: DataFrame) -> DataFrame:
    """The columns of RESULT, a row for each of ``docs``."""
    bounded_batches(docs.sparkSession)
    index = build_index(*document_frequencies(docs))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(text, index) for text in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            names = [c.split()[0] for c in RESULT.split(", ")]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *arrays], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scanned, RESULT)
