"""Language identification by compression.

One raw-content zstandard dictionary per language is cut from a bounded sample of its documents, for every language
that occurs; beyond common.MAX_LABELS of them learning fails. A text,
small-lettered and with everything but letters read as spaces, is compressed with each; the language whose dictionary leaves the fewest bytes is taken, and the prediction is
rejected when the runner-up comes too near.

Null or letterless texts are ``und``, score 0 and rejected. Ties go to the language that is more frequent where it is learned, then to the first name. Without a
single text to learn from every text is ``und``. An empty table gives an empty result; very long texts are compressed whole,
block by block. Rows that repeat are predicted one by one, other columns of
the input pass through or are not looked at.
"""

from __future__ import annotations

import re
import sys
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import bounded_batches, excerpts, id_remainder, sampled
from wxspark.llm.compression import raw_dictionary, sizes

#: Parameters: texts per language that a dictionary is cut from, characters cut from each, and dictionary bytes.
TEXTS, PIECE, DICTIONARY_BYTES = 90, 3_000, 110_000
#: A prediction is rejected when the runner-up takes less than this share of bytes more.
MARGIN = 0.01
UNKNOWN = "und"


def _not_letters() -> re.Pattern:
    """Runs of characters that are of no letter category. Word characters of ``re`` are letters and numeric
    characters, of which fractions, Roman numerals and the like are no digits to it."""
    numeric = [c for c in range(sys.maxunicode + 1) if chr(c).isnumeric() and not chr(c).isalpha()]
    ranges, start = [], 0
    for k in range(1, len(numeric) + 1):
        if k == len(numeric) or numeric[k] != numeric[k - 1] + 1:
            ranges.append(f"\\U{numeric[start]:08x}-\\U{numeric[k - 1]:08x}")
            start = k
    return re.compile(f"[\\W\\d_{''.join(ranges)}]+")


NOT_LETTERS = _not_letters()
#: The same but for those numeric characters, which few texts have; it is faster.
MOSTLY_NOT_LETTERS = re.compile(r"[\W\d_]+")
RESULT = "struct<lang: string, score: double, margin: double>"


class Languages(NamedTuple):
    names: tuple[str, ...]
    dictionaries: tuple[bytes, ...]


def learn(docs: DataFrame, texts: int = TEXTS, piece: int = PIECE, size: int = DICTIONARY_BYTES) -> Languages:
    """Dictionaries from ``docs`` (doc_id, text, lang), at most ``texts`` excerpts of each language."""
    found: dict[str, list[str]] = {}
    for name, text in excerpts(sampled(docs.select("doc_id", "text", "lang"), "lang", texts), piece):
        found.setdefault(name, []).append(text)
    counts = docs.where(F.col("lang").isin(list(found))).groupBy("lang").count().collect() if found else []
    names = tuple(r[0] for r in sorted(counts, key=lambda r: (-r[1], r[0])))
    return Languages(names, tuple(raw_dictionary([_letters(t) for t in found[n]], size) for n in names))


def _letters(text: str | None) -> bytes:
    cut = MOSTLY_NOT_LETTERS.sub(" ", (text or "").lower())
    return (cut if cut.replace(" ", "").isalpha() else NOT_LETTERS.sub(" ", cut)).encode()


def predict(texts: list[str | None], model: Languages) -> list[tuple[str, float, float]]:
    """(language, score, margin); the score is 1 - 2^-(margin / MARGIN)."""
    if not model.names:
        return [(UNKNOWN, 0.0, 0.0)] * len(texts)
    data = [_letters(t) for t in texts]
    out = []
    for text, cost in zip(data, sizes(data, model.dictionaries), strict=True):
        if not text.strip():
            out.append((UNKNOWN, 0.0, 0.0))
            continue
        best = int(np.argmin(cost))
        others = np.delete(cost, best)
        margin = float((others.min() - cost[best]) / max(others.min(), 1.0)) if len(others) else 1.0
        out.append((model.names[best], 1.0 - 2.0 ** (-margin / MARGIN), margin))
    return out


def predicted(text: Column, model: Languages) -> Column:
    @F.arrow_udf(RESULT)
    def language(values: pa.Array) -> pa.Array:
        rows = predict(values.to_pylist(), model)
        lang, score, margin = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64())],
            ["lang", "score", "margin"],
        )

    return language(text)


def learnable(docs: DataFrame) -> DataFrame:
    """The documents to learn from: id remainder modulo 3 not 1."""
    return docs.where(id_remainder(F.col("doc_id"), 3) != 1)


def language_table(docs: DataFrame, model: Languages) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, a row for each of ``docs``."""
    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", predicted(F.col("text"), model).alias("p")).select(
        "doc_id",
        F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        F.col("p.lang").alias("lang_pred"),
        F.col("p.score").alias("score"),
        ((F.col("p.lang") == UNKNOWN) | (F.col("p.margin") < MARGIN)).alias("rejected"),
    )


def identified(docs: DataFrame, model: Languages) -> DataFrame:
    """``docs`` without the rejected ones, all columns kept."""
    bounded_batches(docs.sparkSession)
    p = predicted(F.col("text"), model)
    return docs.where((p["lang"] != UNKNOWN) & (p["margin"] >= MARGIN))
