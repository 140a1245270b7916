"""Toxicity by a classifier chain.

The categories are predicted one after the other by linear models over the words of a text and their beginnings;
each model also gets the probabilities of all categories before it. While training, those come from models that have not
seen the row (out of fold), so that a later model learns how far an earlier one can be trusted. The last link, ``toxic``,
decides.

Labels say only whether a text is toxic. The earlier categories are found in the data: the features that toxic texts have
more often than others are grouped by the toxic texts that they occur in together, GROUPS groups that reach the most texts are a
category each, and toxic texts without a feature of any are the category ``rest``.

Learning reads whole texts on the executors: the features of a bounded sample are screened there, and the driver gets,
for each sampled text, which of the screened features it has.

Null, empty and wordless texts get the score of a text without features; it is below the threshold unless
nearly all labels are toxic. Very long texts are judged whole. Without toxic labels the score is 0. Several labels of one
document: the largest counts. Rows that repeat are scored one by one; other columns pass through or are not looked at. An
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.llm.common import at_work, bounded_batches, sampled, stored

#: Categories that are found in the data.
GROUPS = 3
CATEGORIES = (*(f"group_{k + 1}" for k in range(GROUPS)), "rest", "toxic")
#: Features join a group if they share at least this part of their toxic texts (as a cosine) with its first one.
TOGETHER = 0.4
#: Parameters: labelled texts of each kind to learn from, hashed features, folds.
TEXTS, BUCKETS, FOLDS = 2_000, 1 << 20, 4
#: Lengths of the word beginnings that are features beside the words.
BEGINNINGS = (4, 5, 6)
#: The features that members have more often by this many standard errors are kept, at most so many of them: the size of
#: a linear model.
SCREEN, KEPT = 6.0, 200
THRESHOLD = 0.5
WORD = re.compile(r"[^\W\d_]{2,}")
RESULT = "struct<toxic: boolean, score: double, " + ", ".join(f"{c}: double" for c in CATEGORIES[:-1]) + ">"


class Chain(NamedTuple):
    features: np.ndarray  # the buckets that any category looks at, in order
    weights: np.ndarray  # a row per category over them
    links: np.ndarray  # a row per category over the log-odds of those before it
    bias: np.ndarray


def _buckets(word: str) -> tuple[int, ...]:
    parts = {word, *("^" + word[:k] for k in BEGINNINGS if len(word) >= k)}
    return tuple(xxhash.xxh64_intdigest(p) % BUCKETS for p in parts)


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def buckets_of(text: str | None) -> np.ndarray:
    """The distinct features of a whole text, in order; as numbers of four bytes, as long texts have many."""
    return np.unique(np.fromiter((b for w in words_of(text) for b in _buckets(w)), dtype=np.int32))


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Ridge logistic regression by Newton steps, both classes weighing equally; the last weight is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - penalty * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-5:
            break
    return w


def grouped_features(x: np.ndarray) -> list[np.ndarray]:
    """Features (columns) of toxic texts (rows) in at most GROUPS groups, by the texts that they share.

    The most frequent feature that is in no group yet begins one, and takes those that mostly occur where it does. The
    groups that reach the most texts are kept, the earlier one in ties.
    """
    counts = x.sum(axis=0)
    together = x.T @ x
    left = [k for k in np.argsort(-counts, kind="stable") if counts[k]]
    groups = []
    while left:
        first = left[0]
        cosine = together[first, left] / np.sqrt(counts[first] * counts[left])
        taken = [k for k, c in zip(left, cosine, strict=True) if c >= TOGETHER]
        groups.append(np.array(taken))
        left = [k for k in left if k not in set(taken)]
    groups.sort(key=lambda g: -int((x[:, g] > 0).any(axis=1).sum()))
    return groups[:GROUPS]


def category_labels(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """A column per category, from the features of the texts and whether they are toxic."""
    y = np.zeros((len(x), len(CATEGORIES)))
    y[:, -1] = toxic
    for c, group in enumerate(grouped_features(x[toxic == 1])):
        y[:, c] = (toxic == 1) & (x[:, group] > 0).any(axis=1)
    y[:, GROUPS] = (toxic == 1) & ~y[:, :GROUPS].any(axis=1)
    return y


def fit_chain(features: np.ndarray, x: np.ndarray, y: np.ndarray, own: list[np.ndarray]) -> Chain:
    """From the features (their buckets, in order), which of them each text has, the categories' labels, and the
    features (columns) that each category's model looks at."""
    n, k = len(x), len(CATEGORIES)
    mixed = [0 < y[:, c].sum() < n for c in range(k)]
    fold = np.arange(n) % FOLDS
    chain = Chain(features, np.zeros((k, len(features))), np.zeros((k, k)), np.full(k, -20.0))
    before = np.zeros((n, 0))
    for c in range(k):
        unseen = np.full(n, -20.0)
        if mixed[c]:
            z = np.column_stack([x[:, own[c]], before])
            w = _fit(z, y[:, c])
            size = len(own[c])
            chain.weights[c, own[c]], chain.links[c, :c], chain.bias[c] = w[:size], w[size:-1], w[-1]
            for f in range(FOLDS):
                some = y[fold != f, c]
                if 0 < some.sum() < len(some):
                    w = _fit(z[fold != f], some)
                    unseen[fold == f] = z[fold == f] @ w[:-1] + w[-1]
        elif n and y[:, c].all():
            chain.bias[c] = 20.0
            unseen[:] = 20.0
        before = np.column_stack([before, np.clip(unseen, -8, 8)])
    return chain


def screened(found: DataFrame, members: list[str]) -> list[np.ndarray]:
    """For each of the 0/1 columns ``members`` the features (buckets, in order) that its texts have more often than
    others, beyond chance; ``found`` has a row per text, with ``buckets``.

    That a text lacks what others have is no evidence.
    """
    sizes = found.agg(F.count("*").alias("n"), *[F.sum(m).alias(m) for m in members]).first()
    total = max(sizes.n, 1)
    counts = (
        found.select(F.explode("buckets").alias("bucket"), *members)
        .groupBy("bucket")
        .agg(F.count("*").alias("n"), *[F.sum(m).alias(m) for m in members])
        .where("n >= 3")
    )
    counts = stored(counts, "feature-counts")  # at most BUCKETS rows
    out = []
    p = F.col("n") / F.lit(float(total))
    for m in members:
        n1, n0 = max(sizes[m] or 0, 1), max(total - (sizes[m] or 0), 1)
        error = F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * F.lit(1 / n1 + 1 / n0))
        z = (F.col(m) / F.lit(float(n1)) - (F.col("n") - F.col(m)) / F.lit(float(n0))) / error
        best = counts.select("bucket", z.alias("z")).where(F.col("z") >= SCREEN).orderBy(F.col("z").desc(), "bucket").limit(KEPT)
        out.append(np.array(sorted(r.bucket for r in best.collect()), dtype=np.int64))
    return out


def having(found: DataFrame, features: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(order, label) of each text, in that order, and which of the features it has."""
    known = F.array(*map(F.lit, features.tolist())).cast("array<int>")
    rows = found.select("order", "label", F.array_intersect("buckets", known).alias("buckets")).collect()
    rows.sort(key=lambda r: (r.order, r.label))
    x = np.zeros((len(rows), len(features)))
    for i, r in enumerate(rows):
        x[i, np.searchsorted(features, np.array(r.buckets, dtype=np.int64))] = 1.0
    return [(r.order, r.label) for r in rows], x


def learn(docs: DataFrame, labels: DataFrame, texts: int = TEXTS) -> Chain:
    """Fit on at most ``texts`` labelled documents of each kind, whole texts.

    Ids are chosen from the labels before any text is read, so documents are joined with a bounded set.
    """
    bounded_batches(docs.sparkSession)
    marked = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
    )
    share = F.lit(0.0)
    for value, count in marked.groupBy("label").count().collect():
        share = F.when(F.col("label") == value, F.lit(min(1.0, 2.0 * (texts + 20) / count))).otherwise(share)
    unit = F.shiftrightunsigned(F.xxhash64(F.lit("label"), "doc_id"), 11) / F.lit(float(1 << 53))
    chosen = marked.where(unit < share)  # about 2 * texts ids of each kind, whatever the size of labels
    sample = sampled(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "label", texts)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one text at a time, however long
                found = buckets_of(batch.column(2)[i].as_py())
                one = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.array(found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), one], ["label", "order", "buckets"]
                )

    found = sample.select("label", "order", "text").mapInArrow(features, "label int, order long, buckets array<int>")
    found = stored(found, "features")
    first = screened(found, ["label"])[0]
    keys, x = having(found, first)
    y = category_labels(x, np.array([label for _, label in keys], dtype=float))
    if not keys:
        return fit_chain(first, x, y, [np.zeros(0, dtype=np.int64)] * len(CATEGORIES))
    # The features of each category, now that it is known which texts are its members.
    members = [f"c{k}" for k in range(len(CATEGORIES))]
    placed = [(*key, *map(int, row)) for key, row in zip(keys, y, strict=True)]
    placed = found.sparkSession.createDataFrame(placed, "order long, label int, " + ", ".join(f"{m} int" for m in members))
    own = screened(found.join(F.broadcast(placed), ["order", "label"]), members)
    union = np.unique(np.concatenate(own))
    _, x = having(found, union)
    return fit_chain(union, x, y, [np.searchsorted(union, o) for o in own])


def score(texts: list[str | None], chain: Chain) -> np.ndarray:
    """Probabilities, a row per text and a column per category."""
    known = _looked_up(chain)
    x = np.zeros((len(texts), len(chain.features)))
    for i, text in enumerate(texts):
        for word in words_of(text):
            places = known.get(word)
            if places is None:
                places = tuple(_places(word, chain.features))
                if len(word) <= MEMO_LONGEST:
                    if len(known) >= MEMO:
                        known.clear()
                    known[word] = places
            for place in places:
                x[i, place] = 1.0
    odds = np.zeros((len(texts), 0))
    for c in range(len(CATEGORIES)):
        z = x @ chain.weights[c] + odds @ chain.links[c, : odds.shape[1]] + chain.bias[c]
        odds = np.column_stack([odds, np.clip(z, -8, 8)])
    return 1.0 / (1.0 + np.exp(-odds))


#: Words whose features a Python worker keeps in mind, none of more characters than that, and the chain that they belong to.
MEMO, MEMO_LONGEST = 200_000, 64
_memo: dict = {}


def _looked_up(chain: Chain) -> dict[str, tuple[int, ...]]:
    key = chain.features.tobytes()
    if key not in _memo:
        _memo.clear()
        _memo[key] = {}
    return _memo[key]


def _places(word: str, features: np.ndarray) -> list[int]:
    found = []
    for bucket in _buckets(word):
        place = int(np.searchsorted(features, bucket))
        if place < len(features) and features[place] == bucket:
            found.append(place)
    return found


def judged(text: Column, chain: Chain) -> Column:
    """A struct of RESULT for each text."""
    sent = SparkSession.getActiveSession().sparkContext.broadcast(chain)  # at most categories x categories x KEPT numbers

    @F.arrow_udf(RESULT)
    def toxicity(values: pa.Array) -> pa.Array:
        at_work("toxicity", _memo.clear)
        p = score(values.to_pylist(), sent.value)
        columns = [pa.array(p[:, -1] >= THRESHOLD), pa.array(p[:, -1])]
        columns += [pa.array(p[:, c]) for c in range(len(CATEGORIES) - 1)]
        return pa.StructArray.from_arrays(columns, ["toxic", "score", *CATEGORIES[:-1]])

    return toxicity(text)


def toxicity_table(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, toxic, score and the category probabilities, a row for each of ``docs``."""
    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", judged(F.col("text"), chain).alias("p")).select("doc_id", "p.*")


def without_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` without the toxic ones, all columns kept."""
    bounded_batches(docs.sparkSession)
    return docs.where(~judged(F.col("text"), chain)["toxic"])
