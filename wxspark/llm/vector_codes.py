"""Vector code compression: parts of vectors as numbers of codebook entries, by an integer Walsh-Hadamard transform.

Components become whole numbers and vectors are cut into PARTS equal parts. The nearest entry of a part is searched in
the transformed space: parts and entries, filled up with zeros to a power of two, are transformed by additions alone; the squared
differences of the coefficients, in the order of their sequency (changes of sign), add up to the squared distance times the padded
length. After each few coefficients entries are dropped whose sum so far exceeds the whole distance of the best one yet, so
most entries are given up early and the result is exact. No floating point is used; where sums might not fit into 64
bits they are Python's whole numbers.

Codebooks begin with the parts of the vectors of the smallest ids and are refined in ROUNDS passes: each task adds up the
parts of each entry, Spark sums the sums, and the driver, which holds the codebooks only, takes their floors.

Null vectors and vectors with a null, infinite or undefined component are dropped. Null ids come after all others and are
coded. Equal ids are in the order of their components; repeated rows are coded alike and count as often as they occur. Ties go
to the lower entry. Vectors that are shorter than the longest, or whose length is no multiple of PARTS, are read as if zeros
followed. Null labels are one label. Other columns are not looked at. An empty table gives an empty result. A squared
distance, or sum of a part's components, beyond 64 bits is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import bounded_batches, stored
from wxspark.operators.joins import bounded_lookup

#: Parameters: parts of a vector, entries of a part's codebook (two hexadecimal digits name one), rounds, and the scale of
#: components.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Coefficients that are added up before entries are dropped.
STEP = 4
#: Entries are dropped one by one when at most one in so many is left; before, adding to all of them is faster.
FEW_LEFT = 24
#: Tasks that merge the smallest ids of all others.
MERGERS = 64
RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"

Codebooks = np.ndarray  # part, entry, position: whole numbers


def sequency_order(n: int) -> np.ndarray:
    """Places of the coefficients of a fast transform of length ``n`` (a power of two), fewest changes of sign first."""
    changes = np.zeros(n, dtype=np.int64)
    for k in range(n):
        signs = np.array([bin(k & i).count("1") & 1 for i in range(n)])
        changes[k] = np.count_nonzero(signs[1:] != signs[:-1])
    return np.argsort(changes, kind="stable")


def padded_length(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def transform(parts: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows, padded with zeros, coefficients in the order of their sequency."""
    n = padded_length(parts.shape[1])
    out = np.zeros((len(parts), n), dtype=parts.dtype)
    out[:, : parts.shape[1]] = parts
    half = 1
    while half < n:
        pairs = out.reshape(len(parts), n // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(parts), n)
        half *= 2
    return out[:, sequency_order(n)]


def _fitting(*arrays: np.ndarray) -> type:
    """A type of numbers in which transformed squared distances between rows of the arrays are exact."""
    n = padded_length(arrays[0].shape[-1])
    reach = 2 * max((int(abs(a).max()) for a in arrays if a.size), default=0)
    most = n * n * reach * reach  # the padded length times the squared distance
    return np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object


class Nearest:
    """Search in one part's codebook."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self._transformed: dict[type, np.ndarray] = {}

    def __call__(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row and the squared distance to it."""
        if not parts.shape[1]:
            return np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64)
        kind = _fitting(parts, self.entries)
        if kind not in self._transformed:
            self._transformed[kind] = transform(self.entries.astype(kind))
        h, g = transform(parts.astype(kind)), self._transformed[kind]
        n = h.shape[1]
        sums = np.zeros((len(h), len(g)), dtype=kind)
        for done in range(0, n, STEP):
            for j in range(done, min(done + STEP, n)):
                d = np.subtract.outer(h[:, j], g[:, j])
                sums += np.multiply(d, d, out=d)
            if done + STEP < n:
                best = np.argmin(sums, axis=1)
                rest = h[:, done + STEP :] - g[best, done + STEP :]
                bound = sums[np.arange(len(h)), best] + (rest * rest).sum(axis=1)  # the whole sum of a likely entry
                near = sums <= bound[:, None]
                if np.count_nonzero(near) * FEW_LEFT <= near.size:
                    return self._among(h, g, sums, bound, near, done + STEP)
        code = np.argmin(sums, axis=1)
        return code, sums[np.arange(len(h)), code] // n

    @staticmethod
    def _among(h, g, sums, bound, near, done) -> tuple[np.ndarray, np.ndarray]:
        """The search gone on, from coefficient ``done``, with the pairs of row and entry that are left."""
        n = h.shape[1]
        row, entry = np.nonzero(near)
        left = sums[row, entry]
        for j in range(done, n, STEP):
            d = h[row, j : j + STEP] - g[entry, j : j + STEP]
            left = left + (d * d).sum(axis=1)
            still = left <= bound[row]
            row, entry, left = row[still], entry[still], left[still]
        first = np.searchsorted(row, np.arange(len(h)))  # every row has its likely entry left
        least = np.minimum.reduceat(left, first) if len(first) else left
        hits = np.flatnonzero(left == least[row])  # by row, then entry: the first of a row is the lowest
        chosen = hits[np.searchsorted(row[hits], np.arange(len(h)))]
        return entry[chosen], least // n


def whole_numbers(column: pa.Array) -> tuple[np.ndarray, pa.ListArray]:
    """Places of the vectors that are not dropped, and floor(SCALE * x) of their components."""
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    x = column.values.to_numpy(zero_copy_only=False)  # nulls are undefined numbers here
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    kept = np.flatnonzero(valid & (bad[offsets[1:]] == bad[offsets[:-1]]))
    sizes = np.diff(offsets)[kept]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[kept] - (ends - sizes), sizes)
    scaled = np.floor(x[at] * SCALE)  # a power of two: exact
    if np.abs(scaled).max(initial=0) >= 1 << 62:
        raise ValueError(f"a component times {SCALE} is beyond 62 bits")
    starts = np.concatenate([[0], ends]).astype(np.int32)
    return kept, pa.ListArray.from_arrays(pa.array(starts), pa.array(scaled.astype(np.int64)))


def kept_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, label, n (components), numbers (array of long): the rows that are not dropped."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, numbers = whole_numbers(batch.column(2))
            at = pa.array(kept)
            sizes = pa.array(np.diff(numbers.offsets.to_numpy()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), sizes, numbers], ["vec_id", "label", "n", "numbers"]
            )

    kind = vectors.schema["label"].dataType.simpleString()
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col(column).cast("array<double>"))
    return plain.mapInArrow(work, f"vec_id long, label {kind}, n int, numbers array<bigint>")


def _parts(column: pa.Array, length: int) -> np.ndarray:
    """Row, part, position: the vectors cut, with zeros behind those that are short."""
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(column), PARTS * length), dtype=np.int64)
    flat = column.values.to_numpy()
    if (sizes == PARTS * length).all():
        out[:] = flat[offsets[0] : offsets[-1]].reshape(out.shape)
    else:
        for i, size in enumerate(sizes):
            out[i, :size] = flat[offsets[i] : offsets[i] + size]
    return out.reshape(len(column), PARTS, length)


def first_codebooks(kept: DataFrame, length: int) -> Codebooks:
    """The parts of the vectors of the smallest ids, by id and then by components; ENTRIES at most.

    Each task keeps its own smallest, MERGERS tasks those of all tasks, and the driver gets ENTRIES rows of each of these.
    """
    width = PARTS * length

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = []
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keyed = ((i is None, i or 0, v + [0] * (width - len(v))) for i, v in zip(ids, rows, strict=True))
            best = nsmallest(ENTRIES, [*best, *keyed])
        ids = pa.array([None if b[0] else b[1] for b in best], pa.int64())
        yield pa.RecordBatch.from_arrays([ids, pa.array([b[2] for b in best], pa.list_(pa.int64()))], ["vec_id", "numbers"])

    schema = "vec_id long, numbers array<bigint>"
    own = kept.select("vec_id", "numbers").mapInArrow(smallest, schema)
    merged = own.repartition(MERGERS).mapInArrow(smallest, schema)
    rows = sorted((r.vec_id is None, r.vec_id or 0, r.numbers) for r in merged.collect())[:ENTRIES]
    first = np.array([r[2] for r in rows], dtype=np.int64).reshape(len(rows), PARTS, length)
    return np.ascontiguousarray(first.swapaxes(0, 1))


def refined(kept: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry becomes the floored mean of the parts that are nearest to it; unused ones stay."""
    length = books.shape[2]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = [Nearest(b) for b in books]
        total, count = np.zeros(books.shape, dtype=np.int64), np.zeros(books.shape[:2], dtype=np.int64)
        reach = 0
        for batch in batches:
            parts = _parts(batch.column(0), length)
            reach += int(np.abs(parts).max(initial=0)) * len(parts)
            if reach >= 1 << 63:
                raise OverflowError("the components of a task's vectors add up beyond 64 bits")
            for k in range(PARTS):
                code, _ = nearest[k](parts[:, k])
                np.add.at(total[k], code, parts[:, k])
                count[k] += np.bincount(code, minlength=books.shape[1])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
                pa.array(list(total[part, entry]), pa.list_(pa.int64())),
            ],
            ["part", "entry", "count", "total"],
        )

    per_task = kept.select("numbers").mapInArrow(sums, "part int, entry int, count long, total array<bigint>")
    each = [F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(length)]
    rows = per_task.groupBy("part", "entry").agg(F.sum("count").alias("count"), *each).collect()  # a row per entry
    new = books.copy()
    for row in rows:
        new[row.part, row.entry] = [t // row["count"] for t in row[3:]]
    return new


def learn(kept: DataFrame, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of ``kept_vectors``, which is read once more each round and should be a stored table."""
    longest = kept.agg(F.max("n")).first()[0]
    length = -(-(longest or 0) // PARTS)
    books = first_codebooks(kept, length)
    for _ in range(rounds if books.shape[1] else 0):
        books = refined(kept, books)
    return books


def fingerprint(books: Codebooks) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def codes(kept: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits a part), error (squared distance to the entries)."""
    length = books.shape[2]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = [Nearest(b) for b in books]
        for batch in batches:
            parts = _parts(batch.column(2), length)
            found = [nearest[k](parts[:, k]) for k in range(PARTS)]
            error = sum(f[1].astype(object) for f in found)
            code = np.stack([f[0] for f in found], axis=1).astype(np.uint8).tobytes().hex()
            text = [code[2 * PARTS * i : 2 * PARTS * (i + 1)] for i in range(len(parts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(error.tolist(), pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    kind = kept.schema["label"].dataType.simpleString()
    return kept.select("vec_id", "label", "numbers").mapInArrow(work, f"vec_id long, label {kind}, code string, error long")


def decode(code: str, books: Codebooks) -> np.ndarray:
    """The whole numbers that a code stands for."""
    return np.concatenate([books[k][e] for k, e in enumerate(bytes.fromhex(code))])


def code_table(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The columns of RESULT, a row for each vector that is not dropped."""
    bounded_batches(vectors.sparkSession)
    kept = stored(kept_vectors(vectors, column), "vectors")
    books = learn(kept)
    coded = stored(codes(kept, books), "codes")
    # A null label is a key of its own; labels may be as many as vectors, and one may be on most of them.
    keyed = coded.withColumns({"unlabelled": F.col("label").isNull(), "key": F.coalesce(F.col("label").cast("string"), F.lit(""))})
    sums = stored(keyed.groupBy("unlabelled", "key").agg(F.sum("error").alias("label_error")), "label-errors")
    joined = bounded_lookup(keyed, sums, ["unlabelled", "key"], "vec_id")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))
