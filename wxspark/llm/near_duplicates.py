"""Near-duplicate groups by HyperMinHash.

A document is the set of its shingles of SHINGLE words, each a 64-bit hash. The hash's leading bits name one of
REGISTERS buckets; of the smallest hash in a bucket its register keeps the number of leading zeros and the
MANTISSA bits after the first one, 16 bits in all. An empty register borrows from a full one in a fixed order, so
short texts fill all of them too. Some neighbouring registers make a band, as many as the threshold
allows (band_rows); documents that agree in a band are
candidates. Candidates are estimated from all registers, less the agreement that registers of so few bits show by
chance, and what passes is confirmed on the full sets.

Large groups need neither all pairs nor a cap: copies with equal sets are one node; in a band of up to SMALL nodes
all pairs are candidates, in a larger one the pairs of its leader, the node with most company over all bands.
When the links so found have been joined to components, the members of a large band that are outside its main
component are compared with all of its members in other components, chunk against chunk: a task that compares two chunks
has their registers and full sets, confirms what the registers let through, and gives out only links that connect
components which no link of its own connects yet. So rejected pairs are never rows, and the links of a chunk are fewer than its
members. So each pair that shares a band has been compared, or is connected anyway. At a similarity of exactly the threshold a pair shares no band
with a chance of 1e-6 for 0.85 and 3e-6 for 0.8, if registers are independent; above, less. The estimate lets
pairs through from ERRORS standard errors below the threshold on (0.71 for 0.85, 0.64 for 0.8), as borrowed registers
spread more than independent ones. Simulated, 256,000 pairs a threshold, of unions of 7 to 200 shingles at the threshold
or just above: the bands lost 0 at 0.85 and 2 at 0.8, and no estimate was more than 0.11 (0.12) below the threshold.
So both together lost none of 256,000 at 0.85 and 2 at 0.8.

Null, empty and blank texts have no shingles, are linked with nothing and stay. Very long texts are compared whole. A text of fewer than SHINGLE
words is one shingle. Null ids are never the smallest of a group: one whose set another id has too gets that id's
group and is not kept; a set that only null ids have is not compared, has a null group and stays. Rows that repeat
an id are the same document and fare alike if their texts are equal; with different texts each is grouped by its
own. Other columns pass through or are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import at_work, bounded_batches, few, stored

SHINGLE = 5
#: 100 * intersection >= threshold * union; this one, if a caller names none.
THRESHOLD = 85
REGISTERS, MANTISSA = 256, 10
#: A pair at the threshold may share no band with this chance at most.
MISSED = 5e-6
SMALL = 8
#: Nodes of a large band that are compared at once with as many others, and bytes of their sets.
CHUNK, CHUNK_BYTES = 512, 8 << 20
#: Standard errors of REGISTERS independent draws that an estimate may lie below the threshold.
ERRORS = 6.4
#: Words whose hashes a Python worker remembers, none of more bytes than that.
REMEMBERED, LONGEST = 400_000, 64

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        known = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = known
        return known


_hashes = _Hashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread unsigned 64-bit numbers evenly, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct shingle hashes of a whole text, sorted."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total = total * _STEP + h[k : len(h) - width + 1 + k]
        total ^= total >> np.uint64(29)
    return np.unique(mixed(total))


def _borrowed() -> np.ndarray:
    """For each register, the order in which it asks others: a fixed shuffle of all."""
    keys = mixed(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(1)).reshape(REGISTERS, REGISTERS)
    return np.argsort(keys, axis=1, kind="stable")


_ORDER = _borrowed()
_BUCKET_BITS = REGISTERS.bit_length() - 1


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers of a sorted, non-empty set."""
    starts = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(64 - _BUCKET_BITS)
    at = np.searchsorted(hashes, starts)
    found = hashes[np.minimum(at, len(hashes) - 1)]
    full = (at < len(hashes)) & ((found >> np.uint64(64 - _BUCKET_BITS)) == np.arange(REGISTERS, dtype=np.uint64))
    if not full.all():
        empty = np.flatnonzero(~full)
        lender = _ORDER[empty, np.argmax(full[_ORDER[empty]], axis=1)]
        found[empty] = found[lender]
    rest = (found << np.uint64(_BUCKET_BITS)) >> np.uint64(16)  # 48 bits, exact as floats
    _, exponent = np.frexp(rest.astype(np.float64))  # of 0 it is 0
    zeros = 48 - exponent
    after = (rest << (zeros + 17).astype(np.uint64)) >> np.uint64(64 - MANTISSA)  # the bits behind the first one
    after[rest == 0] = 0
    return ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | after).astype(np.uint16)


def band_rows(threshold: int) -> int:
    """The most registers a band can have if pairs at the threshold shall be missed with MISSED at most."""
    fit = [r for r in range(1, REGISTERS + 1) if (1 - (threshold / 100) ** r) ** (REGISTERS // r) <= MISSED]
    return max(fit, default=1)


def band_keys(regs: np.ndarray, rows: int) -> np.ndarray:
    """A hash of each band's registers, ``rows`` a band."""
    bands = REGISTERS // rows
    of_band = regs[: bands * rows].reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        key = mixed(key * _STEP + of_band[:, k] + np.uint64(1))
    return key.astype(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of rows of registers, corrected for equality by chance.

    Two different minima show equal registers with the chance that a geometric number of zeros and MANTISSA
    uniform bits agree: 1/3 * 2^-MANTISSA.
    """
    chance = 2.0**-MANTISSA / 3.0
    equal = (a == b).mean(axis=1)
    return np.clip((equal - chance) / (1.0 - chance), 0.0, 1.0)


def let_through(a: np.ndarray, b: np.ndarray, threshold: int) -> np.ndarray:
    """Whether rows of registers may be of sets that reach the threshold."""
    least = threshold / 100
    return estimate(a, b) >= least - ERRORS * np.sqrt(least * (1 - least) / REGISTERS)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, node (128-bit hash of the set, null for none), registers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("near-duplicates", _hashes.clear)
        for batch in batches:
            counts, nodes, regs = [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingle_set(text)
                counts.append(len(hashes))
                nodes.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                regs.append(registers(hashes).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), pa.array(regs, pa.binary())],
                ["doc_id", "n_shingles", "node", "registers"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, "doc_id long, n_shingles long, node binary, registers binary"
    )


def _bands(nodes: DataFrame, rows: int) -> DataFrame:
    """band, node, n: a row per node and band."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [band_keys(np.frombuffer(r, dtype=np.uint16), rows) for r in batch.column(2).to_pylist()]
            if keys:
                index = pa.array(np.repeat(np.arange(len(keys)), REGISTERS // rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), batch.column(0).take(index), batch.column(1).take(index)],
                    ["band", "node", "n"],
                )

    return nodes.select("node", "n", "registers").mapInArrow(work, "band long, node binary, n long")


def _pairs(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    """Node pairs (a < b) that share a band of two tables, of sizes near enough for the threshold."""
    other = right.select("band", F.col("node").alias("other"), F.col("n").alias("m"))
    joined = left.join(other, "band").where(F.col("node") != F.col("other"))
    near = 100 * F.least("n", "m") >= threshold * F.greatest("n", "m")
    return joined.where(near).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))


def _connections(open_bands: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links between different components of large bands: enough to connect all that are linked there."""
    chunks = F.greatest(F.lit(1), F.ceil(F.col("size") / CHUNK), F.ceil(F.col("shingles") * 8 / CHUNK_BYTES)).cast("int")
    whole = (
        open_bands.select("band", "node", "n", "comp", (F.col("comp") != F.col("main")).alias("apart"), chunks.alias("chunks"))
        .withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
        .join(nodes.select("node", "registers"), "node")
        .join(sets, "node")
    )
    beside = whole.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return (
        beside.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
        .select("band", "low", "high", "chunk", "node", "n", "comp", "apart", "registers", "set")
        .groupBy("band", "low", "high")
        .applyInArrow(lambda table: _connecting(table, threshold), "a binary, b binary")
        .distinct()
    )


def _connecting(table: pa.Table, threshold: int) -> pa.Table:
    """Links between the members of two chunks of a band, or within one, that connect components.

    A pair is compared in the first band that it shares only; if that is a small one, it is known already.
    """
    band, low, high = (table.column(c)[0].as_py() for c in ("band", "low", "high"))
    node, comp = table.column("node").to_pylist(), table.column("comp").to_pylist()
    n, apart, chunk = (table.column(c).to_numpy() for c in ("n", "apart", "chunk"))
    regs = np.frombuffer(b"".join(table.column("registers").to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
    sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("set").to_pylist()]
    rows = band_rows(threshold)
    keys = np.array([band_keys(r, rows) for r in regs])
    root = {c: c for c in comp}

    def find(c: bytes) -> bytes:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    left, right = [], []
    for i in range(len(node)):
        if chunk[i] != low:
            continue
        others = np.arange(i + 1, len(node)) if low == high else np.flatnonzero(chunk == high)
        others = others[(apart[i] | apart[others]) & (100 * np.minimum(n[others], n[i]) >= threshold * np.maximum(n[others], n[i]))]
        mine = find(comp[i])
        others = others[[find(comp[j]) != mine for j in others]] if len(others) else others
        others = others[let_through(regs[others], regs[i], threshold)]
        others = others[keys[i][np.argmax(keys[others] == keys[i], axis=1)] == band]
        if not len(others):
            continue
        sizes = n[others]
        shared = _shared(sets[i], [sets[j] for j in others])
        for j in others[100 * shared >= threshold * (len(sets[i]) + sizes - shared)]:
            one, other = find(comp[i]), find(comp[j])
            if one != other:
                root[other] = one
                left.append(min(node[i], node[j]))
                right.append(max(node[i], node[j]))
    return pa.table([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])


def _shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements each of the others, none of them empty, has in common with a set; all are sorted."""
    flat = np.concatenate(others)
    there = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
    starts = np.cumsum([0, *(len(o) for o in others[:-1])])
    return np.add.reduceat(there.astype(np.int64), starts)


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, set: the full sets of the nodes in ``wanted``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("near-duplicates", _hashes.clear)
        for batch in batches:
            found = [shingle_set(t).tobytes() for t in batch.column(0).to_pylist()]
            nodes_of = [xxhash.xxh3_128_digest(f) for f in found]
            yield pa.RecordBatch.from_arrays([pa.array(nodes_of, pa.binary()), pa.array(found, pa.binary())], ["node", "set"])

    ids = few(wanted.join(nodes, "node").select(F.col("first_id").alias("doc_id")).distinct(), "pair-documents")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    # Of rows that repeat an id, those with other texts have other nodes, and equal ones are one set.
    return texts.select("text").mapInArrow(sets, "node binary, set binary").groupBy("node").agg(F.first("set").alias("set"))


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, threshold: int) -> DataFrame:
    """The pairs that the registers let through and the full sets confirm."""

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (
                    np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
                    for k in (2, 3)
                )
                good = pa.array(let_through(a, b, threshold))
                yield pa.RecordBatch.from_arrays([batch.column(k).filter(good) for k in (0, 1)], ["a", "b"])

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= threshold * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(good, pa.bool_())) for k in (0, 1)], ["a", "b"])

    def beside(rows: DataFrame, values: DataFrame, value: str) -> DataFrame:
        for end in ("a", "b"):
            own = values.select(F.col("node").alias(end), F.col(value).alias(f"{value}_{end}"))
            rows = rows.join(own, end)
        return rows.select("a", "b", f"{value}_a", f"{value}_b")

    passed = stored(beside(pairs, nodes, "registers").mapInArrow(likely, "a binary, b binary"), "likely-pairs")
    full = _sets(passed.select(F.col("a").alias("node")).union(passed.select("b")).distinct(), nodes, docs)
    return stored(beside(passed, full, "set").mapInArrow(confirmed, "a binary, b binary"), "links")


def components(links: DataFrame) -> DataFrame:
    """node, comp: the smallest node reachable, for every node with a link.

    Labels spread over links and are shortened by each label's own label, until none changes; each step is
    written to the shared folder.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("next")).union(links.select("b", "a"))
    both = stored(both.distinct(), "neighbours")
    labels = stored(both.groupBy("node").agg(F.min(F.least("node", "next")).alias("comp")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("next"), "comp")
        spread = both.join(seen, "next").select("node", "comp").union(labels).groupBy("node").agg(F.min("comp").alias("comp"))
        jump = spread.join(labels.select(F.col("node").alias("comp"), F.col("comp").alias("further")), "comp", "left")
        old = labels.select("node", F.col("comp").alias("old"))
        new = stored(
            jump.select("node", F.least("comp", F.coalesce("further", "comp")).alias("comp")).join(old, "node"), "labels"
        )
        labels = new.select("node", "comp")
        if new.where(F.col("comp") != F.col("old")).isEmpty():
            return labels


def grouped(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, a row for each of ``docs``; ``threshold`` is in hundredths."""
    bounded_batches(docs.sparkSession)
    signed = stored(signatures(docs), "signatures")
    nodes = stored(
        signed.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")),
        "nodes",
    )
    banded = _bands(nodes, band_rows(threshold))
    sizes = banded.groupBy("band").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    shared = stored(banded.join(sizes, "band"), "shared-bands")

    company = shared.groupBy("node").agg(F.sum(F.col("size") - 1).alias("company"))
    small, large = shared.where(F.col("size") <= SMALL), shared.where(F.col("size") > SMALL)
    leaders = (
        large.join(company, "node")
        .groupBy("band")
        .agg(F.max(F.struct("company", "node", "n")).alias("l"))
        .select("band", F.col("l.node").alias("node"), F.col("l.n").alias("n"))
    )
    first = stored(_pairs(small, small, threshold).union(_pairs(leaders, large, threshold)).distinct(), "pairs")
    links = _links(first, nodes, docs, threshold)
    labels = components(links)

    # Large bands that still hold several components.
    placed = large.join(labels, "node", "left").select(
        "band", "node", "n", "size", F.coalesce("comp", "node").alias("comp")
    )
    parts = placed.groupBy("band", "comp").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    largest = parts.groupBy("band").agg(
        F.max(F.struct("members", "comp"))["comp"].alias("main"), F.count("*").alias("parts"), F.sum("shingles").alias("shingles")
    )
    open_bands = stored(placed.join(largest.where(F.col("parts") > 1), "band"), "open-bands")
    if not open_bands.isEmpty():
        sets = stored(_sets(open_bands.select("node").distinct(), nodes, docs), "sets")
        more = stored(_connections(open_bands, nodes, sets, threshold), "links")
        if not more.isEmpty():
            labels = components(links.union(more))

    named = nodes.select("node", "first_id").join(labels, "node", "left")
    smallest = named.where(F.col("comp").isNotNull()).groupBy("comp").agg(F.min("first_id").alias("least"))
    ids = named.join(smallest, "comp", "left").select("node", F.coalesce("least", "first_id").alias("group_id"))
    return signed.join(ids, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("group_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("group_id", "doc_id"), F.col("group_id").isNull()).alias("kept"),
    )


def deduplicated(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each group, all columns kept. Null ids stay."""
    dropped = grouped(docs, threshold).where(~F.col("kept") & F.col("doc_id").isNotNull())
    gone = few(dropped.select(F.col("doc_id").alias("gone")), "gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone"], "left_anti")
