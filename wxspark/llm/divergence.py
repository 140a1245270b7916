"""Source divergence audit: how far the word shares of each source lie from its language's other sources and from
the language as a whole.

Terms are counted by length-bucketed packing. A batch of texts is one buffer of bytes: terms are found, and those of up to 8
bytes become one unsigned 64-bit word, those of up to 16 two, by reading the buffer at their places. Words are radix-sorted,
16 bits a pass, and runs of equal ones counted; longer terms are sorted as bytes, in a bucket for each doubling of the
length. The counts of a task are merged as they are made, so a row per (lang, source, term) and flush reaches the shuffle
however often the term occurs.

Shares are smoothed and scaled to whole numbers, in decimals where a long could overflow. Terms that a source lacks are never rows:
they all have one share there. Pairs of sources are summed block by block of a language's terms, each block for a chunk of its
sources against another, so a task holds BLOCK_TERMS x 2 CHUNK shares at most and gives out sums only.

Null texts, langs and sources count as empty ones, and the empty lang and source are a lang and a source. Every
row is a document, also one that repeats another. A lang without kept terms has pairs of value 0 and no terms; a source that is alone in its lang
has no pairs. Very long texts and terms are counted whole. Other columns are not looked at. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxspark.llm.common import FEW, bounded_batches, few, stored

#: Parameters of the audit: documents that a kept term is in at least, what is added to each count, the scale of shares, and
#: the most divergent terms that are reported of a source.
LEAST_DOCUMENTS, ADDED, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Terms of a block and sources of a chunk.
BLOCK_TERMS, CHUNK = 4_096, 128
#: Parts in which a source's terms are ranked before they are ranked together.
PARTS = 32
#: A task hands its counts on beyond so many bytes of terms, and merges them when as many have been added.
FLUSH_BYTES, MERGE_BYTES = 64 << 20, 8 << 20
RESULT = "lang string, source string, part string, item string, value long, rank int"
COUNTS = "lang string, source string, term string, n long, docs long"

#: Byte to what it counts as: small letters for capitals, 0 for bytes that are in no term.
_LETTER = np.zeros(256, dtype=np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by unsigned columns, the first one being the most significant: a pass for each 16 bits
    that differ."""
    order = np.arange(len(columns[0]))
    for column in reversed(columns):
        differing = int(np.bitwise_or.reduce(column ^ column[0])) if len(column) else 0
        for shift in range(0, column.dtype.itemsize * 8, 16):
            if (differing >> shift) & 0xFFFF:
                digit = (column[order] >> column.dtype.type(shift)).astype(np.uint16)
                order = order[np.argsort(digit, kind="stable")]  # of 16 bits: numpy's radix sort
    return order


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """Where a sorted row differs from the one before; the first does."""
    out = np.zeros(len(columns[0]), dtype=bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


class Bucket:
    """Counted terms of one length class: columns of keys (group, then the term's words or bytes), n and docs."""

    def __init__(self, keys: list[np.ndarray], n: np.ndarray, docs: np.ndarray):
        self.keys, self.n, self.docs = keys, n, docs

    @staticmethod
    def _order(keys: list[np.ndarray]) -> np.ndarray:
        if keys[-1].dtype.kind == "S":
            by_bytes = np.argsort(keys[1], kind="stable")
            return by_bytes[radix_order([keys[0][by_bytes]])]
        return radix_order(keys)

    @classmethod
    def counted(cls, keys: list[np.ndarray], doc: np.ndarray) -> Bucket:
        """From a row per occurrence, in the order of documents."""
        order = cls._order(keys)
        keys, doc = [k[order] for k in keys], doc[order]
        new = _changes(keys)
        starts = np.flatnonzero(new)
        new_doc = (new | _changes([doc])).astype(np.int64)
        return cls([k[starts] for k in keys], np.diff(starts, append=len(doc)), np.add.reduceat(new_doc, starts))

    @classmethod
    def merged(cls, buckets: list[Bucket]) -> Bucket:
        keys = [np.concatenate([b.keys[i] for b in buckets]) for i in range(len(buckets[0].keys))]
        order = cls._order(keys)
        keys = [k[order] for k in keys]
        starts = np.flatnonzero(_changes(keys))
        n, docs = (np.concatenate([getattr(b, c) for b in buckets])[order] for c in ("n", "docs"))
        return cls([k[starts] for k in keys], np.add.reduceat(n, starts), np.add.reduceat(docs, starts))

    @property
    def nbytes(self) -> int:
        return sum(k.nbytes for k in self.keys) + self.n.nbytes + self.docs.nbytes

    def terms(self) -> list[bytes]:
        if self.keys[-1].dtype.kind == "S":
            return self.keys[1].tolist()
        words = np.stack(self.keys[1:], axis=1).astype(">u8")  # no term holds a zero byte, so padding falls off
        return np.ascontiguousarray(words).view(f"S{8 * words.shape[1]}").ravel().tolist()


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one behind the other, and where each begins and the last ends; null texts are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pack(column: pa.Array, group: np.ndarray) -> dict[int, Bucket]:
    """Terms of texts counted by group, as buckets by their width in bytes."""
    data, offsets = _texts(column)
    size = len(data)
    letters = np.zeros(size + 16, dtype=np.uint8)  # room to read whole words behind the last term
    letters[:size] = _LETTER[data]
    inside = letters[:size] > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < size]
    first[edges] = inside[edges]  # a term does not reach over the end of a text
    starts = np.flatnonzero(first)
    if not len(starts):
        return {}
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:][offsets[1:] > 0] - 1
    last[cuts] = inside[cuts]
    length = np.flatnonzero(last) + 1 - starts
    doc = np.searchsorted(offsets, starts, side="right") - 1  # of empty texts at one place the last
    words = np.ndarray(shape=(size + 9,), dtype=">u8", buffer=letters, strides=(1,))  # the word at each byte

    def word(at: np.ndarray, used: np.ndarray) -> np.ndarray:
        spare = (8 * (8 - np.minimum(used, 8))).astype(np.uint64)
        return (words[at].astype(np.uint64) >> spare) << spare

    out = {}
    short, middle = length <= 8, (length > 8) & (length <= 16)
    if short.any():
        at, d = starts[short], doc[short]
        out[8] = Bucket.counted([group[d], word(at, length[short])], d)
    if middle.any():
        at, d = starts[middle], doc[middle]
        whole = words[at].astype(np.uint64)
        out[16] = Bucket.counted([group[d], whole, word(at + 8, length[middle] - 8)], d)
    width = 32
    while (length > width // 2).any():
        some = np.flatnonzero((length > width // 2) & (length <= width))
        if len(some):
            raw = [letters[starts[i] : starts[i] + length[i]].tobytes() for i in some]
            out[width] = Bucket.counted([group[doc[some]], np.array(raw, dtype=f"S{width}")], doc[some])
        width *= 2
    return out


class Counter:
    """Counts of a task, by (lang, source) and term, within bounded memory."""

    def __init__(self):
        self._groups: dict[tuple[str, str], int] = {}
        self._merged: dict[int, Bucket] = {}
        self._added: dict[int, list[Bucket]] = {}

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        group = [self._groups.setdefault(name, len(self._groups)) for name in names]
        for width, bucket in pack(batch.column(2), np.array(group, dtype=np.uint32)).items():
            self._added.setdefault(width, []).append(bucket)
            if sum(b.nbytes for b in self._added[width]) > MERGE_BYTES:
                self._merge(width)
        if sum(b.nbytes for b in self._merged.values()) > FLUSH_BYTES:
            yield from self.flush()

    def _merge(self, width: int) -> None:
        parts = self._added.pop(width, [])
        if width in self._merged:
            parts.append(self._merged[width])
        self._merged[width] = Bucket.merged(parts)

    def flush(self) -> Iterator[pa.RecordBatch]:
        for width in list(self._added):
            self._merge(width)
        names = [c.split()[0] for c in COUNTS.split(", ")]
        langs, sources = zip(*self._groups) if self._groups else ((), ())
        langs, sources = pa.array(langs, pa.string()), pa.array(sources, pa.string())
        for bucket in self._merged.values():
            step = max(1, min(65_536, (4 << 20) // bucket.keys[-1].dtype.itemsize))
            for s in range(0, len(bucket.n), step):
                part = Bucket([k[s : s + step] for k in bucket.keys], bucket.n[s : s + step], bucket.docs[s : s + step])
                of = pa.array(part.keys[0].astype(np.int64))
                raw = pa.array(part.terms(), pa.binary())
                terms = pa.StringArray.from_buffers(len(raw), *raw.buffers()[1:])  # whole characters, as in the texts
                yield pa.RecordBatch.from_arrays([langs.take(of), sources.take(of), terms, pa.array(part.n), pa.array(part.docs)], names)
        self._groups, self._merged = {}, {}


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with it), a row per term of a group."""
    bounded_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in batches:
            yield from counter.add(batch)
        yield from counter.flush()

    named = docs.select(*_names(), "text")
    return named.mapInArrow(work, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _names() -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * kept)), exactly."""
    over = F.lit(SCALE).cast("decimal(10,0)") * (count + ADDED).cast("decimal(20,0)")
    under = (total + ADDED * kept).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", over, under)


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """The columns of RESULT: for each source its distance to each other one of the lang, and its ``top`` terms that are
    more frequent in it than in the lang."""
    groups = few(docs.select(*_names()).distinct(), "audit-groups")
    counts = stored(term_counts(docs), "audit-counts")
    by_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = stored(by_lang.where(F.col("docs") >= least_documents).select("lang", "term", "lang_n"), "audit-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    langs = few(langs, "audit-langs")

    used = stored(counts.drop("docs").join(_small(kept), ["lang", "term"]), "audit-used")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    sized = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    sized = few(
        sized.select(
            "lang", "source",
            F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept"), "lang_total",
            # the share of a term that the source lacks; none without kept terms
            F.when(F.col("kept") > 0, _share(zero, F.coalesce("total", zero), F.col("kept"))).alias("base"),
        ),
        "audit-sources",
    )
    shares = used.join(sized.where("kept > 0"), ["lang", "source"]).select(
        "lang", "source", "term", "kept", "base",
        _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    )
    return _pairs(shares, sized).unionByName(_terms(shares, top))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= FEW // 4 else df


def _terms(shares: DataFrame, top: int) -> DataFrame:
    """Ranked in parts first, so that no task sorts all terms of a source."""
    over = shares.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = [F.col("value").desc(), F.col("item").asc()]
    part = F.pmod(F.xxhash64("item"), F.lit(PARTS)).alias("in_part")
    first = F.row_number().over(Window.partitionBy("lang", "source", "in_part").orderBy(*order))
    few_left = over.select("*", part).withColumn("r", first).where(F.col("r") <= top)
    last = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    ranked = few_left.select("lang", "source", F.lit("term").alias("part"), "item", "value", last.alias("rank"))
    return ranked.where(F.col("rank") <= top)


def _pairs(shares: DataFrame, sized: DataFrame) -> DataFrame:
    """For each source of a lang each other one, by the sum of the differences of their shares."""
    sources = sized.groupBy("lang").agg(F.count("*").alias("sources"), F.max("kept").alias("kept"))
    chunks = F.ceil(F.col("sources") / CHUNK).cast("int")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("kept") / BLOCK_TERMS)).cast("int")
    layout = few(sources.where("sources > 1").select("lang", chunks.alias("chunks"), blocks.alias("blocks")), "audit-layout")
    chunk = F.pmod(F.xxhash64("source"), F.col("chunks")).cast("int")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    none = F.lit(None)
    # Every block of a lang has a row for each source of its chunk, so that sources without its terms take part.
    heads = sized.join(layout, "lang").select(
        "lang", "source", none.cast("string").alias("term"), F.coalesce("base", F.lit(0)).alias("p"),
        chunk.alias("chunk"), "chunks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    body = shares.join(layout, "lang").select("lang", "source", "term", "p", chunk.alias("chunk"), "chunks", block.alias("block"))
    partner = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    rows = heads.unionByName(body).select("lang", "source", "term", "p", "chunk", "block", partner.alias("partner"))
    rows = rows.select(
        "lang", "source", "term", "p", "block", "chunk",
        F.least("chunk", "partner").alias("low"), F.greatest("chunk", "partner").alias("high"),
    )
    part_sums = rows.groupBy("lang", "block", "low", "high").applyInArrow(_block_sums, "lang string, a string, b string, value long")
    # A block holds the terms that some source of the two chunks has; all others are missing from either.
    covered = part_sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    names = sized.select("lang", F.col("source").alias("a"), F.col("base").alias("base_a"), F.col("kept"))
    others = sized.select("lang", F.col("source").alias("b"), F.col("base").alias("base_b"))
    known = covered.join(names, ["lang", "a"]).join(others, ["lang", "b"])
    value = F.col("value") + F.coalesce(F.col("kept") * F.abs(F.col("base_a") - F.col("base_b")), F.lit(0))
    one_way = known.select("lang", "a", "b", value.alias("value"))
    both = one_way.unionByName(one_way.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "a").orderBy(F.col("value").desc(), F.col("b").asc()))
    return both.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value", rank.alias("rank"))


def _block_sums(table: pa.Table) -> pa.Table:
    """For each pair of sources of a block's chunks: the sum, over the terms that some source has, of how far their
    shares are apart, less how far the shares of missing terms are (which the caller adds for all kept terms)."""
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])
    lang = table.column("lang")[0].as_py()
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    source = table.column("source").combine_chunks().dictionary_encode()
    term = table.column("term").combine_chunks().dictionary_encode()
    names, at = source.dictionary.to_pylist(), source.indices.to_numpy(zero_copy_only=False)
    p, chunk = (table.column(c).to_numpy() for c in ("p", "chunk"))
    head = term.indices.is_null().to_numpy(zero_copy_only=False)
    base, of_chunk = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=np.int64)
    base[at[head]], of_chunk[at[head]] = p[head], chunk[head]
    shares = np.repeat(base[:, None], len(term.dictionary), axis=1)
    column = term.indices.fill_null(0).to_numpy(zero_copy_only=False)
    shares[at[~head], column[~head]] = p[~head]
    a, b, value = [], [], []
    for i, name in enumerate(names):
        partners = np.flatnonzero((of_chunk == high) & (np.array(names, dtype=object) > name)) if low == high else np.flatnonzero(of_chunk == high)
        if of_chunk[i] != low or not len(partners):
            continue
        apart = np.abs(shares[partners] - shares[i]).sum(axis=1) - len(term.dictionary) * np.abs(base[partners] - base[i])
        a += [name] * len(partners)
        b += [names[j] for j in partners]
        value += apart.tolist()
    return pa.table([[lang] * len(a), a, b, value], schema=schema)
