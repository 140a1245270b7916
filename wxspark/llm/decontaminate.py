"""Benchmark decontamination by a prefix-filtered set join; built-in functions only.

A benchmark item is cut into windows of WINDOW consecutive words (a shorter item is one window), and a window
into overlapping shingles of SHINGLE words. A document can contain a window only if it contains each of its
shingles, so one shingle, the rarest over all documents, is the window's necessary prefix: positions of prefix
shingles in documents give the candidates, the shingle's offset gives the only place where the window can stand
(positional bound), which must lie inside the document (length bound), and the words there are compared.

Documents are read and cut once; the places of item shingles are written to the shared folder with the words
about them, so that counting, prefix join and comparison read a small table. What is broadcast is a block of at
most BLOCK shingles of the items; more shingles make more blocks, each one more scan.

Null texts have no words. Very long texts are searched whole. Each row is judged on its own: rows that repeat an id and a text give equal rows, null
ids are kept. Items without words or text occur nowhere; a null item id is not counted as an item. Equal item
ids count once. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import ascii_lower, few, stored

WINDOW = 10
SHINGLE = 3
#: Shingles broadcast at once: 16 bytes each and a hash table's overhead, about 100 MB.
BLOCK = 1_000_000
#: Fixed value: everything that is no word character.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def windows_of(items: DataFrame) -> DataFrame:
    """item_id, window (its words), a row per different window of an item."""
    cut = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(1)))
    return (
        cut.select("item_id", "w", F.explode(starts).alias("s"))
        .select("item_id", F.slice("w", F.col("s"), F.lit(WINDOW)).alias("window"))
        .distinct()
    )


def shingles_of(windows: DataFrame) -> DataFrame:
    """window, size, at, shingle: every shingle of a window, with its size in words and its offset."""
    size = F.least(F.size("window"), F.lit(SHINGLE))
    return (
        windows.select("window", size.alias("size"))
        .select("window", "size", F.explode(F.sequence(F.lit(0), F.size("window") - F.col("size"))).alias("at"))
        .select("window", "size", "at", _hash(F.slice("window", F.col("at") + 1, F.col("size"))).alias("shingle"))
    )


def _hash(part: Column) -> Column:
    """Equal for equal words, whether a part is short or was padded with nulls."""
    return F.xxhash64(F.get(part, F.lit(0)), F.get(part, F.lit(1)), F.get(part, F.lit(2)))


def places(docs: DataFrame, shingles: DataFrame, size: int, first: bool) -> DataFrame:
    """header, doc_id, key, n_words, at, size, shingle, from, about: where a document has one of ``shingles``.

    ``about`` holds the words of any window through the place, and begins at word ``from``. With ``first``, the
    start of each document is a row too, marked as header, with a null shingle if it is none of those.
    """
    cut = docs.select(
        "doc_id",
        F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("key"),
        words(F.col("text")).alias("w"),
    )
    parts = [F.col("w"), *(F.slice("w", F.lit(k + 1), F.greatest(F.size("w") - k, F.lit(0))) for k in range(1, size))]
    zipped = F.arrays_zip(*(p.alias(f"w{k}") for k, p in enumerate(parts)))
    rows = cut.select("doc_id", "key", "w", F.posexplode_outer(zipped).alias("at", "part"))
    fields = [F.col("part")[name] for name in _zip_names(rows)]
    hashed = F.xxhash64(*fields, *(F.lit(None).cast("string") for _ in range(3 - size)))
    known = F.broadcast(shingles.select(F.col("shingle").alias("known")))
    start = F.greatest(F.col("at") - (WINDOW - 1), F.lit(0))
    found = rows.withColumn("shingle", F.when(F.col("at") + size <= F.size("w"), hashed)).join(
        known, F.col("shingle") == F.col("known"), "left"
    )
    header = F.coalesce(F.col("at") == 0, F.lit(True)) if first else F.lit(False)
    return found.where(F.col("known").isNotNull() | header).select(
        header.alias("header"),
        "doc_id",
        "key",
        F.size("w").cast("long").alias("n_words"),
        "at",
        F.lit(size).alias("size"),
        F.col("known").alias("shingle"),
        start.alias("from"),
        F.when(F.col("known").isNotNull(), F.slice("w", start + 1, F.lit(2 * WINDOW))).alias("about"),
    )


def _zip_names(rows: DataFrame) -> list[str]:
    return rows.schema["part"].dataType.names


def occurrences(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Headers (doc_id, key, n_words, a row per document) and hits (doc_id, key, start, length, item_id)."""
    items_windows = windows_of(items)
    windows = items_windows.select("window").distinct()
    shingles = stored(shingles_of(windows), "item-shingles")  # as many rows as the items have windows' shingles
    sizes = sorted(r[0] for r in shingles.select("size").distinct().collect()) or [SHINGLE]  # 1 to SHINGLE
    block_counts = {
        size: -(-shingles.where(F.col("size") == size).select("shingle").distinct().count() // BLOCK) or 1 for size in sizes
    }
    parts = []
    for size in sizes:
        for b in range(block_counts[size]):
            own = shingles.where((F.col("size") == size) & (F.pmod("shingle", F.lit(block_counts[size])) == b))
            parts.append(places(docs, own.select("shingle").distinct(), size, first=not parts))
    found = stored(reduce(DataFrame.unionByName, parts), "item-places")
    headers = found.where("header")
    matched = found.where(F.col("shingle").isNotNull())

    counts = matched.groupBy("size", "shingle").agg(F.count("*").alias("rarity"))
    prefix = (  # windows with a shingle that no document has cannot occur, so an inner join loses none
        shingles.join(counts, ["size", "shingle"])
        .groupBy("window")
        .agg(F.min(F.struct("rarity", "shingle", "at", "size")).alias("p"), F.count("*").alias("present"))
        .where(F.col("present") == F.size("window") - F.col("p.size") + 1)
        .select("window", F.col("p.size").alias("size"), F.col("p.shingle").alias("shingle"), F.col("p.at").alias("offset"))
    )
    prefix = stored(prefix, "item-prefixes")
    hits, blocks = [], -(-prefix.count() // BLOCK) or 1
    for b in range(blocks):
        own = prefix.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b)
        start = F.col("at") - F.col("offset")
        hits.append(
            matched.join(F.broadcast(own), ["size", "shingle"])
            .where((start >= 0) & (start + F.size("window") <= F.col("n_words")))
            .where(F.slice("about", start - F.col("from") + 1, F.size("window")) == F.col("window"))
            .select("doc_id", "key", "window", start.alias("start"), F.size("window").alias("length"))
        )
    hits = reduce(DataFrame.unionByName, hits).distinct()
    return headers, hits.join(items_windows, "window").select("doc_id", "key", "start", "length", "item_id")


def contamination_table(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, a row for each of ``docs``."""
    return _table(docs, items).drop("key")


def _table(docs: DataFrame, items: DataFrame) -> DataFrame:
    headers, hits = occurrences(docs, items)
    end = lambda x: x["start"] + x["length"]
    # Intervals in the order of their starts: each adds what lies beyond the furthest end before it.
    covered = F.aggregate(
        F.array_sort("intervals"),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], end(x)).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), end(x) - F.greatest(acc["end"], x["start"]))).cast("long").alias("n"),
        ),
    )["n"]
    per_doc = (
        hits.distinct()
        .groupBy("doc_id", "key")
        .agg(F.collect_set(F.struct("start", "length")).alias("intervals"), F.collect_set("item_id").alias("items"))
        .select(
            F.col("doc_id").alias("hit_id"),
            F.col("key").alias("hit_key"),
            covered.alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            F.array_join(F.array_sort("items"), ",").alias("ids"),
        )
    )
    joined = headers.select("doc_id", "key", "n_words").join(
        per_doc, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")), "left"
    )
    return joined.select(
        "doc_id",
        "key",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without those that contain a window of an item, all columns kept."""
    bad = _table(docs, items).where("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_key"))
    bad = few(bad.distinct(), "contaminated")
    key = F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (key == bad["bad_key"]), "left_anti")
