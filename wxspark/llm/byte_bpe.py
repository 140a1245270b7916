"""Byte-level BPE, encoding and decoding in two tiers.

A pre-token that is in the vocabulary as a whole is found by a minimal perfect hash: each vocabulary entry has
its own slot in a table with no empty ones, one seed per group of entries keeps them apart, and a lookup
compares one entry. Any other pre-token is merged: its bytes form a linked list, a heap yields the lowest-ranked
neighbours, leftmost first, and stale heap entries are passed over.

Null texts are encoded as empty: no ids, and the digests of nothing. Very long texts are encoded whole; very long pieces
are not remembered. Rows that repeat are encoded one by one;
other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import at_work, bounded_batches, id_lists
from wxspark.llm.pieces import WHITE_SPACE, Memory

#: Parameter of the perfect hash: vocabulary entries per seed.
PER_SEED = 2
#: Bytes of each of the two generations of pieces that a worker remembers.
MEMORY_BYTES = 48 << 20
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: A blank and what follows it up to white space, or white space as the pre-token pattern divides it. The pattern
#: matches nothing across these borders, so the pieces are looked up and pre-tokenized on their own.
PIECE = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")


class PerfectHash:
    """Minimal perfect hash from the vocabulary's byte strings to their ranks."""

    def __init__(self, tokens: list[bytes], seeds: array, slots: array):
        """``tokens`` by rank, all different; ``seeds`` and ``slots`` as ``build`` gives them."""
        self.tokens, self.seeds, self.slots = tokens, seeds, slots

    @staticmethod
    def build(tokens: list[bytes]) -> tuple[array, array]:
        """A seed per group of entries, and the rank in each slot."""
        n = len(tokens)
        groups: list[list[int]] = [[] for _ in range(max(1, n // PER_SEED))]
        for rank, token in enumerate(tokens):
            groups[xxhash.xxh3_64_intdigest(token) % len(groups)].append(rank)
        seeds, slots = array("i", bytes(4 * len(groups))), array("i", [-1]) * n
        for g in sorted(range(len(groups)), key=lambda g: -len(groups[g])):
            members, seed = groups[g], 1
            if len(members) < 2:
                break
            while True:
                at = {xxhash.xxh3_64_intdigest(tokens[r], seed) % n for r in members}
                if len(at) == len(members) and all(slots[a] < 0 for a in at):
                    break
                seed += 1
            seeds[g] = seed
            for r in members:
                slots[xxhash.xxh3_64_intdigest(tokens[r], seed) % n] = r
        free = (i for i in range(n) if slots[i] < 0)
        for g, members in enumerate(groups):
            if len(members) == 1:  # alone in its group it takes any free slot, named by a negative seed
                slot = next(free)
                seeds[g], slots[slot] = -slot - 1, members[0]
        return seeds, slots

    def get(self, token: bytes) -> int | None:
        if not self.tokens:
            return None
        seed = self.seeds[xxhash.xxh3_64_intdigest(token) % len(self.seeds)]
        slot = -seed - 1 if seed < 0 else xxhash.xxh3_64_intdigest(token, seed) % len(self.slots)
        rank = self.slots[slot]
        return rank if self.tokens[rank] == token else None


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary of a file of base64 tokens and ranks, by rank."""
    with open(path, "rb") as source:
        pairs = [line.split() for line in source if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class Codec:
    """Encoder and decoder for a file of ranks and a pre-token pattern."""

    def __init__(self, path: str, pattern: str, table: tuple[array, array] | None = None):
        self.vocabulary = read_ranks(path)
        self.hash = PerfectHash(self.vocabulary, *(table or PerfectHash.build(self.vocabulary)))
        self.ranks = {token: rank for rank, token in enumerate(self.vocabulary)}
        self.pattern = regex.compile(pattern)
        self.digits = list(map(str, range(len(self.vocabulary))))
        self.memory = Memory(lambda pieces: list(map(self._piece, pieces)), MEMORY_BYTES)

    def merge(self, token: bytes) -> list[int]:
        """Ranks of the parts that merging the bytes of ``token`` leaves."""
        n, get = len(token), self.ranks.get
        ends = list(range(1, n + 1))  # where the part that begins here ends; 0 once it is merged away
        before = list(range(-1, n - 1))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := get(token[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, end = heappop(heap)
            middle = ends[i]
            if not middle or middle >= end or ends[middle] != end:
                continue  # one of the two has changed since
            ends[i], ends[middle] = end, 0
            if end < n:
                before[end] = i
                after = ends[end]
                if (rank := get(token[i:after])) is not None:
                    heappush(heap, (rank, i, after))
            left = before[i]
            if left >= 0 and (rank := get(token[left:end])) is not None:
                heappush(heap, (rank, left, end))
        out, i = [], 0
        while i < n:
            out.append(get(token[i : ends[i]]))
            i = ends[i]
        return out

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids: list[int] = []
        for pretoken in self.pattern.findall(piece):
            data = pretoken.encode()
            rank = self.hash.get(data)
            if rank is None:
                ids += self.merge(data)
            else:
                ids.append(rank)
        return tuple(ids)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [list(chain.from_iterable(ids)) for ids in self.memory.encoded([PIECE.findall(t or "") for t in texts])]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))

    def digest_of(self, ids: list[int]) -> str:
        return hashlib.sha256(",".join(map(self.digits.__getitem__, ids)).encode()).hexdigest()


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str, table: tuple[array, array] | None = None) -> Codec:
    """Made once per Python worker; ``table`` is the perfect hash's, built once on the driver."""
    at_work("byte-level BPE", _codecs.clear)
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern, table)
    return _codecs[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int), a row for each of ``docs``."""
    bounded_batches(docs.sparkSession)
    table = PerfectHash.build(read_ranks(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern, table)
        for batch in batches:
            lists = id_lists(coder.encode(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, "doc_id long, ids array<int>"
    )


def decoded(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text from doc_id and ids; bytes that are no UTF-8 become replacement characters."""
    bounded_batches(rows.sparkSession)
    table = PerfectHash.build(read_ranks(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern, table)
        for batch in batches:
            texts = [coder.decode(ids or []).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(work, "doc_id long, text string")


def digest_table(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """The columns of RESULT: each whole text encoded, its ids digested, the ids decoded and digested.

    With ``with_ids`` the ids follow as an array.
    """
    bounded_batches(docs.sparkSession)
    table = PerfectHash.build(read_ranks(path))
    schema = RESULT + ", ids array<int>" if with_ids else RESULT
    names = [c.split()[0] for c in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern, table)
        for batch in batches:
            encoded_texts = coder.encode(batch.column(1).to_pylist())
            arrays = [
                batch.column(0),
                pa.array(list(map(len, encoded_texts)), pa.int64()),
                pa.array(list(map(coder.digest_of, encoded_texts)), pa.string()),
                pa.array([hashlib.sha256(coder.decode(ids)).hexdigest() for ids in encoded_texts], pa.string()),
            ]
            if with_ids:
                arrays.append(id_lists(encoded_texts))
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, schema)
