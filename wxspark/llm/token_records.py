"""Token ids in length-delimited binary records.

A file is MAGIC, then per document a record: the payload's length in bytes (unsigned 32 bits, as all numbers
little-endian), that length's masked checksum, the payload, and the payload's masked checksum. The payload
is the document's ids in 16 or 32 bits; the last byte of MAGIC says which. A second file, the index, has a
fixed-size entry per record (id, place in the file, number of ids) for reading in shuffled order. Checksums
are CRC-32, rotated and shifted by a constant, so that a checksum of data that holds checksums stays sound.

Documents are sorted by id with one range shuffle, each task writes its range, and a table of the files that
the successful attempts report replaces any rename: what a lost attempt left is never read. Starts follow
from sums per file, one number a file on the driver.

Null texts are encoded as empty and get the end id alone. Very long texts are one record each, encoded whole. Null ids come first. Rows with equal ids are in the
order of a hash of their text; equal rows are written as often as they occur. An empty table gives no rows.
Other columns are not looked at.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import bounded_batches
from wxspark.llm.pieces import Memory
from wxspark.session import scratch_path

MAGIC = b"WXTOKEN"
END_ID = 2
#: A new file is begun beyond this size.
FILE_BYTES = 256 << 20
#: Only these characters cut a text into pieces. All are white space to the tokenizer: it turns runs of them into
#: a blank, never matches across them, and composes no character with them, so pieces are encoded on their own. So is
#: punctuation behind a word of precomposed Latin letters (without U+0130, which is two characters in lower case).
LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]"
_REST = r"++(?=[.,;:!?]*+(?:[\t-\r ]|\Z))|[^\t-\r ]+"
PIECE, SMALL_PIECE = re.compile(LETTER + _REST), re.compile("[a-z]" + _REST)  # of any text, and of ASCII in lower case
LATIN = re.compile(LETTER + "+")
#: Words handed over as one text.
TOGETHER = 500
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("offset", "<u8"), ("n_tokens", "<u4")])
MANIFEST = "first_id long, first_tie long, first_copy long, data_file string, index_file string, n_records long, n_tokens long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


_loaded: dict[str, Memory] = {}


def _memory(path: str) -> Memory:
    """The tokenizer of a file behind a memory of pieces, once per Python worker."""
    if path not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _loaded[path] = Memory(lambda pieces: encode_pieces(pieces, tokenizer))
    return _loaded[path]


def encode_pieces(pieces: list[str], tokenizer) -> list[bytes]:
    """Ids of each piece by the library, as 32-bit numbers.

    A piece of Latin letters is one word to it, so many are handed over as one text and told apart by the
    words that it reports. All other pieces are handed over one by one.
    """
    words = [p for p in pieces if LATIN.fullmatch(p)]
    known: dict[str, bytes] = {}
    for start in range(0, len(words), TOGETHER):
        some = words[start : start + TOGETHER]
        encoding = tokenizer.encode(" ".join(some), add_special_tokens=False)
        ids, of = np.array(encoding.ids, dtype="<u4").tobytes(), np.array(encoding.word_ids)
        if len(of) and of[-1] == len(some) - 1 and (np.diff(of) <= 1).all() and (np.diff(of) >= 0).all() and of[0] == 0:
            cuts = (4 * np.searchsorted(of, np.arange(len(some) + 1))).tolist()
            known.update((w, ids[cuts[k] : cuts[k + 1]]) for k, w in enumerate(some))
    rest = [p for p in pieces if p not in known]
    for piece, encoding in zip(rest, tokenizer.encode_batch(rest, add_special_tokens=False), strict=True):
        known[piece] = np.array(encoding.ids, dtype="<u4").tobytes()
    return [known[p] for p in pieces]


def encode(texts: list[str | None], path: str, end: bytes = b"") -> list[np.ndarray]:
    """Ids of each whole text, as one call of the library per text would give them, and the ids in ``end``.

    The library puts texts into lower case; where that can be done beforehand, fewer words have to be remembered.
    """
    given = (t or "" for t in texts)
    found = _memory(path).encoded([SMALL_PIECE.findall(t.lower()) if t.isascii() else PIECE.findall(t) for t in given])
    return [np.frombuffer(b"".join((*ids, end)), dtype="<u4") for ids in found]


class _Writer:
    """Writes one file and its index."""

    def __init__(self, folder: str, width: int):
        self.store, at = fs.FileSystem.from_uri(folder)
        self.store.create_dir(at, recursive=True)
        name = uuid.uuid4().hex
        self.data, self.index = f"{folder}/{name}.tokens", f"{folder}/{name}.index"
        self._out = self.store.open_output_stream(f"{at}/{name}.tokens")
        self._index_at = f"{at}/{name}.index"
        self.width = width
        self.size = self._put(MAGIC + bytes([width]))
        self.entries: list[tuple] = []

    def _put(self, data: bytes) -> int:
        self._out.write(data)
        return len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        payload = ids.astype(f"<u{self.width}").tobytes()
        length = struct.pack("<I", len(payload))
        self.entries.append((doc_id or 0, doc_id is not None, self.size, len(ids)))
        self.size += self._put(
            length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))
        )

    def close(self) -> tuple:
        self._out.close()
        entries = np.array(self.entries, dtype=INDEX)
        with self.store.open_output_stream(self._index_at) as out:
            raw = entries.tobytes()
            out.write(raw + struct.pack("<I", masked(raw)))
        return self.data, self.index, len(entries), int(entries["n_tokens"].sum())


def write_records(docs: DataFrame, path: str, end_id: int = END_ID, folder: str | None = None) -> list[tuple]:
    """Encode and write ``docs``; returns the files as (start, data, index, records) in the order of ids."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    bounded_batches(spark)
    folder = folder or scratch_path(spark, "tokens")
    end = struct.pack("<I", end_id)
    width = 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, rows, first = None, [], None
        for batch in batches:
            ids, ties, copies, texts = (c.to_pylist() for c in batch.columns)
            for doc_id, tie, copy, tokens in zip(ids, ties, copies, encode(texts, path, end), strict=True):
                if writer is None:
                    writer, first = _Writer(folder, width), (doc_id, tie, copy)
                writer.add(doc_id, tokens)
                if writer.size >= FILE_BYTES:
                    rows.append((*first, *writer.close()))
                    writer = None
        if writer is not None:
            rows.append((*first, *writer.close()))
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            columns = zip(zip(*rows, strict=True), kinds, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names)

    tie, copy = F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("copy")
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), tie, copy, "text")
        .repartitionByRange("doc_id", "tie", "copy")  # equal rows may be parted too
        .sortWithinPartitions("doc_id", "tie", "copy")
    )
    files = ordered.mapInArrow(written, MANIFEST).collect()  # a row per file
    files.sort(key=lambda f: (f.first_id is not None, f.first_id or 0, f.first_tie, f.first_copy))
    out, start = [], 0
    for f in files:
        out.append((start, f.data_file, f.index_file, f.n_records))
        start += f.n_tokens
    return out


def read_file(data: str, index: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, ids) of each record, every checksum verified."""
    store, at = fs.FileSystem.from_uri(index)
    with store.open_input_stream(at) as source:
        raw = source.read()
    entries, seal = raw[:-4], struct.unpack("<I", raw[-4:])[0]
    if masked(entries) != seal:
        raise ValueError(f"checksum of {index}")
    store, at = fs.FileSystem.from_uri(data)
    with store.open_input_stream(at, buffer_size=1 << 20) as source:
        head = source.read(len(MAGIC) + 1)
        if head[:-1] != MAGIC:
            raise ValueError(f"no token records in {data}")
        for entry in np.frombuffer(entries, dtype=INDEX):
            length, check = source.read(4), source.read(4)
            if masked(length) != struct.unpack("<I", check)[0]:
                raise ValueError(f"checksum of a length in {data}")
            payload = source.read(struct.unpack("<I", length)[0])
            if masked(payload) != struct.unpack("<I", source.read(4))[0]:
                raise ValueError(f"checksum of a record in {data}")
            yield int(entry["doc_id"]) if entry["known"] else None, np.frombuffer(payload, dtype=f"<u{head[-1]}")


def read_record(data: str, index: str, number: int) -> tuple[int | None, np.ndarray]:
    """One record by its number, found over the index: what a shuffled read does."""
    store, at = fs.FileSystem.from_uri(index)
    with store.open_input_file(at) as source:
        entry = np.frombuffer(source.read_at(INDEX.itemsize, number * INDEX.itemsize), dtype=INDEX)[0]
    store, at = fs.FileSystem.from_uri(data)
    with store.open_input_file(at) as source:
        width = source.read_at(1, len(MAGIC))[0]
        size = int(entry["n_tokens"]) * width
        framed = source.read_at(size + 12, int(entry["offset"]))
    payload = framed[8:-4]
    if masked(framed[:4]) != struct.unpack("<I", framed[4:8])[0] or masked(payload) != struct.unpack("<I", framed[-4:])[0]:
        raise ValueError(f"checksum of a record in {data}")
    return int(entry["doc_id"]) if entry["known"] else None, np.frombuffer(payload, dtype=f"<u{width}")


def record_table(spark, files: list[tuple]) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each record, read from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RESULT.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                start, rows = row["start"], []
                for doc_id, ids in read_file(row["data_file"], row["index_file"]):
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(rows) == 10_000:
                        yield _columns(rows, names)
                        rows = []
                if rows:
                    yield _columns(rows, names)

    listed = spark.createDataFrame(files, "start long, data_file string, index_file string, n_records long")
    return listed.repartition(max(1, len(files))).mapInArrow(read, RESULT)


def _columns(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)
