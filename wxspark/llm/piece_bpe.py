"""SentencePiece's BPE, encoding and decoding, by a merge-type prefix table.

Every prefix of a text has one encoding, so it has one last token. The table of these last tokens is filled from left to
right: an automaton over the vocabulary names the tokens that end at a character, and the one that is compatible
with the last token of the prefix before it is taken. Two tokens are compatible if merging their text gives just
the two; that is told by undoing their merges, latest first, and asking whether what then meets at the border would
have merged before. The ids are read off the table backwards. Time is linear in the text for tokens of bounded length.

Texts are cut first where two neighbouring characters stand side by side in no token, as no merge goes across;
a cut piece that was met before is looked up in a bounded memory. Runs of the blank mark are apart from the table: their
tokens have one score, so that merges go from left to right, after all others. Characters that no token has are
given by their bytes.

Null and empty texts have no ids but the end id and decode to an empty text. Rows that repeat are encoded one by
one; null ids stay; other columns are not looked at. An empty table gives an empty result. A very long text takes
memory in proportion to its length; a very long piece is encoded as any other and not remembered.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import bounded_batches, id_lists
from wxspark.llm.pieces import Memory

#: Fixed value: the character that stands for a blank in tokens.
BLANK = "▁"
#: A character that hardly any text has; cutting a text at it is faster than by places.
APART = "\U0010ffff"
#: Pairs of tokens whose compatibility a Python worker keeps in mind.
REMEMBERED_PAIRS = 500_000
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary(NamedTuple):
    """Tokens by id; ``rank`` is the order of merging for tokens that merges make, else -1."""

    tokens: list[str]
    rank: list[int]
    bytes_of: list[bytes]  # what a token decodes to
    byte_ids: list[int]  # by byte value
    runs: dict[int, int]  # length of a run of blank marks to its id
    end_id: int


def read_vocabulary(path: str) -> Vocabulary:
    """Vocabulary of a BPE model file with byte fallback, without text normalization but the blank mark in front."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    tokens = [model.id_to_piece(i) for i in range(size)]
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(model.is_byte(i) for i in byte_ids):
        raise ValueError(f"{path} has no token for some byte")
    plain = [i for i in range(size) if not special[i]]
    runs = {len(tokens[i]): i for i in plain if not tokens[i].strip(BLANK)}
    made = [i for i in plain if len(tokens[i]) > 1 and tokens[i].strip(BLANK)]
    order = sorted(made, key=lambda i: -model.get_score(i))
    scores = [model.get_score(i) for i in order]
    least = max((model.get_score(i) for n, i in runs.items() if n > 1), default=float("-inf"))
    if len(set(scores)) < len(scores) or (scores and scores[-1] <= least):
        raise ValueError(f"{path}: only runs of blanks may share a score, and it has to be the lowest")
    if any(BLANK in tokens[i][1:] for i in made):
        raise ValueError(f"{path}: a token holds a blank mark behind other characters")
    rank = [-1] * size
    for place, i in enumerate(order):
        rank[i] = place
    bytes_of = [b"" if special[i] else t.replace(BLANK, " ").encode() for i, t in enumerate(tokens)]
    for value, i in enumerate(byte_ids):
        bytes_of[i] = bytes([value])
    return Vocabulary(tokens, rank, bytes_of, byte_ids, runs, model.eos_id())


def merge_splits(vocabulary: Vocabulary) -> tuple[array, array]:
    """For each token the two that its last merge joins; -1 for single characters, -2 if no merging makes it."""
    ids = {t: i for i, t in enumerate(vocabulary.tokens) if vocabulary.rank[i] >= 0}
    known = ids | _singles(vocabulary)
    left, right = array("i", [-1]) * len(vocabulary.tokens), array("i", [-1]) * len(vocabulary.tokens)
    for token, i in ids.items():
        parts = _merged(token, ids, vocabulary.rank, vocabulary.rank[i])
        if len(parts) == 2 and all(p in known for p in parts):
            left[i], right[i] = (known[p] for p in parts)
        else:
            left[i] = right[i] = -2
    return left, right


def _singles(vocabulary: Vocabulary) -> dict[str, int]:
    """Tokens of one character; special ones and those of bytes have longer names."""
    return {t: i for i, t in enumerate(vocabulary.tokens) if len(t) == 1}


def _merged(text: str, ids: dict[str, int], rank: list[int] | None, below: int) -> list[str]:
    """Parts of ``text`` after all merges of a rank below ``below``: lowest rank first, leftmost among equals. Without
    ranks all are equal."""
    n = len(text)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def push(i: int, end: int) -> None:
        found = ids.get(text[i:end])
        if found is not None and (rank is None or rank[found] < below):
            heappush(heap, (rank[found] if rank else 0, i, end))

    for i in range(n - 1):
        push(i, i + 2)
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        middle = ends[i]
        if not middle or middle >= end or ends[middle] != end:
            continue  # one of the two has changed since
        ends[i], ends[middle] = end, 0
        if end < n:
            before[end] = i
            push(i, ends[end])
        if before[i] >= 0:
            push(before[i], end)
    out, i = [], 0
    while i < n:
        out.append(text[i : ends[i]])
        i = ends[i]
    return out


class Codec:
    """Encoder and decoder of a model file."""

    def __init__(self, path: str, splits: tuple[array, array] | None = None):
        self.vocabulary = v = read_vocabulary(path)
        self.left, self.right = splits or merge_splits(v)
        self.single = _singles(v)
        made = [i for i, r in enumerate(v.rank) if r >= 0 and self.left[i] >= 0]
        self.of_pair = {(self.left[i], self.right[i]): i for i in made}
        self.joined = {v.tokens[i]: i for i in made}
        self.length = [len(t) for t in v.tokens]
        self.automaton = ahocorasick.Automaton()
        for i in chain(self.single.values(), made):
            self.automaton.add_word(v.tokens[i], i)
        self.automaton.make_automaton()
        self.runs = {BLANK * n: i for n, i in v.runs.items()}
        # Characters by number, 0 for those that no token has, and which of them stand side by side in a token.
        self.number = np.zeros(0x110000, dtype=np.int32)
        for k, character in enumerate(self.single):
            self.number[ord(character)] = k + 1
        self.width = len(self.single) + 1
        self.beside = np.zeros(self.width * self.width, dtype=bool)
        for token in chain(self.runs, (v.tokens[i] for i in made)):
            at = self.number[[ord(c) for c in token]]
            self.beside[at[:-1] * self.width + at[1:]] = True
        self.pairs: dict[int, bool] = {}
        self.digits = list(map(str, range(len(v.tokens))))
        self.memory = Memory(lambda pieces: list(map(self._piece, pieces)))

    def compatible(self, a: int, b: int) -> bool:
        """Whether the text of two tokens, one behind the other, is merged to just these two."""
        known = self.pairs.get(a << 32 | b)
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            known = self.pairs[a << 32 | b] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        """Undo merges from the latest on. What meets at the border then stood there until the undone merge was
        made, and had merged itself if its rank is lower, or the same and it stands further left."""
        tokens, rank, joined = self.vocabulary.tokens, self.vocabulary.rank, self.joined
        until = len(rank)  # beyond all ranks
        while True:
            met = joined.get(tokens[a] + tokens[b])
            if met is not None and rank[met] < until:
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:
                until, a = rank[a], self.right[a]
            else:  # of equal merges the right one is the later
                until, b = rank[b] + 1, self.left[b]

    def last_tokens(self, text: str) -> list[int]:
        """The last token of each prefix; ``text`` has known characters only."""
        last = [-1] * len(text)
        length, known = self.length, self.pairs.get
        for end, token in self.automaton.iter(text):
            if last[end] < 0:
                begin = end - length[token]
                if begin < 0:
                    last[end] = token
                    continue
                fits = known(last[begin] << 32 | token)
                if fits or (fits is None and self.compatible(last[begin], token)):
                    last[end] = token
        return last

    def _table(self, text: str) -> list[int]:
        last, ids = self.last_tokens(text), []
        at = len(text) - 1
        while at >= 0:
            ids.append(last[at])
            at -= self.length[last[at]]
        ids.reverse()
        return ids

    def _run(self, n: int) -> list[int]:
        """Ids of ``n`` blank marks."""
        return [self.runs[part] for part in _merged(BLANK * n, self.runs, None, 1)]

    def _piece(self, piece: str) -> tuple[int, ...]:
        """Ids of a cut piece: an unknown character, or blank marks and characters behind them."""
        if len(piece) == 1 and piece not in self.single:
            return tuple(self.vocabulary.byte_ids[b] for b in piece.encode())
        word = piece.lstrip(BLANK)
        blanks = len(piece) - len(word)
        if not word:
            return tuple(self._run(blanks))
        if not blanks:
            return tuple(self._table(word))
        ids = self._table(BLANK + word)
        if ids[0] == self.single[BLANK]:  # the last mark has not merged with the word, and belongs to the run
            return tuple(self._run(blanks) + ids[1:])
        return tuple(self._run(blanks - 1) + ids)

    def cut(self, text: str) -> list[str]:
        """Pieces of a text that merges do not cross, with the blank mark for blanks and one in front."""
        if not text:
            return []
        marked = BLANK + text.replace(" ", BLANK)
        characters = np.frombuffer(marked.encode("utf-32-le"), dtype=np.uint32)
        at = self.number[characters]
        apart = np.flatnonzero(~self.beside[at[:-1] * self.width + at[1:]]) + 1
        if APART in text:
            ends = apart.tolist()
            return [marked[a:b] for a, b in zip([0, *ends], [*ends, len(marked)], strict=True)]
        return np.insert(characters, apart, ord(APART)).tobytes().decode("utf-32-le").split(APART)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [list(chain.from_iterable(ids)) for ids in self.memory.encoded([self.cut(t or "") for t in texts])]

    def decode(self, ids: list[int]) -> bytes:
        """The text in UTF-8, without the blank that encoding puts in front; byte tokens that are no UTF-8 become
        replacement characters. Special ids are passed over."""
        data = b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))
        return _sound(data[1:] if data[:1] == b" " else data)


def _sound(data: bytes) -> bytes:
    return data.decode("utf-8", "replace").encode()


_codecs: dict[str, Codec] = {}


def codec(path: str, splits: tuple[array, array] | None = None) -> Codec:
    """Made once per Python worker; ``splits`` are built once on the driver."""
    if path not in _codecs:
        _codecs[path] = Codec(path, splits)
    return _codecs[path]


def encoded(docs: DataFrame, path: str, end: bool = True) -> DataFrame:
    """doc_id and ids (array of int), a row for each of ``docs``; with ``end`` the end id follows each text's ids."""
    bounded_batches(docs.sparkSession)
    splits = merge_splits(read_vocabulary(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, splits)
        for batch in batches:
            rows = coder.encode(batch.column(1).to_pylist())
            if end:
                for ids in rows:
                    ids.append(coder.vocabulary.end_id)
            yield pa.RecordBatch.from_arrays([batch.column(0), id_lists(rows)], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, "doc_id long, ids array<int>"
    )


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids are none."""
    bounded_batches(rows.sparkSession)
    splits = merge_splits(read_vocabulary(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, splits)
        for batch in batches:
            texts = [coder.decode(ids or []).decode() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(work, "doc_id long, text string")


def digest_table(docs: DataFrame, path: str) -> DataFrame:
    """The columns of RESULT: each whole text encoded with the end id, its ids digested, the ids decoded and digested."""
    bounded_batches(docs.sparkSession)
    splits = merge_splits(read_vocabulary(path))
    names = [c.split()[0] for c in RESULT.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, splits)
        digit = coder.digits.__getitem__
        for batch in batches:
            counts, ids_digests, text_digests = [], [], []
            for ids in coder.encode(batch.column(1).to_pylist()):
                ids.append(coder.vocabulary.end_id)
                counts.append(len(ids))
                ids_digests.append(hashlib.sha256(" ".join(map(digit, ids)).encode()).hexdigest())
                text_digests.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            columns = [pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, RESULT)
