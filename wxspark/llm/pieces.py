"""Texts cut into pieces that a tokenizer treats on their own, and a bounded memory of encoded pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

#: The characters with the Unicode property White_Space, as a class for ``re``.
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Characters of the longest piece that is remembered.
LONGEST = 64
#: Bytes that each of the two generations of a Python worker's memory may take, and what an entry takes besides its text and ids:
#: two objects' heads and its share of a hash table that may have just been doubled.
GENERATION_BYTES = 150 << 20
ENTRY_BYTES = 180


class Memory:
    """Piece to encoded piece. When the young generation is full it becomes the old one, and what of that was
    not asked for since is forgotten; results do not depend on it.

    It is bounded in bytes, whatever the pieces are: each counts with the most that its characters and ids can
    take, and pieces of more than LONGEST characters are encoded each time that they come.
    """

    def __init__(self, encode: Callable[[list[str]], list], generation_bytes: int = GENERATION_BYTES):
        """``encode`` takes distinct pieces and gives what to remember of each."""
        self._encode = encode
        self._most = generation_bytes
        self._young: dict[str, object] = {}
        self._old: dict[str, object] = {}
        self._bytes = 0

    def encoded(self, cut: list[list[str]]) -> Iterator[Iterator]:
        """For each text, which is given as its pieces, what is remembered of them one by one."""
        young, old = self._young, self._old
        new, long = [], []
        for piece in set(chain.from_iterable(cut)).difference(young):
            known = old.get(piece)
            if known is not None:
                young[piece] = known
                self._bytes += _cost(piece)
            else:
                (new if len(piece) <= LONGEST else long).append(piece)
        if new:
            young.update(zip(new, self._encode(new), strict=True))
            self._bytes += sum(map(_cost, new))
        passing = dict(zip(long, self._encode(long), strict=True)) if long else {}
        if self._bytes > self._most:
            self._old, self._young, self._bytes = young, {}, 0
        if passing:
            return (map(lambda p: passing[p] if p in passing else young[p], pieces) for pieces in cut)
        return (map(young.__getitem__, pieces) for pieces in cut)


def _cost(piece: str) -> int:
    return ENTRY_BYTES + 8 * len(piece)
