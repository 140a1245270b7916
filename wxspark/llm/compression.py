"""Compressed sizes under given dictionaries, for the two compression classifiers."""

from __future__ import annotations

import numpy as np
import zstandard

from wxspark.llm.common import at_work

#: A lazy match search down to four bytes sees short words, which the fast levels pass over; the tables are
#: small because dictionaries and blocks are.
PARAMETERS = zstandard.ZstdCompressionParameters(
    strategy=zstandard.STRATEGY_LAZY2,
    min_match=4,
    window_log=18,
    chain_log=16,
    hash_log=16,
    search_log=3,
    target_length=32,
    write_content_size=0,
    write_checksum=0,
)
#: Bytes of text compressed at once. A dictionary helps most near the start of its input, so a whole text
#: is compressed block by block and the sizes are summed up.
BLOCK_BYTES = 1 << 14

_made: dict[tuple[bytes, ...], list[zstandard.ZstdCompressor]] = {}


def raw_dictionary(texts: list[bytes], size: int) -> bytes:
    """Raw content of at most ``size`` bytes; the texts named first stand last, where matches cost least."""
    parts, left = [], size
    for text in texts:
        part = text[:left]
        parts.append(part)
        left -= len(part)
        if left <= 0:
            break
    return b"\n".join(reversed(parts))[-size:]


def _compressors(dictionaries: tuple[bytes, ...]) -> list[zstandard.ZstdCompressor]:
    """Made once per Python worker and model."""
    at_work("compression", _made.clear)
    if dictionaries not in _made:
        if len(_made) >= 4:
            _made.clear()
        made = []
        for content in dictionaries:
            if len(content) >= 8:
                data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(compression_params=PARAMETERS)
                made.append(zstandard.ZstdCompressor(dict_data=data, compression_params=PARAMETERS))
            else:  # too short to serve as a dictionary
                made.append(zstandard.ZstdCompressor(compression_params=PARAMETERS))
        _made[dictionaries] = made
    return _made[dictionaries]


def sizes(texts: list[bytes], dictionaries: tuple[bytes, ...], block_bytes: int = BLOCK_BYTES) -> np.ndarray:
    """A row per text of its compressed bytes under each dictionary.

    The fixed cost of a block (an empty one) is taken off, so that an empty text has size 0.
    """
    made = _compressors(dictionaries)
    empty = [len(c.compress(b"")) for c in made]
    out = np.zeros((len(texts), len(made)))
    for i, data in enumerate(texts):
        for start in range(0, len(data), block_bytes):
            block = data[start : start + block_bytes]
            for k, c in enumerate(made):
                out[i, k] += len(c.compress(block)) - empty[k]
    return out
