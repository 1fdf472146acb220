"""Words of texts as numpy arrays, many texts at a time, inside Python tasks.

A word is a run of bytes that are not ASCII white space; its hash takes all its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(have)
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of every word of a byte array, block by block."""
    found, begin = [], 0
    while begin < len(data):
        end = min(begin + BLOCK_BYTES, len(data))
        if end < len(data):
            space = np.flatnonzero(_IS_SPACE[data[begin:end]])
            if len(space):
                end = begin + int(space[-1]) + 1
            else:  # a word longer than a block
                more = np.flatnonzero(_IS_SPACE[data[end:]])
                end = end + int(more[0]) + 1 if len(more) else len(data)
        found.append(tuple(x + begin if k < 2 else x for k, x in enumerate(_in_block(data[begin:end]))))
        begin = end
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _in_block(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([True], _IS_SPACE[data], [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * _powers(_BASE_INVERSE, len(data) + 1)[starts]
    return starts, ends, mixed(h + (ends - starts).astype(np.uint64))


def text_blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a string column: first row, row count, their bytes and the offsets of the rows.

    A slice holds about BLOCK_BYTES, or one longer text. Null counts as empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last - first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def separated(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a line feed after each, and where each text begins."""
    begins = offsets + np.arange(len(offsets))
    out = np.full(begins[-1], 10, np.uint8)
    place = np.arange(len(data)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out[place] = data
    return out, begins
