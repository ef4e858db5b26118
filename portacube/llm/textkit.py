"""Words of Arrow text columns as 64-bit hashes, computed on whole buffers.

A word is a run of bytes that are no ASCII white space; A-Z is lower-cased on
request.  Word hashes are polynomial over the word's bytes, taken from one
running sum per buffer, so no Python object is made per word.  Texts are
handled in segments of about a megabyte cut at white space: memory does not
grow with a text's length (only with its longest word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += _U(32)
LOWER += _U(1)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def strings(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of an Arrow text column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of ``data``, and words per text; ``bounds`` cuts it into texts."""
    n = len(data)
    solid = ~WHITE[data]
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    start[inner] |= solid[inner]
    end[inner - 1] |= solid[inner - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    power, inverse = _power(max(n, 1))
    running = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(LOWER[data] * power, out=running[1:])
    hashes = scramble((running[e] - running[s]) * inverse[s] + (e - s).astype(np.uint64))
    return hashes, s, e, np.diff(np.searchsorted(s, bounds))


def segments(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts of about SEGMENT bytes, cut at white space."""
    at = 0
    while at < len(data):
        to = min(at + SEGMENT, len(data))
        while to < len(data):  # on to the next white space
            gap = np.flatnonzero(WHITE[data[to:to + SEGMENT]])
            if len(gap):
                to += int(gap[0])
                break
            to = min(to + SEGMENT, len(data))
        yield data[at:to]
        at = to


def _long_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, segment by segment."""
    return np.concatenate([words_of(part, np.array([0, len(part)]))[0] for part in segments(data)])


def text_words(column) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of every row of an Arrow text column, in order."""
    offsets, data = strings(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        if offsets[row + 1] - offsets[row] > SEGMENT:
            yield row, _long_text(data[offsets[row]:offsets[row + 1]])
            row += 1
            continue
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SEGMENT, side="right")) - 1)
        bounds = offsets[row:to + 1] - offsets[row]
        hashes, _, _, counts = words_of(data[offsets[row]:offsets[to]], bounds)
        at = np.concatenate([[0], np.cumsum(counts)])
        for i in range(to - row):
            yield row + i, hashes[at[i]:at[i + 1]]
        row = to


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size``-word shingles; with fewer words the whole sequence is the one shingle."""
    if not len(words):
        return words
    k = min(size, len(words))
    out = words[:len(words) - k + 1].copy()
    for i in range(1, k):
        out = scramble(out * _U(0xD6E8FEB86659FD93) + words[i:len(words) - k + 1 + i])
    if k < size:  # a short sequence is no shingle of another text
        out = scramble(out + _U(k))
    return np.unique(out)
