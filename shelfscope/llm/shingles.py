"""Sets of distinct word shingles as 64-bit codes, computed over whole Arrow batches.

A word is a maximal run of bytes other than space and 0x09-0x0D (in UTF-8 these
bytes never occur inside a longer character), with A-Z lower-cased. A shingle is
``SIZE`` consecutive words; a text of fewer words is one shingle. Equal word
sequences always get equal codes; different ones collide with a chance of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SIZE = 5
#: Bytes of text hashed at once; it bounds the temporary arrays, not the texts.
CHUNK_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    z = values + _ODD
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base & (2**64 - 1), dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_BASE = 0xD1342543DE82EF95
_UP = _powers(_BASE, CHUNK_BYTES + 1)
_DOWN = _powers(pow(_BASE, -1, 2**64), CHUNK_BYTES + 1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLDED = np.arange(256, dtype=np.uint64)
_FOLDED[ord("A") : ord("Z") + 1] += np.uint64(32)
_BYTE = mix(_FOLDED)
_PLACE = mix(np.arange(1, SIZE + 1, dtype=np.uint64)) | np.uint64(1)


def _runs(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a word also ends at each of ``breaks``."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    at = breaks[(breaks > 0) & (breaks < len(data))]
    first[at] = inside[at]
    last[at - 1] = inside[at - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    running = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _UP[: len(data)], out=running[1:])
    codes = (running[ends] - running[starts]) * _DOWN[starts]
    return mix(codes + (ends - starts).astype(np.uint64) * _ODD)


def _one_long_text(data: np.ndarray) -> np.ndarray:
    """Word codes of a text longer than a chunk, cut at white space; a longer word is folded by pieces."""
    spaces = np.flatnonzero(_SPACE[data])
    parts, at = [], 0
    while at < len(data):
        limit = at + CHUNK_BYTES
        if limit >= len(data):
            cut = len(data)
        else:
            k = np.searchsorted(spaces, limit, side="right") - 1
            cut = int(spaces[k]) if k >= 0 and spaces[k] > at else None
        if cut is None:
            k = np.searchsorted(spaces, limit)
            cut = int(spaces[k]) if k < len(spaces) else len(data)
            word = data[at:cut]
            lead = int(np.argmax(~_SPACE[word]))
            code = np.zeros(1, dtype=np.uint64)
            for i in range(lead, len(word), CHUNK_BYTES):
                piece = word[i : i + CHUNK_BYTES]
                code = mix(code + _word_codes(piece, np.array([0]), np.array([len(piece)])))
            parts.append(code)
        else:
            block = data[at:cut]
            parts.append(_word_codes(block, *_runs(block, np.empty(0, dtype=np.int64))))
        at = cut
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def _word_groups(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes of all words, end of each text's words) for consecutive texts."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1)
        block = data[offsets[at] : offsets[to]]
        if len(block) > CHUNK_BYTES:
            codes = _one_long_text(block)
            yield codes, np.array([len(codes)])
        else:
            breaks = offsets[at : to + 1] - offsets[at]
            starts, ends = _runs(block, breaks)
            yield _word_codes(block, starts, ends), np.searchsorted(starts, breaks[1:])
        at = to


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle codes of each text.

    ``data`` holds the UTF-8 bytes of all texts, ``offsets`` where each begins,
    as in an Arrow string array.
    """
    for words, ends in _word_groups(data, offsets):
        count = len(words) - SIZE + 1
        if count > 0:
            whole = np.full(count, SIZE, dtype=np.uint64)
            for k in range(SIZE):
                whole += words[k : k + count] * _PLACE[k]
            whole = mix(whole)
        begin = 0
        for end in ends.tolist():
            if end - begin >= SIZE:
                yield np.unique(whole[begin : end - SIZE + 1])
            elif end > begin:
                few = words[begin:end]
                yield mix((few * _PLACE[: len(few)]).sum(keepdims=True) + np.uint64(len(few)))
            else:
                yield np.empty(0, dtype=np.uint64)
            begin = end
