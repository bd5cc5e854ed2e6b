"""Words of whole texts as numpy arrays, for use inside Arrow batches.

Texts are cut at the bytes of the six ASCII blanks, which are the same in UTF-8
and in code points. Nothing here runs per word in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are looked at together; one longer text is taken whole.
CHUNK_BYTES = 1 << 20
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUE = np.random.default_rng(20261201).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd base and of its inverse, modulo 2**64."""
    held = _POWERS.get(which)
    if held is None or len(held[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        base = _BASES[which]
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            pair.append(np.multiply.accumulate(steps))
        held = (pair[0], pair[1])
        if n <= CHUNK_BYTES + 1:
            _POWERS[which] = held
    return held


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prefix(values: np.ndarray, which: int) -> np.ndarray:
    sums = np.empty(len(values) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values * _powers(which, len(values) + 1)[0][: len(values)], out=sums[1:])
    return sums


def span_hashes(
    sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0
) -> np.ndarray:
    """Hash of each span ``[start, end)`` of a sequence with prefix sums ``sums``."""
    inverse = _powers(which, len(sums))[1]
    raw = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(raw + mix((ends - starts).astype(np.uint64)))


#: A prime below 2**31, so that products of two remainders fit 64 bits.
_PRIME = np.uint64((1 << 31) - 1)
_PRIME_BASE = 1_123_581_321
_PRIME_POWERS: list[np.ndarray] = []


def _prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of a base and of its inverse, modulo the prime."""
    if not _PRIME_POWERS or len(_PRIME_POWERS[0]) < n:
        made = []
        for base in (_PRIME_BASE, pow(_PRIME_BASE, -1, int(_PRIME))):
            powers, step = np.ones(1, dtype=np.uint64), base
            while len(powers) < max(n, CHUNK_BYTES + 1):
                powers = np.concatenate([powers, powers * np.uint64(step) % _PRIME])
                step = step * step % int(_PRIME)
            made.append(powers)
        if n > 2 * CHUNK_BYTES:
            return made[0], made[1]
        _PRIME_POWERS[:] = made
    return _PRIME_POWERS[0], _PRIME_POWERS[1]


def span_checks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A second hash of spans of bytes, modulo a prime and so apart from that modulo 2**64."""
    up, down = _prime_powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)] % _PRIME, out=sums[1:])
    raw = (sums[ends] - sums[starts]) % _PRIME * down[starts] % _PRIME
    return mix(raw + ((ends - starts).astype(np.uint64) << np.uint64(32)))


@dataclass
class Words:
    """Words of several texts in a row; text ``i`` has words ``first[i]:first[i + 1]``.

    ``checks`` are hashes apart from ``hashes``, where they were asked for.
    """

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    data: np.ndarray
    checks: np.ndarray | None = None

    def prefix(self, which: int = 0) -> np.ndarray:
        """Prefix sums for ``span_hashes(…, which)``: 0 over the hashes, 1 over the checks."""
        return _prefix(self.checks if which and self.checks is not None else self.hashes, which)

    def last_starts(self, length: int) -> np.ndarray:
        """For each text the end of the places at which ``length`` words begin."""
        return np.maximum(self.first[1:] - length + 1, self.first[:-1])


def text_chunks(
    texts: pa.Array, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, bytes and offsets of chunks of about ``limit`` bytes. NULL is empty."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _BLANK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each text."""
    inside = ~blank[data]
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    last = offsets[1:][offsets[1:] > 0] - 1
    finishes[last] = inside[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def split_words(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False, blank: np.ndarray = _BLANK, checked: bool = False
) -> Words:
    """Words and their hashes; ``checked`` ones take in a second hash, so that no word collides in one alone."""
    if lower:
        data = _LOWER[data]
    starts, ends, first = word_bounds(data, offsets, blank)
    hashes = span_hashes(_prefix(_BYTE_VALUE[data], 1), starts, ends, 1)
    if not checked:
        return Words(hashes, starts, ends, first, data)
    checks = span_checks(data, starts, ends)
    return Words(mix(hashes + checks * np.uint64(3)), starts, ends, first, data, checks)


def exact_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of the spans, equal where their bytes are equal, and how many there are."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64), 0
    places, _ = ranges(starts, ends)
    bounds = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    spans = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[places])]
    )
    coded = spans.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)


def word_text(words: Words, i: int) -> bytes:
    return words.data[words.starts[i] : words.ends[i]].tobytes()


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges ``[start, end)`` and the index of the range of each."""
    counts = np.maximum(ends - starts, 0)
    owner = np.repeat(np.arange(len(starts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - before[owner] + starts[owner], owner


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and their offsets.

    A text of fewer than ``width`` words, but not none, has its whole sequence
    as its one shingle.
    """
    sums = words.prefix()
    count = np.diff(words.first)
    begin, stop = words.first[:-1], words.last_starts(width)
    places, _ = ranges(begin, np.where((count > 0) & (count < width), begin + 1, stop))
    ends = np.minimum(places + width, np.repeat(words.first[1:], np.maximum(
        np.where((count > 0) & (count < width), 1, stop - begin), 0)))
    flat = span_hashes(sums, places, ends)
    sizes = np.where((count > 0) & (count < width), 1, stop - begin)
    bounds = np.append(0, np.cumsum(sizes))
    parts = [np.unique(flat[bounds[i] : bounds[i + 1]]) for i in range(len(count))]
    offsets = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64)
    return (np.concatenate(parts) if parts else flat), offsets


def byte_prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums of byte values, for hashes of parts of words (``span_hashes(…, 1)``)."""
    return _prefix(_BYTE_VALUE[data], 1)
