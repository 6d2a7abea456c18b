"""Hashed word shingles of whole texts, computed for many texts at once with numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes hashed at once; a longer text is cut between words and put together again.
CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_powers = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> list[np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, CHUNK + 64), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word in a byte array, A-Z as a-z."""
    data = _LOWER[data]
    word = ~_BLANK[data]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _cuts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``CHUNK`` bytes that end at blanks."""
    at = 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data):
            blanks = np.flatnonzero(_BLANK[data[end : end + CHUNK]])
            if len(blanks):
                end += int(blanks[0])
                break
            end = min(end + CHUNK, len(data))
        yield at, end
        at = end


def shingle_sets(texts: Iterable[str | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text below ``width`` words is one shingle."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size >= CHUNK:
            yield from _sets(held, width)
            held, size = [], 0
    yield from _sets(held, width)


def _sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    if not texts:
        return
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    found = [(h, s + at) for at, end in _cuts(data) for h, s in [word_hashes(data[at:end])]]
    words = np.concatenate([h for h, _ in found] or [np.empty(0, np.uint64)])
    starts = np.concatenate([s for _, s in found] or [np.empty(0, np.int64)])
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(words) - width + 1)
    sums = np.zeros(n, np.uint64)
    for k in range(width):
        sums += words[k : k + n] * factors[k]
    sums = mix(sums)
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        if last - first >= width:
            yield np.unique(sums[first : last - width + 1])
        elif last > first:
            few = words[first:last]
            yield mix(np.sum(few * factors[: len(few)], keepdims=True) ^ np.uint64(len(few)))
        else:
            yield np.empty(0, np.uint64)
