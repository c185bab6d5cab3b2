"""Hashed word shingles of many texts at once, in numpy.

A word is a run of ASCII letters, digits and non-ASCII characters, A-Z in lower case. A word's hash is a
polynomial in its bytes, read off running sums; a shingle's hash mixes the hashes of its words in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
STRETCH = 1 << 18
_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_MULTIPLIER, STRETCH)
_DOWN = _powers(pow(_MULTIPLIER, -1, 1 << 64), STRETCH)
_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_VALUE[65:91] = _VALUE[97:123]
_PLACE = mix(np.arange(1000, 1000 + WIDTH, dtype=np.uint64)) | np.uint64(1)


def _stretches(inside: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans that cover the bytes and end between words, of about STRETCH bytes."""
    at, n = 0, len(inside)
    while at < n:
        end = min(n, at + STRETCH)
        if end < n:
            gaps = np.flatnonzero(~inside[at:end])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                while end < n and inside[end:end + STRETCH].all():
                    end = min(n, end + STRETCH)
                if end < n:
                    end += int(np.argmin(inside[end:end + STRETCH])) + 1
        yield at, end
        at = end


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the bytes begin, and their hashes."""
    data = np.frombuffer(raw, np.uint8)
    inside = _IN_WORD[data]
    places, hashes = [], []
    for at, end in _stretches(inside):
        part = inside[at:end]
        edge = np.flatnonzero(np.diff(part, prepend=False, append=False))
        begin, stop = edge[::2], edge[1::2]
        n = end - at
        up, down = (_UP, _DOWN) if n <= STRETCH else (_powers(_MULTIPLIER, n), _powers(pow(_MULTIPLIER, -1, 1 << 64), n))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[data[at:end]] * up[:n], out=sums[1:])
        places.append(begin + at)
        hashes.append(mix((sums[stop] - sums[begin]) * down[begin]))
    return (np.concatenate(places), np.concatenate(hashes)) if places else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def shingles(texts: list[str | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all shingles, text after text and sorted within a text, and the bounds of each text.
    A text with words, but less than ``width``, has one shingle of all of them; one without words has none."""
    raws = [(x or "").encode() for x in texts]
    ends = np.cumsum([len(x) + 1 for x in raws])
    places, words = word_hashes(b"\n".join(raws))
    bounds = np.concatenate([[0], np.searchsorted(places, ends)])
    n = np.diff(bounds)
    whole = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        whole += words[k:k + len(whole)] * _PLACE[k]
    whole = mix(whole)
    size = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    limits = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(limits[-1], np.uint64)
    for i in range(len(texts)):
        if n[i] >= width:
            part = out[limits[i]:limits[i + 1]]
            part[:] = whole[bounds[i]:bounds[i] + size[i]]
            part.sort()
        elif n[i]:
            few = words[bounds[i]:bounds[i + 1]]
            out[limits[i]] = mix(np.array([int((few * _PLACE[:n[i]]).sum()) ^ int(n[i])], np.uint64))[0]
    return out, limits


def multisets(texts: list[str | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles sorted within each text, how often each occurs, and the bounds of each text."""
    values, limits = shingles(texts, width)
    if not len(values):
        return values, np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    first[limits[:-1][limits[:-1] < len(values)]] = True
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(values)))
    return values[at], counts, np.searchsorted(at, limits)
