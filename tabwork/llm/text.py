"""Words and word shingles of many texts at once, as arrays.

Words are runs of bytes of a class, found by a lookup table over the UTF-8 bytes of all
texts of a chunk; no word leaves its text. Words and shingles get 64-bit hashes that depend
on their bytes alone, from prefix sums of a polynomial.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Any byte but space and the control characters from tab to carriage return.
NOT_SPACE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
#: Digits, lower-case letters and every byte of a character beyond ASCII.
ALPHANUMERIC = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _BASE + np.uint64(seed)) | np.uint64(1)


_VALUES = constants(256, 11)
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base and its inverse to the powers 0..n-1."""
    if len(_POWERS["up"]) < n:
        for name, factor in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(2 * n, factor, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _VALUES) -> np.ndarray:
    """A hash of each data[start:end], the same wherever the bytes stand. ``values`` must map equal bytes alike."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of a chunk: byte spans, hashes, and for each text its first word and number of words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    counts: np.ndarray

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def spelled(self, word: int, length: int) -> bytes:
        """``length`` words from ``word`` on, joined by single spaces."""
        return b" ".join(self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(word, word + length))


def words(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> Words:
    """Words of the texts data[offsets[i]:offsets[i + 1]], with A-Z lower-cased; ``letters`` marks the bytes of words."""
    data = LOWER[data[offsets[0] : offsets[-1]]]
    texts = offsets[:-1] - offsets[0]
    inside = letters[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[texts[texts < len(data)]] = False
    after[texts[texts > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, texts)
    counts = np.diff(np.append(first, len(starts)))
    return Words(data, starts, ends, span_hashes(data, starts, ends), first, counts)


def windows(w: Words, length: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``length`` words within one text."""
    factors = constants(length, seed * 1000 + length)
    n = len(w.hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(length):
        total += w.hashes[j : n + j] * factors[j]
    last = np.repeat(w.first + w.counts, w.counts)[:n]
    at = np.flatnonzero(np.arange(n) + length <= last)
    return at, mix(total[at])


def shingles(w: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every shingle of ``length`` words; a text of fewer words has the whole sequence as one."""
    at, hashes = windows(w, length)
    owner = w.owner()[at] if len(at) else np.empty(0, np.int64)
    short = np.flatnonzero((w.counts > 0) & (w.counts < length))
    if len(short):
        factors = constants(length, 77)
        total = w.counts[short].astype(np.uint64) * factors[-1]
        for j in range(length - 1):
            has = w.counts[short] > j
            total[has] += w.hashes[w.first[short[has]] + j] * factors[j]
        owner, hashes = np.concatenate([owner, short]), np.concatenate([hashes, mix(total)])
    return owner, hashes


def sets(owner: np.ndarray, hashes: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text in ascending order, and where each text's hashes start."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    owner, hashes = owner[new], hashes[new]
    return hashes, np.searchsorted(owner, np.arange(texts + 1))
