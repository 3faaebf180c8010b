"""Hashed word shingles and SetSketch registers of texts, in numpy over whole blocks of text."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np

#: Words per shingle.
WORDS = 5
#: Registers: their number, the base of their exponential spacing and the largest value.
REGISTERS = 120
BASE = 1.001
LARGEST = 65535
#: Added to every register, so that none is cut at 0: waits end at log(2 ** 53), 3605 steps below it.
OFFSET = 4000
#: Bytes of text worked on at once (one longer text is a block of its own).
BLOCK = 1 << 18

_random = np.random.default_rng(20260101)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = _random.integers(0, 1 << 64, 256, np.uint64)
_STEP = int(_random.integers(0, 1 << 62)) * 4 + 1
_PLACE = _random.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _random.integers(0, 1 << 64, WORDS, np.uint64)
_FLIP = _random.integers(0, 1 << 64, REGISTERS, np.uint64)
_SPREAD = _random.integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    size = 1
    while size < n:
        more = min(size, n - size)
        out[size : size + more] = out[:more] * np.uint64(pow(base, size, 1 << 64))
        size += more
    return out


_powers_kept: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the step and of its inverse; those for usual blocks are kept."""
    size = max(n, BLOCK * 2)
    if size > BLOCK * 2:
        return [_powers(_STEP, size), _powers(pow(_STEP, -1, 1 << 64), size)]
    if not _powers_kept:
        _powers_kept.extend([_powers(_STEP, size), _powers(pow(_STEP, -1, 1 << 64), size)])
    return _powers_kept


def word_hashes(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word of a block, A-Z in lower case."""
    data = np.frombuffer(block, np.uint8)
    blank = np.concatenate(([True], _SPACE[data], [True]))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, stops = edges[::2], edges[1::2]
    up, down = _power_tables(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[_LOWER[data]] * up[: len(data)])))
    return _mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes | None]]:
    """For each text its sorted distinct shingle hashes, and a digest of its word sequence.

    A text of fewer words than a shingle has one, the whole sequence; without words the set is
    empty and the digest None.
    """
    at = 0
    while at < len(texts):
        stop, size = at + 1, len(texts[at])
        while stop < len(texts) and size + len(texts[stop]) < BLOCK:
            size += len(texts[stop]) + 1
            stop += 1
        some = texts[at:stop]
        words, places = word_hashes(b" ".join(some))
        ends = np.cumsum([len(t) + 1 for t in some])
        bounds = np.concatenate(([0], np.searchsorted(places, ends)))
        rolled = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
        for k in range(WORDS):
            rolled += words[k : k + len(rolled)] * _PLACE[k]
        rolled = _mix(rolled)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if a == b:
                yield np.empty(0, np.uint64), None
                continue
            if b - a < WORDS:
                whole = (words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True)
                found = _mix(whole + _SHORT[b - a])
            else:
                found = np.unique(rolled[a : b - WORDS + 1])
            yield found, blake2b(words[a:b].tobytes(), digest_size=16).digest()
        at = stop


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers: per register the least of exponential hashes, on a logarithmic scale.

    floor(``OFFSET`` + 1 - log_b(least)), between 0 and ``LARGEST`` for any set. Registers of a union are
    the larger of both.
    """
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        drawn = (shingles[at : at + 512, None] ^ _FLIP) * _SPREAD
        np.minimum(least, drawn.min(0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    waiting = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53))
    return np.clip(np.floor(OFFSET + 1 - np.log(waiting) / np.log(BASE)), 0, LARGEST).astype("<u2")


def joint_estimate(larger: np.ndarray, smaller: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of sets of n and m shingles.

    ``larger`` and ``smaller`` count the registers in which the first sketch is above and below the
    second; the rest agree. The likelihood is concave, so a ternary search finds its top.
    """
    u, v = n / (n + m), m / (n + m)
    scale = (BASE - 1) / BASE
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def chance(x):
        return np.maximum(-np.log1p(-np.clip(x, 0, 1) * scale) / np.log(BASE), 1e-12)

    def likelihood(j):
        above, below = chance(u - v * j), chance(v - u * j)
        equal = np.maximum(1 - above - below, 1e-12)
        return larger * np.log(above) + smaller * np.log(below) + (REGISTERS - larger - smaller) * np.log(equal)

    for _ in range(24):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        left = likelihood(a) < likelihood(b)
        low, high = np.where(left, a, low), np.where(left, high, b)
    return (low + high) / 2
