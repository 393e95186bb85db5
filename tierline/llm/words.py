"""Word fingerprints of whole batches of texts, as flat numpy arrays.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return.  Every word gets a 64-bit fingerprint: a polynomial in its
bytes with an odd 64-bit base, taken from running sums over the batch, then mixed with
its length.  n-grams of words combine those fingerprints with one odd multiplier per
position.  Nothing here loops over words in Python.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BLOCK = 1 << 20  # bytes hashed at a time: bounds the running-sum arrays
U64 = np.uint64

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_TO_LOWER = np.arange(256, dtype=np.uint8)
_TO_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def odd_constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers, the same in every process."""
    steps = np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)
    return mix(steps) | U64(1)


_BASE = int(odd_constants(1, 11)[0])


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(n, base, U64)
        out[0] = 1
        return np.cumprod(out, dtype=U64)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


def _hash_block(data: np.ndarray, cuts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(start, fingerprint) of the words of one block; ``cuts``: text starts inside it."""
    n = len(data)
    solid = ~_IS_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    if len(cuts):
        begins[cuts] = solid[cuts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return starts, np.zeros(0, U64)
    stops = np.zeros(n + 1, bool)
    stops[1:] = solid
    stops[1:n] &= ~solid[1:]
    if len(cuts):
        stops[cuts] |= np.where(cuts > 0, solid[cuts - 1], False)
    ends = np.flatnonzero(stops)
    up, down = _powers(BLOCK if n <= BLOCK else n)
    total = np.zeros(n + 1, U64)
    np.cumsum(((_TO_LOWER[data] if lower else data).astype(U64) + U64(1)) * up[:n], out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    return starts, mix(value + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))


def block_end(data: np.ndarray, offsets: np.ndarray, at: int, end: int) -> int:
    """Where the block that begins at ``at`` ends: about BLOCK bytes on, at the end of a
    text or else at white space.  A single word longer than that is taken whole."""
    stop = min(at + BLOCK, end)
    if stop == end:
        return stop
    cut = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
    if cut > at:
        return cut
    gaps = np.flatnonzero(_IS_SPACE[data[at:stop]])
    if len(gaps) and gaps[-1] > 0:
        return at + int(gaps[-1])
    text_end = int(offsets[np.searchsorted(offsets, at, "right")])
    more = np.flatnonzero(_IS_SPACE[data[stop:text_end]])
    return stop + int(more[0]) if len(more) else text_end


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words of the texts data[offsets[i]:offsets[i+1]], and the
    index of the first word of each text (one more entry than texts)."""
    found, places = [], []
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = block_end(data, offsets, at, end)
        inside = offsets[np.searchsorted(offsets, at, "left"):np.searchsorted(offsets, stop, "left")]
        starts, values = _hash_block(data[at:stop], np.unique(inside - at), lower)
        found.append(values)
        places.append(starts + at)
        at = stop
    values = np.concatenate(found) if found else np.zeros(0, U64)
    where = np.concatenate(places) if places else np.zeros(0, np.int64)
    return values, np.searchsorted(where, offsets)


def ngrams(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Fingerprints of all runs of n words (empty when there are fewer words)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, U64)
    total = np.zeros(count, U64)
    for j, m in enumerate(odd_constants(n, seed)):
        total += words[j:j + count] * m
    return mix(total)


def owner(first: np.ndarray) -> np.ndarray:
    """Text index of every word, from the first-word index of each text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
