"""Encoding with the public word_bpe_49k tokenizer, a batch of texts at a time.

That tokenizer ends words at white space and drops it, so a text's ids are those of its
space-free pieces in turn.  Inside a piece of printable ASCII and Latin-1 letters its
rules cut at every change between letters, single digits and other characters; those
units are found for the whole batch with numpy, and only a unit not met before goes to
the merge model.  Any other piece (an apostrophe, another script, a combining mark, a
control character, perhaps a special token) is one unit that goes through the tokenizer
as it is.  ``tests/llm`` compares the result with the tokenizer's own.  Units are known
by a 64-bit fingerprint.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from tierline.llm import words as W

WORD_BPE = "word_bpe_49k.json"
KEPT_UNITS = 400_000   # fingerprints one worker keeps (some 30 bytes each); beyond, it starts anew

_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _SPACE
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:] = _LETTER
#: Bytes that make their piece an odd one wherever they stand.
_ODD = np.zeros(256, bool)
_ODD[:0x20] = _ODD[0x7F] = _ODD[0x27] = True
_ODD[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def default_tokenizer() -> str:
    """Path of the public word_bpe_49k file, from the package that describes it."""
    import public_tokenizers

    return public_tokenizers.path(WORD_BPE)


def _byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: the
    byte's own if that is visible, else the next one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


def _runs(mask: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, which also end at ``cuts``."""
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    begins[cuts] = mask[cuts]
    starts = np.flatnonzero(begins)
    stops = np.append(starts[1:], len(mask))
    solid = np.concatenate([[0], np.cumsum(mask)])
    return starts, starts + (solid[stops] - solid[starts])


def _units(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, fingerprint, odd) of the units of one block; no piece crosses it."""
    n = len(data)
    kind = _KIND[data]
    solid = kind != _SPACE
    starts, ends = _runs(solid, cuts)
    if not len(starts):
        return starts, ends, np.zeros(0, W.U64), np.zeros(0, bool)
    after_c3 = np.zeros(n, bool)
    after_c3[1:] = data[:-1] == 0xC3
    latin = after_c3 & (data >= 0x80) & (data < 0xC0) & (data != 0x97) & (data != 0xB7)
    odd = _ODD[data] | ((data >= 0x80) & (data != 0xC3) & ~latin)
    odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)   # "<|" opens the special tokens
    lower = W._TO_LOWER[data]
    lower[latin & (data < 0x9F)] += 0x20
    odds = np.concatenate([[0], np.cumsum(odd)])
    odd_piece = odds[ends] > odds[starts]
    begins = solid & (kind == _DIGIT)
    begins[1:] |= solid[1:] & (kind[1:] != kind[:-1])
    begins[starts] = True
    if odd_piece.any():
        edge = np.zeros(n + 1, np.int32)
        edge[starts[odd_piece]] += 1
        edge[ends[odd_piece]] -= 1
        inside = np.cumsum(edge[:-1]) > 0
        begins &= ~inside
        begins[starts] = True
        lower = np.where(inside, data, lower)
    first = np.flatnonzero(begins)
    piece = np.searchsorted(starts, first, "right") - 1
    last = np.minimum(np.append(first[1:], n), ends[piece])
    up, down = W._powers(W.BLOCK if n <= W.BLOCK else n)
    total = np.zeros(n + 1, W.U64)
    np.cumsum((lower.astype(W.U64) + W.U64(1)) * up[:n], out=total[1:])
    value = (total[last] - total[first]) * down[first] + (last - first).astype(W.U64) * W.U64(0x9E3779B97F4A7C15)
    is_odd = odd_piece[piece]
    return first, last, W.mix(value ^ (is_odd.astype(W.U64) << W.U64(63))), is_odd


class PieceEncoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._merge = self._tokenizer.model.tokenize
        self._letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self._runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []   # (keys ascending, start, size), shrinking
        self._pool, self._used = np.zeros(1 << 16, np.uint32), 0

    def _known(self) -> int:
        return sum(len(keys) for keys, _, _ in self._runs)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) of each key's ids in the pool; start -1: not known."""
        start, size = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int32)
        for held, begin, n in self._runs:
            place = np.minimum(np.searchsorted(held, keys), len(held) - 1)
            hit = held[place] == keys
            start[hit], size[hit] = begin[place[hit]], n[place[hit]]
        return start, size

    def _learn(self, keys: np.ndarray, raw: list[bytes], odd: np.ndarray) -> None:
        """Keep the ids of new units; ``keys`` ascend."""
        ids: list[list[int]] = [[]] * len(raw)
        letters, merge = self._letters, self._merge
        for i in np.flatnonzero(~odd).tolist():
            s = raw[i].decode().lower()
            ids[i] = [t.id for t in merge(s if s.isascii() else "".join([letters[b] for b in s.encode()]))]
        strange = np.flatnonzero(odd).tolist()
        if strange:
            for i, e in zip(strange, self._tokenizer.encode_batch_fast(
                    [raw[i].decode("utf-8", "replace") for i in strange], add_special_tokens=False)):
                ids[i] = e.ids
        size = np.array([len(x) for x in ids], np.int32)
        start = self._used + np.concatenate([[0], np.cumsum(size, dtype=np.int64)[:-1]])
        more = np.array([x for unit in ids for x in unit], np.uint32)
        end = self._used + len(more)
        if end > len(self._pool):
            grown = np.zeros(max(end, 2 * len(self._pool)), np.uint32)
            grown[:self._used] = self._pool[:self._used]
            self._pool = grown
        self._pool[self._used:end], self._used = more, end
        run = (keys, start, size)
        while self._runs and len(self._runs[-1][0]) <= 2 * len(run[0]):   # few runs, each key moved seldom
            run = tuple(np.concatenate(x) for x in zip(self._runs.pop(), run))
            order = np.argsort(run[0])
            run = tuple(x[order] for x in run)
        self._runs.append(run)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) of the texts data[offsets[i]:offsets[i+1]], and where each
        text's ids begin (one more entry than texts)."""
        at, last_byte, found = int(offsets[0]), int(offsets[-1]), []
        while at < last_byte:
            stop = W.block_end(data, offsets, at, last_byte)
            inside = offsets[np.searchsorted(offsets, at, "left"):np.searchsorted(offsets, stop, "left")]
            first, last, key, odd = _units(data[at:stop], np.unique(inside - at))
            found.append((first + at, last + at, key, odd))
            at = stop
        if not found:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        first, last, key, odd = (np.concatenate(x) for x in zip(*found))
        distinct, sample, back = np.unique(key, return_index=True, return_inverse=True)
        if self._known() > KEPT_UNITS:
            self._forget()
        fresh = np.flatnonzero(self._find(distinct)[0] < 0)
        if len(fresh):
            where = sample[fresh]
            self._learn(distinct[fresh], [data[a:b].tobytes() for a, b in zip(first[where], last[where])], odd[where])
        start, size = (x[back] for x in self._find(distinct))
        ends = np.cumsum(size, dtype=np.int64)
        ids = self._pool[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate([[0], ends])[np.searchsorted(first, offsets)]


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    """One encoder per tokenizer file and Python worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
    return PieceEncoder(path)
