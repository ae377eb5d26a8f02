"""Hashed word shingles and one-permutation bins, for a block of texts at a time in numpy.

A text is lower-cased from A to Z and cut at ASCII white space. A shingle's 64-bit hash is a polynomial over its bytes,
taken from running sums over the whole block; no shingle is ever built as a string.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 64, 256, dtype=np.uint64)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(1 << bits, _BASE), np.full(1 << bits, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def shingle_hashes(texts: Sequence[bytes | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes of the texts, repeats included, and where each text's begin (one more entry: the end).

    A text with fewer words than a shingle gives one hash of all its words; a text without words gives none.
    """
    normal = [b" ".join(text.lower().split()) if text else b"" for text in texts]
    joined = np.frombuffer(b" ".join([*normal, b""]), np.uint8)
    ends_of_text = np.cumsum([len(text) + 1 for text in normal]) - 1
    starts_of_text = np.concatenate([[0], ends_of_text[:-1] + 1])
    power, inverse = _powers(max(10, int(len(joined)).bit_length()))
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_BYTES[joined] * power[: len(joined)], out=sums[1:])
    gaps = np.flatnonzero(joined == 32)
    filled = np.array([len(text) > 0 for text in normal])
    # Words in order: each ends at a gap and starts behind the one before; empty texts leave a gap of no word.
    starts = np.concatenate([[0], gaps[:-1] + 1]) if len(gaps) else gaps
    real = gaps > starts
    starts, ends = starts[real], gaps[real]
    first = np.searchsorted(starts, starts_of_text)
    count = np.searchsorted(starts, ends_of_text) - first
    made = np.where(filled, np.maximum(count - words + 1, 1), 0)
    offsets = np.concatenate([[0], np.cumsum(made)])
    text_of = np.repeat(np.arange(len(normal)), made)
    begin = first[text_of] + np.arange(offsets[-1]) - offsets[text_of]
    last = np.minimum(begin + words, first[text_of] + count[text_of]) - 1
    s, e = starts[begin], ends[last]
    return mixed((sums[e] - sums[s]) * inverse[s]), offsets


def rolling_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """The hash of every ``width`` bytes; ``data`` holds at least so many."""
    power, inverse = _powers(max(10, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[: len(data)], out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * inverse[: len(data) - width + 1])


def bin_minima(hashes: np.ndarray, offsets: np.ndarray, bits: int) -> np.ndarray:
    """texts x 2**bits: the least remainder of the hashes that fall into a bin by their first bits; EMPTY if none."""
    texts = len(offsets) - 1
    minima = np.full(texts << bits, EMPTY)
    where = (np.repeat(np.arange(texts), np.diff(offsets)) << bits) + (hashes >> np.uint64(64 - bits)).astype(np.int64)
    np.minimum.at(minima, where, hashes & np.uint64((1 << (64 - bits)) - 1))
    return minima.reshape(texts, 1 << bits)


@functools.lru_cache(maxsize=4)
def _probes(bins: int, rounds: int) -> np.ndarray:
    return np.random.default_rng(bins).integers(0, bins, (rounds, bins))


def densified(minima: np.ndarray, rounds: int = 64) -> np.ndarray:
    """Empty bins filled: each looks at bins in an order of its own that all texts share, and takes the first that is
    not empty. What is open after ``rounds`` looks takes the next filled bin. Texts without hashes stay empty."""
    filled = minima.copy()
    bins = minima.shape[1]
    text, bin_ = np.nonzero(minima == EMPTY)
    keep = (minima != EMPTY).any(axis=1)[text]
    text, bin_ = text[keep], bin_[keep]
    for probe in _probes(bins, rounds):
        if not len(text):
            return filled
        found = minima[text, probe[bin_]]
        hit = found != EMPTY
        filled[text[hit], bin_[hit]] = found[hit]
        text, bin_ = text[~hit], bin_[~hit]
    step = 1
    while len(text):
        found = minima[text, (bin_ + step) % bins]
        hit = found != EMPTY
        filled[text[hit], bin_[hit]] = found[hit]
        text, bin_, step = text[~hit], bin_[~hit], step + 1
    return filled
