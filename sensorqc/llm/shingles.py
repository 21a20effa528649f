"""Word and shingle hashes of whole texts, in arrays.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased. A
word's hash is a polynomial of its bytes modulo 2**64, taken as a difference of
prefix sums over the batch's bytes, then mixed; texts are worked through in
pieces cut between words, so memory does not grow with a text's length beyond
eight bytes per word.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

PIECE = 1 << 18  # bytes
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2, _S = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _S)
    x = x * _M1
    x = x ^ (x >> _S)
    x = x * _M2
    return x ^ (x >> _S)


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to 2**bits."""
    out = []
    for b in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
        p = np.full((1 << bits) + 1, b)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _piece_hashes(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of ``raw``; a word also ends at every break."""
    power, inverse = _powers(max(19, int(len(raw)).bit_length()))
    b = _LOWER[raw]
    inside = ~_BLANK[b]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    breaks = breaks[(breaks > 0) & (breaks < len(raw))]
    opens[breaks] = inside[breaks]
    closes[breaks - 1] = inside[breaks - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[: len(b)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start]), start


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the words of text i are hashes[bounds[i]:bounds[i + 1]]; null has none."""
    if not len(texts):
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    hashes, starts, at, stop = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], int(offsets[0]), int(offsets[-1])
    while at < stop:
        cut = min(stop, at + PIECE)
        while cut < stop:  # on to the next white space or text
            ahead = _BLANK[raw[cut: min(stop, cut + 4096)]]
            if ahead.any():
                cut += int(ahead.argmax())
                break
            cut += len(ahead)
        lo, hi = np.searchsorted(offsets, [at, cut])
        h, s = _piece_hashes(raw[at:cut], offsets[lo:hi] - at)
        hashes.append(h)
        starts.append(s + at)
        at = cut
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    s = words[:n]
    for j in range(1, k):
        s = mix(s * np.uint64(31) + words[j: n + j])
    return np.unique(s)


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    hashes, bounds = word_hashes(texts)
    return [shingle_set(hashes[a:b], k) for a, b in zip(bounds, bounds[1:])]
