"""Word shingles and min-hash signatures in vectorised numpy: whole batches of texts as one byte buffer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
BUFFER = 1 << 20  # bytes of text hashed at once; one longer text is hashed alone
COLUMNS = 4096  # shingles permuted at once


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_POWERS = np.ones(1, dtype=np.uint64)
_ROOT = np.uint64(0x9E3779B97F4A7C55)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 256), _ROOT, dtype=np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS


def word_hashes(texts: list[str], *, lower: bool = True) -> Iterator[np.ndarray]:
    """For every text, the 64-bit hashes of its words in order; words are runs of anything but ASCII white space."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        held.append(data.translate(_LOWER) if lower else data)
        size += len(data) + 1
        if size >= BUFFER:
            yield from _buffer_hashes(held)
            held, size = [], 0
    if held:
        yield from _buffer_hashes(held)


def _buffer_hashes(held: list[bytes]) -> Iterator[np.ndarray]:
    data = np.frombuffer(b"\n".join([b"", *held, b""]), dtype=np.uint8)
    space = _SPACE[data]
    edges = np.diff(space.view(np.int8))
    starts, ends = np.flatnonzero(edges == -1) + 1, np.flatnonzero(edges == 1) + 1
    if len(starts):
        inside = ~space
        lengths = ends - starts
        place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        terms = (data[inside].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[place]
        hashes = mix64(np.add.reduceat(terms, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))
    else:
        hashes = np.zeros(0, dtype=np.uint64)
    limits = np.cumsum([len(h) + 1 for h in held])
    cuts = np.searchsorted(starts, limits[:-1])
    yield from np.split(hashes, cuts)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; fewer words than ``width`` make one shingle, no words none."""
    n = len(words)
    if n == 0:
        return words
    k = odd_numbers(width + 1, 11)
    if n < width:
        return mix64((words * k[:n]).sum(keepdims=True) + k[width:] * np.array([n], dtype=np.uint64))
    acc = words[: n - width + 1] * k[0]
    for j in range(1, width):
        acc = acc + words[j : n - width + 1 + j] * k[j]
    out = np.sort(mix64(acc))
    fresh = np.ones(len(out), dtype=bool)
    np.not_equal(out[1:], out[:-1], out=fresh[1:])
    return out[fresh]


def sequence_key(words: np.ndarray) -> bytes:
    """128 bits that tell word sequences apart."""
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


class MinHash:
    """``size`` multiply-shift permutations of 32-bit shingle hashes, and the smallest value under each."""

    def __init__(self, size: int, seed: int = 5):
        self.factors = (odd_numbers(size, seed) & np.uint64(0xFFFFFFFF)).astype(np.uint32)[:, None]
        self.shifts = (odd_numbers(size, seed + 1) & np.uint64(0xFFFFFFFF)).astype(np.uint32)[:, None]

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        best = np.full(len(self.factors), 0xFFFFFFFF, dtype=np.uint32)
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        for a in range(0, len(short), COLUMNS):
            best = np.minimum(best, (self.factors * short[None, a : a + COLUMNS] + self.shifts).min(axis=1))
        return best


def digest8(mins: np.ndarray) -> bytes:
    """Eight well-mixed bits of every minimum: equal minima agree, others in one of 256 cases."""
    return ((mins * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def band_hashes(mins: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit hash per band of ``rows`` minima; bands never share a value but by chance."""
    bands = mins.reshape(-1, rows).astype(np.uint64)
    k = odd_numbers(rows, 23)
    return mix64((bands * k).sum(axis=1) + np.arange(1, len(bands) + 1, dtype=np.uint64) * _ROOT).view(np.int64)
