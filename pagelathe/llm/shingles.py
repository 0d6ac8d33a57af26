"""Sets of word runs and their signatures, for the similarity of texts."""

from __future__ import annotations

import re

import numpy as np
import xxhash

_WORD = re.compile(r"[^\W_]+")
_TARGET = re.compile(r"\]\([^)]*\)")
#: Words that a Python worker remembers the hashes of; the memory is emptied between texts when full.
MEMORY = 200_000
_A, _C, STEP = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0x165667B19E3779F9, 0xC2B2AE3D27D4EB4F))


def words_of(text: str) -> list[str]:
    """Runs of letters or digits in lower case; link targets are left out."""
    return _WORD.findall((_TARGET.sub("]", text) if "](" in text else text).lower())


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


_hashes = _Hashes()


def word_hashes(words: list[str]) -> np.ndarray:
    if len(_hashes) > MEMORY:
        _hashes.clear()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` consecutive words, in order; none for fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = mix(out * _A + hashes[i : i + n])
    return out


def set_hash(elements: np.ndarray) -> int:
    """A signed 64-bit number for a set of hashes, in whatever order; 0 for an empty one."""
    return int(np.bitwise_xor.reduce(mix(elements.astype(np.uint64))).astype(np.int64)) if len(elements) else 0


def signature(runs: np.ndarray, count: int) -> np.ndarray:
    """`count` minima of independently hashed runs, as 32-bit numbers; `runs` must not be empty."""
    # Of a sum of both halves, each times an odd factor that is fixed by its
    # number, the high bits decide, and they depend on every bit; 32-bit lanes are fast.
    halves = np.ascontiguousarray(runs).view("<u4").reshape(-1, 2)
    k = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * _C).astype(np.uint32) | np.uint32(1)
    f, g = k[:count, None], k[count:, None]
    block = max(1, 2_000_000 // count)  # long texts in blocks, so memory stays bounded
    least = None
    for at in range(0, len(runs), block):
        part = np.ascontiguousarray(halves[at : at + block].T)
        x = (part[0] * f + part[1] * g).min(axis=1)
        least = x if least is None else np.minimum(least, x)
    return least


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shared elements over all elements of two sorted arrays without repeats; 0 if both are empty."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    total = len(a) + len(b) - both
    return both / total if total else 0.0
