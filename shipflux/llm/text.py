"""Words of a text as the contracts define them, on bytes, and 64-bit hashes of words and word runs."""

from __future__ import annotations

import numpy as np
import pandas as pd

# Everything but digits, a-z and bytes of non-ASCII letters becomes a space; A-Z become a-z first.
_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_SPACED = bytes(b if b in _KEPT else 0x20 for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def space_words(text: str | None) -> list[bytes]:
    """Runs without space, tab, newline, vertical tab, form feed and return, unchanged."""
    return text.encode().split() if text else []


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, ASCII letters and non-ASCII characters."""
    return text.encode().lower().translate(_SPACED).split() if text else []


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    held = np.empty(len(words), dtype=object)
    held[:] = words
    return pd.util.hash_array(held, categorize=False)


def run_hashes(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A hash of every run of `length` consecutive words; none if there are fewer words."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    start = mixed(hashes + np.uint64(seed) * _MIX) if seed else hashes
    total = np.zeros(count, dtype=np.uint64)
    factor = np.uint64(0xD1342543DE82EF95)
    with np.errstate(over="ignore"):
        for i in range(length):
            total = total * factor + start[i : i + count]
    return mixed(total)
