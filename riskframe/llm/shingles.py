"""Word shingles of whole texts as 64-bit hashes, computed batch-wise with numpy.

Words are runs of characters other than space and U+0009 to U+000D, with A-Z in lower case. A shingle is five
words in a row; a text with one to four words has one shingle, its whole sequence; a text without words has
none. Two shingles are taken for equal when their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash

WORDS = 5
_TOGETHER = 200_000  # bytes hashed at a time
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_TABLE = None


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash; one-to-one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = mix(np.arange(1, 257, dtype=_U))


def _powers(n: int) -> np.ndarray:
    """_BASE ** i modulo 2**64."""
    global _TABLE
    if _TABLE is None or len(_TABLE) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        t = np.full(size, _BASE, dtype=_U)
        t[0] = _U(1)
        _TABLE = np.cumprod(t, dtype=_U)
    return _TABLE[:n]


_INVERSE = pow(int(_BASE), -1, 1 << 64)


def _words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of every word of UTF-8 text whose A-Z are in lower case already."""
    b = np.frombuffer(raw, dtype=np.uint8)
    if not len(b):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=_U)
    gap = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, np.zeros(0, dtype=_U)
    # word value: sum of byte codes times powers of an odd base, so one running sum serves all words
    powers = _powers(len(b) + 1)
    run = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(_BYTES[b] * powers[:len(b)], dtype=_U)])
    value = (run[ends] - run[starts]) * _inverse_powers(len(b) + 1)[starts]
    return starts, mix(value + mix((ends - starts).astype(_U)))


_INVERSES = None


def _inverse_powers(n: int) -> np.ndarray:
    global _INVERSES
    if _INVERSES is None or len(_INVERSES) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        t = np.full(size, _U(_INVERSE), dtype=_U)
        t[0] = _U(1)
        _INVERSES = np.cumprod(t, dtype=_U)
    return _INVERSES[:n]


def combined(words: np.ndarray, k: int = WORDS) -> np.ndarray:
    """Hash of every k words in a row, or of the whole sequence if it is shorter."""
    n = len(words)
    if n == 0:
        return words
    k = min(n, k)
    out = np.full(n - k + 1, _U(k), dtype=_U)
    for i in range(k):
        out = mix(out * _U(0xD6E8FEB86659FD93) + words[i:n - k + 1 + i])
    return out


def _distinct(hashes: np.ndarray) -> np.ndarray:
    s = np.sort(hashes)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def texts_sets(texts: Sequence[str | None]) -> list[np.ndarray]:
    """The distinct shingles of every text, ascending; texts are hashed together up to a few hundred kilobytes."""
    out: list[np.ndarray] = []
    raw = [(t or "").encode("utf-8").lower() for t in texts]  # bytes: only A-Z change
    at = 0
    while at < len(raw):
        end, size = at, 0
        while end < len(raw) and (end == at or size + len(raw[end]) <= _TOGETHER):
            size += len(raw[end]) + 1
            end += 1
        begins = np.cumsum([0, *(len(r) + 1 for r in raw[at:end])])
        starts, words = _words(b"\n".join(raw[at:end]))
        edges = np.searchsorted(starts, begins).tolist()
        whole = combined(words)
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            out.append(_distinct(whole[lo:hi - WORDS + 1]) if hi - lo >= WORDS else combined(words[lo:hi]))
        at = end
    return out


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles of a text, ascending."""
    return texts_sets([text])[0]


def set_key(shingles: np.ndarray) -> int:
    """A signed 64-bit key of the set; 0 is kept for the empty set."""
    if not len(shingles):
        return 0
    key = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return (key - (1 << 64) if key >= 1 << 63 else key) or 1


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two ascending arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def distance(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard distance; 1 if either set is empty."""
    if not len(a) or not len(b):
        return 1.0
    both = overlap(a, b)
    return 1.0 - both / (len(a) + len(b) - both)


def linked(a: np.ndarray, b: np.ndarray, percent: int = 75) -> bool:
    both = overlap(a, b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def order(shingles: np.ndarray, late: np.ndarray) -> np.ndarray:
    """Positions in the global order: the ``late`` (ascending) shingles after all others, else by value."""
    if not len(late):
        return np.arange(len(shingles))
    at = np.searchsorted(late, shingles)
    at[at == len(late)] = 0
    heavy = late[at] == shingles
    return np.concatenate([np.flatnonzero(~heavy), np.flatnonzero(heavy)])
